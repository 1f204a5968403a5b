"""The driver's entry without the optional part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys

class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as E
names = set(E.queries())
assert not E.HAS_LLM and "abt_layer2" in names and not any(n.startswith("op") and n[2].isdigit() for n in names), names
assert names == set(E.oracle_sql()), names ^ set(E.oracle_sql())
"""


@pytest.mark.parametrize("missing", ["xxhash", "vendorpulse.llm", "corpus_pipeline"])
def test_entry_works_without(missing):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(name=missing, root=str(ROOT))], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
