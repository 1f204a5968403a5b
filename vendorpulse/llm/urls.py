"""URL filters: a bit-parallel automaton for wildcard rules.

Rules are globs over the canonical URL, host and path (``host + path``, no
scheme, query or fragment; hosts in lower case): ``*`` in the host part stands
for any characters but ``/``, in the path part or at the end of the rule for
any, ``?`` for one character.  All rules are packed side by side into the bits of several 64-bit
words, one bit per character, and advanced together as a Shift-And automaton:
one step reads one byte of every URL of the batch and moves all rules of all
URLs at once.  Of the rules that match a URL the one of highest rank wins.

A null or malformed URL (no ``://``) has an empty host and path, which only a
rule without characters but ``*`` fits.  Repeated rows are judged each; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name
from .words import U64

_SLICE = 4096
_CONTINUES = range(0x80, 0xC0)  # bytes within a character


@dataclass(frozen=True)
class Rule:
    glob: str
    verdict: str
    name: str | None = None  # None: a rule of the automaton alone
    rank: int = 0            # higher wins


def site_rule(verdict: str, name: str, rank: int | None = None) -> list[Rule]:
    """``host/path``: the host and all its subdomains, where the path starts with the rule's."""
    rank = 1_000_000 + len(name) if rank is None else rank
    return [Rule(name + "*", verdict, name, rank), Rule("*." + name + "*", verdict, name, rank)]


class Automaton:
    """Shift-And over all rules.  Bit i of a rule: its first i + 1 characters have been read."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = sorted(rules, key=lambda r: r.rank)  # stable: of equal ranks the later one wins
        steps = []  # per bit: byte set that enters it, byte set that stays in it, whether it starts a rule
        self.last, self.always = [], []
        for r in self.rules:
            stay, own = set(), 0
            host = True
            lead: set[int] = set()  # bytes that may pass before the first character
            for place, ch in enumerate(r.glob, 1):
                if ch == "*":
                    more = set(range(256)) - ({0x2F} if host and place < len(r.glob) else set())
                    if own:
                        steps[-1][1].update(more)
                    else:
                        lead |= more
                    continue
                if ch == "/":
                    host = False
                for i, b in enumerate(ch.encode()):
                    if ch == "?":
                        enter, stay = set(range(256)) - set(_CONTINUES), set(_CONTINUES)
                    else:
                        enter, stay = {b}, set()
                    steps.append([enter, set(stay), lead if not own else None])
                    own += 1
            self.last.append(len(steps) - 1 if own else -1)
            self.always.append(lead if not own else None)
        n = max(1, -(-len(steps) // 64))
        self.enter, self.stay, self.lead = (np.zeros((256, n), U64) for _ in range(3))
        self.first = np.zeros(n, U64)
        for bit, (enter, stay, lead) in enumerate(steps):
            w, m = bit // 64, U64(1 << bit % 64)
            self.enter[list(enter), w] |= m
            self.stay[list(stay), w] |= m
            if lead is not None:
                self.first[w] |= m
                self.lead[list(lead), w] |= m

    def winners(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per byte range: the place in ``rules`` of the winning rule, -1 if none fits."""
        n, size = len(starts), ends - starts
        order = np.argsort(-size, kind="stable")  # the longest first, so those still reading stay in front
        starts, size = starts[order], size[order]
        state = np.zeros((n, self.first.shape[0]), U64)
        ready = np.repeat(self.first[None], n, axis=0)  # rules whose first character may come next
        living = np.searchsorted(-size, -np.arange(int(size[0]) if n else 0), side="left")
        for t in range(int(size[0]) if n else 0):
            on = slice(0, int(living[t]))
            c = data[starts[on] + t]
            s = state[on]
            moved = s << U64(1)
            moved[:, 1:] |= s[:, :-1] >> U64(63)  # the carry to the next word
            moved &= ~self.first                  # rules don't run into each other
            state[on] = ((moved | ready[on]) & self.enter[c]) | (s & self.stay[c])
            ready[on] &= self.lead[c]
        best = np.full(n, -1)
        for i, bit in enumerate(self.last):
            if bit >= 0:
                fits = (state[:, bit // 64] >> U64(bit % 64) & U64(1)).astype(bool)
            elif self.always[i]:  # only wildcards
                fits = np.ones(n, bool) if 0x2F in self.always[i] else np.array(
                    [0x2F not in data[a: a + k] for a, k in zip(starts, size)], bool)
            else:  # no character at all
                fits = size == 0
            best[fits] = i
        out = np.empty(n, np.int64)
        out[order] = best
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; then up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    place, path = (F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i) for i in (1, 2))
    return F.translate(place, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """All columns of ``pages`` and, last, one struct column ``site`` (host, path, rule, verdict)."""
    automaton = Automaton(rules)
    out, at_host = free_name(pages, "site"), free_name(pages, "site_host")
    at_path, kept = free_name(pages, "site_path"), pages.columns
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StructType.fromDDL(
        "host string, path string, rule string, verdict string"))])
    names = np.array([r.name for r in automaton.rules] + [None], object)  # the last: no rule fits
    verdicts = np.array([r.verdict for r in automaton.rules] + [default], object)

    def run(batches):
        for whole in batches:
            for i in range(0, len(whole), _SLICE):
                b = whole.slice(i, _SLICE)
                own = [(h + p).encode() for h, p in zip(b.column(at_host).to_pylist(), b.column(at_path).to_pylist())]
                ends = np.cumsum([len(x) for x in own], dtype=np.int64)
                starts = np.append(0, ends[:-1])
                best = automaton.winners(np.frombuffer(b"".join(own), np.uint8), starts, ends)
                struct = pa.StructArray.from_arrays(
                    [b.column(at_host), b.column(at_path), pa.array(names[best], pa.string()),
                     pa.array(verdicts[best], pa.string())], ["host", "path", "rule", "verdict"])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), struct], [*kept, out])

    rows = pages.select(*(F.col(f"`{c}`") for c in kept), host.alias(at_host), path.alias(at_path))
    return rows.mapInArrow(run, schema)
