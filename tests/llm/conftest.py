from __future__ import annotations

import random

import pytest
from cases import SF001, prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside, as columns of a user's table
CLASHES = ("fp", "k", "a", "late", "overlap", "toxicity", "quality", "site", "queue", "ids", "word", "g", "x0", "n_words")


@pytest.fixture(scope="session")
def messy(spark):
    """Rows (doc_id, text, lang, source, n_chars) with every awkward case, and columns with clashing names."""
    rng = random.Random(7)
    shared = prose(rng, 45)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two words"), (6, "é ü 😀 ñandú x y"),
            (7, "long " * 30_000), (8, "x" * 200_000), (9, shared), (10, shared.upper()), (11, shared)]
    rows += [(12 + i, f"{prose(rng, 30)} {shared}\n{prose(rng, 25)}") for i in range(6)]
    rows += [(20 + i, prose(rng, 80)) for i in range(20)]
    rows += [(40 + i, rows[20][1] + " tail" * (i % 3)) for i in range(12)]
    rows += [(60, "a b c d e f g h i j k l m n o p q r s t " * 6), (61, "same line\nsame line\nother\n\n \nsame line")]
    rows += [(70, rows[18][1]), (70, rows[18][1]), (71, "first text of an id"), (71, "second text of an id"), (None, shared)]
    langs, sources = ["en", "de", None], ["src0", "src0", "src1", None]
    full = [(d, t, langs[i % 3], sources[i % 4], None if t is None else len(t)) for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(full, DOCS).repartition(3)
    for c in CLASHES:
        df = df.selectExpr("*", f"concat('extra ', doc_id) as {c}")
    return df.cache()


@pytest.fixture(scope="session")
def plain(messy):
    """The messy rows with an id each and no repeats (for contracts that don't define them)."""
    return messy.where("doc_id is not null and doc_id not in (70, 71)")


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF001}/labels.parquet")
