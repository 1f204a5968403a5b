"""Small helpers of the operators' tests."""

from __future__ import annotations

SF001 = "/root/testdata/sf0.001"


def prose(rng, n, words=400):
    return " ".join(f"w{min(int(rng.expovariate(1 / 60)), words)}" for _ in range(n))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
