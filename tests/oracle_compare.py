"""Run a registered query in Spark and its oracle SQL in DuckDB; compare the results.

Usable from pytest and as a script::

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else None
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = None
        return res
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    res["oracle_rows"] = len(o_rows)
    res["columns_match"] = sorted(s_cols) == sorted(o_cols)
    if not res["columns_match"]:
        res["only_spark"] = sorted(set(s_cols) - set(o_cols))[:10]
        res["only_oracle"] = sorted(set(o_cols) - set(s_cols))[:10]
        return res
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        names = sorted(s_cols)
        diffs = {}
        for ra, rb in zip(a, b):
            for i, (x, y) in enumerate(zip(ra, rb)):
                if x != y:
                    diffs.setdefault(names[i], (x, y))
        res["first_diffs"] = dict(list(diffs.items())[:8])
    return res


def main(argv):
    from vendorpulse.session import get_spark
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        r = compare(spark, n, sf_dir, con)
        ok = bool(r.get("values_match") and r["spark_rows"] == r.get("oracle_rows"))
        bad += not (ok or "oracle" in r)
        print(("NONE " if "oracle" in r else "OK   " if ok else "BAD  ") + str(r), flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
