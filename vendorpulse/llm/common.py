"""Small helpers of the operators: folds, shared files, row keys, generated column names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n`` (null id: as the empty text, 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write once to the shared folder and read back: later steps survive lost executors and don't compute it again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns (extra columns, whatever their names, don't take part)."""
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join by sort and merge, for sides that grow with the corpus.

    Spark measures a side by the size of its compressed files and doesn't count
    what an explode makes of it: left to its estimate it broadcasts rows of many
    times its threshold, which the driver then holds whole.
    """
    return left.join(right.hint("merge"), on, how)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with a number if a column has it."""
    taken = {c.lower() for c in df.columns}
    return next(c for c in (name, *(f"{name}_{i}" for i in range(len(taken) + 1))) if c not in taken)
