"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, personal data, packing.

Each stage takes all that the one before kept, and its decisions take effect:
rejected documents go, personal data is replaced in the texts, and what is left
is packed.  A stage's rows are written to the shared folder and read again as
the next one's documents, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorpulse.llm import packing, pii, simhash, toxicity, winnow
from vendorpulse.llm.common import shared_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.ordinary(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked at 2 or fewer bits the document of least id stays."""
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that share windows of 13 words with the benchmark over a twentieth of their words."""
    return winnow.decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=13)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets; n_chars follows the text."""
    out = pii.redact(docs)
    return out.select(*((F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`"))
                        for c in out.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens; small sources come forward: targets are tokens to the power of 0.7."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), window=1024, alpha=0.7)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("packing", pack),
]

#: fitted scores, hash fingerprints and tokenizers: SQL can't express the stages; the tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
