"""Feature preparation that is fitted on the table and kept as numbers.

* :class:`TargetEncoder`: a category becomes the smoothed mean of the label over
  its rows; training rows take the mean of the other folds, so no row sees its
  own label.
* :class:`Binner`: a number becomes the number of its quantile bin.
* :class:`Imputer`: a missing number becomes the column's median, with a flag.

Each is fitted by aggregates.  Edges and medians are applied as column
expressions; encodings, whose size follows the categories, by a join.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------- target encoding

def fold_of(key: str, folds: int) -> Column:
    """A row's fold, by a hash of its key that other engines have too."""
    return (F.conv(F.substring(F.md5(F.col(f"`{key}`").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % folds).cast("int")


@dataclass(frozen=True)
class TargetEncoder:
    """Smoothed label means: ``(sum + weight * prior) / (n + weight)``, the prior being the mean of all rows counted.

    ``key`` deals rows to folds: all rows of a key (a seller's months) share
    one.  A missing category is one of its own; an unseen one gets the prior.
    ``table`` holds a row per column and category, with its rows and labels in
    all and by fold; ``totals`` the rows and labels of each fold.
    """

    columns: tuple[str, ...]
    key: str
    folds: int
    weight: float
    totals: tuple[tuple[int, int], ...]
    table: DataFrame

    @classmethod
    def fit(cls, rows: DataFrame, columns: Sequence[str], label: str = "fl_venda", key: str = "seller_id", folds: int = 5,
            weight: float = 10.0) -> "TargetEncoder":
        """Rows without a label teach nothing."""
        own = rows.where(F.col(f"`{label}`").isNotNull()).select(
            F.array(*(F.struct(F.lit(c).alias("feature"), _category(c).alias("category")) for c in columns)).alias("x"),
            fold_of(key, folds).alias("fold"), F.col(f"`{label}`").cast("long").alias("y"))
        per_fold = (own.select(F.explode("x").alias("x"), "fold", "y").groupBy("x.feature", "x.category", "fold")
                    .agg(F.count("*").alias("n"), F.sum("y").alias("total")))
        table = per_fold.groupBy("feature", "category").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"),
            F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "total")))).alias("by_fold"))  # <= folds entries
        found = {r.fold: (r.n, r.total) for r in own.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("total")).collect()}
        return cls(tuple(columns), key, folds, weight, tuple(found.get(k, (0, 0)) for k in range(folds)), table)

    def priors(self, training: bool) -> list[float | None]:
        """The mean label: over all rows, or for each fold over the others."""
        n, total = (sum(x) for x in zip(*self.totals))
        return [(total - b) / (n - a) if n - a else None for a, b in (self.totals if training else [(0, 0)])]

    def transform(self, rows: DataFrame, training: bool = False, suffix: str = "_te") -> DataFrame:
        """``rows`` with a column ``<column><suffix>`` each; ``training``: out of fold."""
        priors = F.array(*(F.lit(p).cast("double") for p in self.priors(training)))
        fold = fold_of(self.key, self.folds) if training else F.lit(0)
        out = rows.select(F.struct("*").alias("row"), fold.alias("fold"), F.get(priors, fold).alias("prior"),
                          *(_category(c).alias(f"own_{i}") for i, c in enumerate(self.columns)))
        prior, weight = F.col("prior"), F.lit(float(self.weight))
        for i, column in enumerate(self.columns):
            table = self.table.where(F.col("feature") == column).drop("feature")
            n, total = F.col("n"), F.col("total")
            if training:  # a fold that lacks the category leaves its sums whole
                mine = F.element_at("by_fold", F.col("fold"))
                n, total = n - F.coalesce(mine["n"], F.lit(0)), total - F.coalesce(mine["total"], F.lit(0))
            value = F.try_divide(total.cast("double") + weight * prior, n.cast("double") + weight)
            out = (out.join(table, F.col(f"own_{i}") == F.col("category"), "left")
                   .withColumn(f"value_{i}", F.coalesce(value, prior)).drop(*table.columns))
        return out.select("row.*", *(F.col(f"value_{i}").alias(f"{c}{suffix}") for i, c in enumerate(self.columns)))


def _category(column: str) -> Column:
    """A category as text; a missing one has a name that no present one has."""
    x = F.col(f"`{column}`").cast("string")
    return F.when(x.isNull(), F.lit("missing")).otherwise(F.concat(F.lit("="), x))


# ---------------------------------------------------------------- quantiles

#: ranges that the distinct values of a column are cut into; a task sorts those of one
RANGES = 128


def exact_quantiles(rows: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> list[list[float | None]]:
    """For each column the least value with at least each share of the present ones at or below it (``percentile_disc``).

    No task holds a column: distinct values are counted (one pass over
    ``rows``, kept while this runs), cut into ``RANGES`` ranges of about as many
    by a sketch, and the ranges' rows summed; only the ranges in which a
    quantile falls are then run through in order.  Where the cuts lie doesn't
    change the result.
    """
    pairs = F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(columns)))
    counts = (rows.select(F.explode(pairs).alias("p")).select("p.*").where("x IS NOT NULL")
              .groupBy("i", "x").agg(F.count("*").alias("n"))).persist()
    try:
        cuts = {r.i: sorted({x for x in r.at if x == x}) for r in counts.groupBy("i").agg(  # NaN lies over every cut
            F.percentile_approx("x", [k / RANGES for k in range(1, RANGES)], 10 * RANGES).alias("at")).collect()}
        at = F.lit(None).cast("array<double>")
        for i, edges in cuts.items():
            at = F.when(F.col("i") == i, F.array(*map(F.lit, edges)).cast("array<double>")).otherwise(at)
        x = F.col("x")
        counts = counts.withColumn("part", F.size(F.filter(at, lambda edge: edge < x)))
        sizes = sorted(tuple(r) for r in counts.groupBy("i", "part").agg(F.sum("n")).collect())  # <= RANGES a column
        wanted, before = [], {}
        totals = {i: sum(n for j, _, n in sizes if j == i) for i in cuts}
        for i, p, n in sizes:
            low = before.get(i, 0)
            before[i] = low + n
            for k, s in enumerate(shares):
                rank = math.ceil(totals[i] * s)
                if low < rank <= low + n:
                    wanted.append((i, p, k, rank - low))
        found = [[None] * len(shares) for _ in columns]
        if wanted:
            held = functools.reduce(lambda a, b: a | b, [(F.col("i") == i) & (F.col("part") == p) for i, p in dict.fromkeys(w[:2] for w in wanted)])
            upto = counts.where(held).withColumn("upto", F.sum("n").over(Window.partitionBy("i", "part").orderBy("x")))
            least = [F.min_by("x", F.when((F.col("i") == i) & (F.col("part") == p) & (F.col("upto") >= r), F.col("upto"))).alias(f"w{j}")
                     for j, (i, p, _, r) in enumerate(wanted)]
            row = upto.agg(*least).first()
            for j, (i, _, k, _) in enumerate(wanted):
                found[i][k] = row[f"w{j}"]
        return found
    finally:
        counts.unpersist()


# ---------------------------------------------------------------- bins

@dataclass(frozen=True)
class Binner:
    """Quantile bins: bin k holds the values over edge k - 1 and up to edge k; missing values have bin -1."""

    edges: dict[str, tuple[float, ...]]

    @classmethod
    def fit(cls, rows: DataFrame, columns: Sequence[str], bins: int = 10, error: float | None = None) -> "Binner":
        """Edges at the quantiles 1/bins .. (bins-1)/bins: stored values, each once.

        ``error`` None: exact (:func:`exact_quantiles`).  Else the quantile sketch of
        ``percentile_approx`` with that error in rank, as a share of the rows;
        its size follows 1 / error alone.  All columns in one aggregate.
        """
        shares = [k / bins for k in range(1, bins)]
        if error is None:
            found = exact_quantiles(rows, columns, shares)
        else:
            found = rows.agg(*(F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, int(round(1 / error))).alias(f"q{i}")
                               for i, c in enumerate(columns))).first()
        return cls({c: tuple(sorted({float(x) for x in found[i] or [] if x is not None})) for i, c in enumerate(columns)})

    def column(self, name: str) -> Column:
        x, edges = F.col(f"`{name}`").cast("double"), self.edges[name]
        # a balanced tree of comparisons: as deep as the logarithm of the bins

        def within(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(x <= F.lit(edges[mid]), within(lo, mid)).otherwise(within(mid + 1, hi))
        return F.when(x.isNull() | F.isnan(x), F.lit(-1)).otherwise(within(0, len(edges)))

    def transform(self, rows: DataFrame, suffix: str = "_bin") -> DataFrame:
        return rows.select("*", *(self.column(c).alias(f"{c}{suffix}") for c in self.edges))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(self.edges),)], "edges string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Binner":
        return cls({c: tuple(e) for c, e in json.loads(spark.read.text(path).first()[0]).items()})


# ---------------------------------------------------------------- medians

@dataclass(frozen=True)
class Imputer:
    """Missing numbers as the median of the present ones (0 if there are none), and whether they were missing."""

    medians: dict[str, float]

    @classmethod
    def fit(cls, rows: DataFrame, columns: Sequence[str], error: float | None = None) -> "Imputer":
        if error is None:
            found = [m for m, in exact_quantiles(rows, columns, [0.5])]
        else:
            found = rows.agg(*(F.percentile_approx(F.col(f"`{c}`").cast("double"), 0.5, int(round(1 / error))).alias(f"m{i}")
                               for i, c in enumerate(columns))).first()
        return cls({c: 0.0 if found[i] is None else float(found[i]) for i, c in enumerate(columns)})

    def transform(self, rows: DataFrame, suffix: str = "_filled", flag: str = "_missing") -> DataFrame:
        return rows.select("*", *(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(m)).alias(f"{c}{suffix}") for c, m in self.medians.items()),
                           *(F.col(f"`{c}`").isNull().cast("int").alias(f"{c}{flag}") for c in self.medians))
