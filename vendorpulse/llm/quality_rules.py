"""Quality rules: robust multivariate outliers.

Statistics of each whole text are SQL expressions within its row.  Their
transformed vector is held against a minimum-covariance-determinant estimate
of its language and source: from two starts (medians with median deviations;
means with plain covariances) concentration steps re-estimate mean and
covariance from the ``share`` of rows nearest by Mahalanobis distance, all rows
taking part in each step, until no determinant changes by more than
``settled`` (in its logarithm; ``steps`` steps at most), and the start that ends
with the smaller determinant counts.  A row is rejected beyond the chi-square
quantile of ``1 - tail``.

A small group's estimate leans on its language's, and that on the estimate over
all rows: mean and covariance are n / (n + ``prior_rows``) the group's own, for
n rows, and the rest its parent's.  So no group's size switches its estimate.

All steps aggregate by group before any shuffle, so a source with a third of
the rows costs a partial sum a task.  ``floor`` is the least standard deviation
of each coordinate: a statistic that is 0 for most texts has no spread of its
own.

Nulls: a null text has no words and isn't kept; null languages and sources are
groups of their own; a null ``doc_id`` is kept as an id.  Repeated rows are
judged each.  An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLANKS = " \t\n\x0b\f\r"
P = 5
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]
_MOMENTS = [*(f"m{i}" for i in range(P)), *(f"c{i}{j}" for i, j in _LOWER)]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))


def repeat_words(w: Column, n: int = 3) -> Column:
    """Words within ``n``-word windows that the text has twice or more."""
    def of_hashes(h):
        def of_sorted(s):
            same = lambda a, b: (a > 0) & (b <= F.size(s)) & (F.element_at(s, F.greatest(a, F.lit(1)))["h"]
                                                             == F.element_at(s, F.least(b, F.size(s)))["h"])
            again = F.filter(s, lambda x, i: same(i, i + 1) | same(i + 1, i + 2))
            return _let(F.array_sort(F.transform(again, lambda x: x["i"])), of_places)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), of_sorted))

    def of_places(at):
        step = F.transform(at, lambda x, i: F.when(i + 1 == F.size(at), F.lit(n)).otherwise(
            F.least(F.lit(n), F.element_at(at, F.least(i + 2, F.size(at))) - x)))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def windows(v):
        return F.transform(F.sequence(F.lit(1), F.size(v) - (n - 1)),
                           lambda i: F.xxhash64(*(F.element_at(v, i + k) for k in range(n))))

    return F.when(F.size(w) <= n, F.lit(0)).otherwise(_let(windows(w), of_hashes))


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(rows: DataFrame) -> DataFrame:
    """``rows`` without its column ``text``, with the statistics of that; each row's words are split once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    of_words = _let(words(text), lambda w: F.struct(
        F.size(w).alias("n_words"), F.char_length(F.array_join(w, "")).alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    found = rows.select(*(c for c in rows.columns if c != "text"), of_words.alias("of_words"),
                        (F.char_length(text) - F.char_length(F.regexp_replace(text, "[#*$%&|<>]", ""))).alias("n_symbols"),
                        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
    return found.select(*(c for c in rows.columns if c != "text"),
                        *(F.col(c if c in found.columns else f"of_words.{c}").cast("long").alias(c) for c in STATISTICS))


def vector() -> list[Column]:
    """The transformed statistics: logarithms of sizes, shares on a root scale."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p("n_words"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.sqrt(F.col("n_symbols") / n),
            F.log1p("n_dup_lines"), F.sqrt(F.col("n_repeat_words") / n)]


def chi_square_tail(x: float, k: int) -> float:
    """P(chi-square with k degrees > x)."""
    if k == 1:
        return math.erfc(math.sqrt(x / 2))
    if k == 2:
        return math.exp(-x / 2)
    return chi_square_tail(x, k - 2) + math.exp((k / 2 - 1) * math.log(x / 2) - x / 2 - math.lgamma(k / 2)) if x > 0 else 1.0


def chi_square_quantile(tail: float, k: int) -> float:
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_tail(mid, k) > tail else (lo, mid)
    return hi


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from m0.., with the inverse Cholesky factor i_jk."""
    total = F.lit(0.0)
    for i in range(P):
        y = F.lit(0.0)
        for k in range(i + 1):
            y = y + F.col(f"i{i}{k}") * (F.col(f"x{k}") - F.col(f"m{k}"))
        total = total + y * y
    return total


def _factored(moments: DataFrame, *keys: str) -> DataFrame:
    """From m0.. and covariances c_jk: the inverse of the Cholesky factor and the logarithm of the determinant."""
    df = moments
    for i, j in _LOWER:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
        df = df.withColumn(f"l{i}{j}", value)
    for j in range(P):  # columns of the inverse
        df = df.withColumn(f"i{j}{j}", 1 / F.col(f"l{j}{j}"))
        for i in range(j + 1, P):
            total = F.lit(0.0)
            for k in range(j, i):
                total = total + F.col(f"l{i}{k}") * F.col(f"i{k}{j}")
            df = df.withColumn(f"i{i}{j}", -total / F.col(f"l{i}{i}"))
    log_det = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0))
    return df.select(*keys, *_MOMENTS, *(f"i{i}{j}" for i, j in _LOWER), log_det.alias("log_det"))


def _moments(rows: DataFrame, floor: list[float], *keys: str) -> DataFrame:
    sums = rows.groupBy(*keys).agg(*(F.avg(f"x{i}").alias(f"m{i}") for i in range(P)),
                                   *(F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _LOWER))
    cov = [(F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (F.lit(floor[i] ** 2) if i == j else F.lit(0.0)))
           .alias(f"c{i}{j}") for i, j in _LOWER]
    return sums.select(*keys, *(f"m{i}" for i in range(P)), *cov)


def _quantile(c: str | Column, share: float) -> Column:
    return F.percentile_approx(c, F.lit(share), F.lit(1000))


def estimates(vectors: DataFrame, share: float, floor: list[float], steps: int, settled: float) -> DataFrame:
    """One row per group: n, its mean m0.. and its covariance c_jk, scaled.  ``vectors`` has g (null: all rows) and x0..."""
    middle = stored(vectors.groupBy("g").agg(F.count("*").alias("n"), *(
        _quantile(f"x{i}", 0.5).alias(f"m{i}") for i in range(P))), "outliers-medians")
    near = _with(vectors, middle.drop("n"))
    spread = near.groupBy("g").agg(*(F.first(f"m{i}").alias(f"m{i}") for i in range(P)), *(
        _quantile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5).alias(f"s{i}") for i in range(P)))
    robust = spread.select(F.lit(0).alias("start"), "g", *(f"m{i}" for i in range(P)), *(
        (F.pow(1.4826 * F.col(f"s{i}"), 2) + floor[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i, j in _LOWER))
    plain = _moments(near.drop(*(f"m{i}" for i in range(P))), floor, "g").withColumn("start", F.lit(1))
    now = stored(_factored(robust.unionByName(plain), "g", "start"), "outliers-start")
    for _ in range(steps):
        before = now
        rows = _with(vectors, now).withColumn("d", _distance())
        cut = stored(rows.groupBy("g", "start").agg(_quantile("d", share).alias("cut")), "outliers-cut")
        both = stored(_paired(now, cut), "outliers-step")
        nearest = _with(vectors, both).where(_distance() <= F.col("cut"))
        now = stored(_factored(_moments(nearest, floor, "g", "start"), "g", "start"), "outliers-step")
        moved = _paired(now.select("g", "start", "log_det"), before.select("g", "start", F.col("log_det").alias("old")))
        if (moved.agg(F.max(F.abs(F.col("log_det") - F.col("old")))).first()[0] or 0.0) <= settled:
            break
    best = now.groupBy("g").agg(F.min_by(F.struct(*(c for c in now.columns if c != "g")),
                                         F.struct("log_det", "start")).alias("e")).select("g", "e.*")
    best = stored(best, "outliers-best")
    # the nearest rows spread less than all: bring the median distance to that of a chi-square, at least by the
    # factor for normal rows
    at = chi_square_quantile(1 - share, P)
    normal = share / (1 - chi_square_tail(at, P + 2))
    mid = _with(vectors, best).withColumn("d", _distance()).groupBy("g").agg(
        F.greatest(_quantile("d", 0.5) / chi_square_quantile(0.5, P), F.lit(normal)).alias("scale"))
    scaled = _with(_with(best, mid), middle.select("g", "n"))
    return stored(scaled.select("g", "n", *(F.col(c) * F.col("scale") if c[0] == "c" else F.col(c) for c in _MOMENTS))
                  .toDF("g", "n", *_MOMENTS), "outliers-estimates")


def _paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of the same group and start."""
    other = b.withColumnsRenamed({"g": "g2", "start": "start2"})
    return a.join(other, F.col("g").eqNullSafe(F.col("g2")) & (F.col("start") == F.col("start2"))).drop("g2", "start2")


def leaning(parent, prior_rows: float) -> list[Column]:
    """n and the moments drawn toward ``parent(column)``, the less the more rows it has."""
    weight = F.col("n") / (F.col("n") + F.lit(float(prior_rows)))
    return [F.col("n"), *((weight * F.col(c) + (1 - weight) * parent(c)).alias(c) for c in _MOMENTS)]


def _with(rows: DataFrame, groups: DataFrame) -> DataFrame:
    own = groups.withColumnRenamed("g", "group_")
    return rows.join(own, F.col("g").eqNullSafe(F.col("group_"))).drop("group_")


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source",
          share: float = 0.75, tail: float = 1e-4, floor: tuple[float, ...] = (0.25, 0.1, 0.1, 0.25, 0.1),
          steps: int = 12, settled: float = 0.01, prior_rows: float = 30.0) -> DataFrame:
    """One row per row: doc_id, the statistics, distance (squared; null without words), outlier."""
    of_lang, of_source = F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{source}`").cast("string").alias("s")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.to_json(F.struct(of_lang, of_source, F.lit(1).alias("x"))).alias("g"),
                       F.to_json(F.struct(of_lang, F.lit(0).alias("x"))).alias("of_lang"), F.col(f"`{text}`").alias("text"))
    rows = stored(with_statistics(rows), "outliers-statistics")
    rows = rows.select("*", *(x.alias(f"x{i}") for i, x in enumerate(vector())))
    own = rows.where("n_words > 0")
    levels = F.explode(F.array("g", "of_lang", F.lit(None).cast("string"))).alias("g")
    found = estimates(own.select(levels, *(f"x{i}" for i in range(P))), share, list(floor), steps, settled)
    overall = found.where("g is null").first()
    overall = (lambda c, r=overall: F.lit(0.0 if r is None else r[c]))
    langs = found.select("g", *leaning(overall, prior_rows)).withColumnsRenamed(
        {"g": "of_lang", **{c: f"lang_{c}" for c in _MOMENTS}}).drop("n")
    groups = (own.select("g", "of_lang").distinct().join(found, "g").join(langs, "of_lang"))
    groups = groups.select("g", *leaning(lambda c: F.col(f"lang_{c}"), prior_rows))
    joined = rows.join(_factored(groups, "g"), "g", "left")
    distance = F.when(F.col("n_words") > 0, _distance())
    cut = chi_square_quantile(tail, P)
    return joined.withColumn("distance", distance).select(
        "doc_id", *STATISTICS, "distance", F.coalesce(F.col("distance") > cut, F.lit(False)).alias("outlier"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
