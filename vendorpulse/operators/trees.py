"""Gradient-boosted trees: trained by Spark ML, applied as one column expression.

A trained ensemble is read out of its model into plain nodes and compiled to
nested ``CASE WHEN`` over the feature columns, so scoring is a projection of the
feature table, and the same text is SQL that any engine can run.  A row goes
left where ``feature <= threshold``; a missing one goes right.  Spark ML takes no
missing values, so in training they stand above every present one
(:func:`beyond`), which sends them right at every split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scoring import KEYS, PREDICTION


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: str
    threshold: float
    left: "Split | Leaf"
    right: "Split | Leaf"


def _number(x: float) -> str:
    return f"cast('{float(x)!r}' as double)"


def _sql(node: Split | Leaf, quote: str) -> str:
    if isinstance(node, Leaf):
        return _number(node.value)
    return (f"case when cast({quote}{node.feature}{quote} as double) <= {_number(node.threshold)} "
            f"then {_sql(node.left, quote)} else {_sql(node.right, quote)} end")


def _features(node: Split | Leaf) -> list[str]:
    return [] if isinstance(node, Leaf) else [node.feature, *_features(node.left), *_features(node.right)]


@dataclass(frozen=True)
class TreeScorer:
    """``Σ weight · tree``, 1 where it is over ``cut``."""

    trees: tuple[Split | Leaf, ...]
    weights: tuple[float, ...]
    cut: float = 0.0

    def __post_init__(self):
        if len(self.trees) != len(self.weights) or not self.trees:
            raise ValueError("one weight per tree, one tree at least")

    @property
    def fit_vars(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(f for t in self.trees for f in _features(t)))

    def margin_sql(self, quote: str = "`") -> str:
        """The sum of the trees, added up in their order; ``quote`` encloses column names."""
        total = f"{_number(self.weights[0])} * {_sql(self.trees[0], quote)}"
        for w, t in zip(self.weights[1:], self.trees[1:]):
            total = f"({total}) + {_number(w)} * {_sql(t, quote)}"
        return total

    def sql(self, quote: str = "`") -> str:
        return f"case when {self.margin_sql(quote)} > {_number(self.cut)} then 1 else 0 end"

    def margin(self) -> Column:
        return F.expr(self.margin_sql())

    def column(self) -> Column:
        return F.expr(self.sql())

    @classmethod
    def of_model(cls, model, features: Sequence[str]) -> "TreeScorer":
        """From a fitted ``GBTClassificationModel`` or ``GBTRegressionModel`` over numeric ``features``, in their order."""
        def node(n):
            if n.subtreeDepth() == 0:
                return Leaf(n.prediction())
            split = n.split()
            if not split.getClass().getSimpleName().startswith("Continuous"):
                raise ValueError("categorical splits aren't columns: encode categories as numbers first")
            return Split(features[split.featureIndex()], split.threshold(), node(n.leftChild()), node(n.rightChild()))
        return cls(tuple(node(t._call_java("rootNode")) for t in model.trees), tuple(float(w) for w in model.treeWeights))


def score_with_trees(abt: DataFrame, scorer: TreeScorer) -> DataFrame:
    """B3-B5 as one projection."""
    return abt.select(*KEYS, scorer.column().alias(PREDICTION))


def beyond(rows: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """For each feature a number above all its values."""
    top = rows.agg(*(F.max(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(f"x{i}") for i, c in enumerate(features))).first()
    return {c: 0.0 if top[f"x{i}"] is None else top[f"x{i}"] + max(1.0, abs(top[f"x{i}"])) for i, c in enumerate(features)}


def vectors(rows: DataFrame, fills: dict[str, float]) -> DataFrame:
    """``rows`` with a vector column ``features`` of the named features, missing ones filled."""
    from pyspark.ml.feature import VectorAssembler

    names = [f"tree_x{i}" for i in range(len(fills))]
    filled = rows.select("*", *(F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(x)).alias(n)
                                for n, (c, x) in zip(names, fills.items())))
    return VectorAssembler(inputCols=names, outputCol="features").transform(filled).drop(*names)


def train_trees(rows: DataFrame, features: Sequence[str], label: str = "fl_venda", trees: int = 20, depth: int = 4,
                bins: int = 64, seed: int = 1, checkpoint_every: int = 10) -> TreeScorer:
    """Boosted trees of a 0/1 label by Spark ML, on numeric features that may be missing.

    Split candidates are quantiles of each feature, and each level of a tree is
    one aggregate over the rows, so neither follows the rows on the driver.
    """
    from pyspark.ml.classification import GBTClassifier

    text = [c for c in features if isinstance(rows.schema[c].dataType, T.StringType)]
    if text:
        raise ValueError(f"text features must be encoded first: {text}")
    numbers = vectors(rows.select(F.col(label).cast("double").alias("label"), *(f"`{c}`" for c in features if c != label)),
                      beyond(rows, features))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=bins, seed=seed,
                        checkpointInterval=checkpoint_every)
    return TreeScorer.of_model(gbt.fit(numbers.select("label", "features")), list(features))
