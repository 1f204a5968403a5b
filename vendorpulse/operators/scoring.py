"""Batch scoring of the feature table.

Three interchangeable scorers, all producing ``dt_ref, seller_id, fl_venda_predict``:

* a saved Spark ML ``PipelineModel`` plus its ordered feature list
  (``fit_vars``), picked as the newest version in a model folder;
* any Python object with ``.predict(pandas.DataFrame)``, applied per Arrow
  batch with ``mapInPandas`` (the object is pickled once with the function);
* :class:`LinearScorer`, a fixed-weight logistic model that is also an
  ordinary column expression (and therefore SQL-checkable).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("dt_ref", "seller_id")
PREDICTION = "fl_venda_predict"


@dataclass(frozen=True)
class LinearScorer:
    """``1`` when ``intercept + Σ w·x >= logit(threshold)``; NULL features count as 0."""
    fit_vars: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float = 0.0
    threshold: float = 0.5
    cut: float = field(init=False)

    def __post_init__(self):
        if len(self.fit_vars) != len(self.weights):
            raise ValueError("one weight per feature")
        object.__setattr__(self, "cut", math.log(self.threshold / (1.0 - self.threshold)))

    def margin(self) -> Column:
        z = F.lit(float(self.intercept))
        for v, w in zip(self.fit_vars, self.weights):
            z = z + F.lit(float(w)) * F.coalesce(F.col(v).cast("double"), F.lit(0.0))
        return z

    def column(self) -> Column:
        return F.when(self.margin() >= F.lit(self.cut), 1).otherwise(0)

    def predict(self, pdf: pd.DataFrame) -> np.ndarray:
        z = np.full(len(pdf), float(self.intercept))
        for v, w in zip(self.fit_vars, self.weights):
            z = z + float(w) * pdf[v].astype("float64").fillna(0.0).to_numpy()
        return (z >= self.cut).astype("int32")


def score_with_column(abt: DataFrame, scorer: LinearScorer) -> DataFrame:
    """B3-B5 as one projection: stays in whole-stage codegen."""
    return abt.select(*KEYS, scorer.column().alias(PREDICTION))


@dataclass(frozen=True)
class CategoryScorer:
    """A real-valued score: ``intercept + Σ w·x`` and an offset by category; missing numbers and other categories count as 0."""
    numbers: tuple[str, ...]
    weights: tuple[float, ...]
    category: str
    offsets: tuple[tuple[str, float], ...]
    intercept: float = 0.0

    @property
    def fit_vars(self) -> tuple[str, ...]:
        return (*self.numbers, self.category)

    def predict(self, pdf: pd.DataFrame) -> np.ndarray:
        z = np.full(len(pdf), float(self.intercept))
        for v, w in zip(self.numbers, self.weights):
            z = z + float(w) * pdf[v].astype("float64").fillna(0.0).to_numpy()
        return z + pdf[self.category].map(dict(self.offsets)).astype("float64").fillna(0.0).to_numpy()


PREDICTION_TYPES = {"int": T.IntegerType(), "double": T.DoubleType()}


def _features(abt: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The features in their own types; decimals, which models don't take, as doubles."""
    return [(F.col(c).cast("double") if isinstance(abt.schema[c].dataType, T.DecimalType) else F.col(c)).alias(c)
            for c in columns]


def score_with_predict(abt: DataFrame, model, fit_vars: Sequence[str], prediction_type: str = "int") -> DataFrame:
    """B4 for any object with ``.predict``: Arrow batches through ``mapInPandas``.

    Only the keys and ``fit_vars`` (in that order, in their own types) cross
    into Python.  ``prediction_type``: ``int`` raises on a fraction, ``double``
    passes predictions through.
    """
    cols = list(fit_vars)
    kind = PREDICTION_TYPES[prediction_type]
    out_schema = T.StructType([*(abt.schema[k] for k in KEYS), T.StructField(PREDICTION, kind)])

    def run(batches):
        for pdf in batches:
            pred = np.asarray(model.predict(pdf[cols]))
            if prediction_type == "int":
                whole = pred.astype("int32")
                if not np.array_equal(whole, pred):
                    raise ValueError("the model's predictions aren't whole numbers: use prediction_type='double'")
                pred = whole
            yield pd.DataFrame({KEYS[0]: pdf[KEYS[0]], KEYS[1]: pdf[KEYS[1]], PREDICTION: pred})

    return abt.select(*KEYS, *_features(abt, cols)).mapInPandas(run, out_schema)


# ----------------------------------------------------------------- Spark ML path

def newest_version(models_dir: str, spark: SparkSession | None = None) -> str:
    """B1: the greatest version name in ``models_dir`` (names carry a sortable date) that was saved to its end."""
    fs, folder = _folder(models_dir, spark or SparkSession.getActiveSession())
    names = sorted((s.getPath().getName() for s in fs.listStatus(folder)), reverse=True) if fs.exists(folder) else []
    for name in names:
        if not name.startswith((".", "_")) and all(
                fs.exists(_path(f"{models_dir.rstrip('/')}/{name}/{part}/_SUCCESS", spark))
                for part in ("pipeline/metadata", "fit_vars")):
            return name
    raise FileNotFoundError(f"no model under {models_dir}")


def _path(path: str, spark: SparkSession | None):
    return (spark or SparkSession.getActiveSession())._jvm.org.apache.hadoop.fs.Path(path)


def _folder(path: str, spark: SparkSession):
    """The path on its Hadoop file system (the default one if it has no scheme), as Spark reads and writes it."""
    p = _path(path, spark)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def train_pipeline(abt: DataFrame, fit_vars: Sequence[str], label: str = "fl_venda", max_iter: int = 50):
    """Sample model: numbers with missing ones at the median, text encoded by category, logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler

    data = _prepared(abt, fit_vars).withColumn("label", F.col(label).cast("double"))
    text = [c for c in fit_vars if isinstance(abt.schema[c].dataType, T.StringType)]
    numbers = [c for c in fit_vars if c not in text]
    stages = []
    if numbers:
        stages.append(Imputer(inputCols=numbers, outputCols=[f"{c}__i" for c in numbers], strategy="median"))
    if text:
        stages += [StringIndexer(inputCols=text, outputCols=[f"{c}__n" for c in text], handleInvalid="keep"),
                   OneHotEncoder(inputCols=[f"{c}__n" for c in text], outputCols=[f"{c}__i" for c in text])]
    stages += [VectorAssembler(inputCols=[f"{c}__i" for c in fit_vars], outputCol="features", handleInvalid="keep"),
               LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter)]
    return Pipeline(stages=stages).fit(data)


def _prepared(abt: DataFrame, fit_vars: Sequence[str]) -> DataFrame:
    """Keys, label and features for Spark ML: text as it is, every number as a double."""
    rest = [c for c in ("fl_venda",) if c in abt.columns and c not in fit_vars]
    return abt.select(*KEYS, *rest, *(F.col(c) if isinstance(abt.schema[c].dataType, T.StringType)
                                      else F.col(c).cast("double").alias(c) for c in fit_vars))


def save_model(model, fit_vars: Sequence[str], models_dir: str, version: str) -> str:
    """B2: ``<models_dir>/<version>/{pipeline, fit_vars}``; the feature list is written last."""
    path = f"{models_dir.rstrip('/')}/{version}"
    model.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(list(fit_vars)),)], "fit_vars string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/fit_vars")
    return path


def load_model(models_dir: str, spark: SparkSession, version: str | None = None):
    """B1 + B2: newest (or the named) pipeline and its ordered feature list."""
    from pyspark.ml import PipelineModel

    version = version or newest_version(models_dir, spark)
    path = f"{models_dir.rstrip('/')}/{version}"
    fit_vars = json.loads(spark.read.text(f"{path}/fit_vars").first()[0])
    return PipelineModel.load(f"{path}/pipeline"), fit_vars


def score_with_pipeline(abt: DataFrame, model, fit_vars: Sequence[str], prediction_type: str = "int") -> DataFrame:
    """B3-B5 with a Spark ML pipeline (runs in the JVM, no Python round trip)."""
    whole = F.col("prediction").cast("double")
    if prediction_type == "int":
        whole = F.when(whole == F.floor(whole), whole).otherwise(
            F.raise_error(F.lit("the model's predictions aren't whole numbers: use prediction_type='double'"))
            .cast("double"))
    return model.transform(_prepared(abt, list(fit_vars))).select(
        *KEYS, F.when(F.col("prediction").isNotNull(), whole).cast(PREDICTION_TYPES[prediction_type]).alias(PREDICTION))
