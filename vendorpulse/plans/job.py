"""The batch job: build the feature table, score it, or both.

::

    python -m vendorpulse.plans.job --roles-dir DIR --abt PATH --first 2018-07-01 --last 2018-09-01 \\
        [--format csv --option sep=; ...] [--versioned] [--build-only | --score-only] \\
        [--models DIR | --scorer MODULE:OBJECT] [--prediction-type int|double] [--predictions PATH]

``--roles-dir`` holds one table per role (``orders/``, ``items/`` …, any
format Spark reads, with the reader's options); ``--driver-tables`` maps the
TPC-H-like driver tables instead.  ``--models`` is a folder of saved
pipelines, ``--scorer`` any importable object with ``predict`` and
``fit_vars``.  The feature table is written partitioned by ``dt_ref`` (rerunning
a month replaces that month); predictions are written as CSV with a header
and no index column (S6).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import importlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions import dates as D
from ..operators import scoring
from ..sources.roles import Roles, driver_roles, read_roles
from ..sources.schemas import ROLES
from .abt import build_abt, publish_abt, read_abt, read_published, write_abt


def run_job(spark: SparkSession, roles: Roles, abt_path: str, dates: Iterable[str | _dt.date],
            build: bool = True, score: bool = True, models_dir: str | None = None,
            predictions_path: str | None = None, model_version: str | None = None, scorer=None,
            prediction_type: str = "int", versioned: bool = False) -> DataFrame | None:
    """Build and/or score; returns the predictions DataFrame when scoring.

    ``scorer``: an object with ``predict`` and ``fit_vars``, instead of a models folder.
    ``versioned``: the feature table is a versioned one, published in one step; scoring reads the version just built.
    """
    dates = D.ref_dates(dates)
    if score and (models_dir is None) == (scorer is None):
        raise ValueError("scoring needs a models folder or a scorer")
    version = None
    if build and versioned:
        version = publish_abt(build_abt(roles, dates), abt_path, dates)
    elif build:
        write_abt(build_abt(roles, dates), abt_path, dates=dates)
    if not score:
        return None
    abt = read_published(spark, abt_path, dates, version) if versioned else read_abt(spark, abt_path, dates)
    if scorer is not None:
        pred = scoring.score_with_predict(abt, scorer, scorer.fit_vars, prediction_type)
    else:
        model, fit_vars = scoring.load_model(models_dir, spark, model_version)
        pred = scoring.score_with_pipeline(abt, model, fit_vars, prediction_type)
    if predictions_path:
        pred.write.mode("overwrite").option("header", True).csv(predictions_path)
    return pred


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="vendorpulse-job")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--roles-dir")
    src.add_argument("--driver-tables")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="reader option")
    ap.add_argument("--abt", required=True)
    ap.add_argument("--versioned", action="store_true", help="publish the feature table as a new version, in one step")
    ap.add_argument("--first", required=True)
    ap.add_argument("--last", required=True)
    mode = ap.add_mutually_exclusive_group()
    mode.add_argument("--build-only", action="store_true")
    mode.add_argument("--score-only", action="store_true")
    model = ap.add_mutually_exclusive_group()
    model.add_argument("--models")
    model.add_argument("--scorer", metavar="MODULE:OBJECT")
    ap.add_argument("--prediction-type", choices=sorted(scoring.PREDICTION_TYPES), default="int")
    ap.add_argument("--model-version")
    ap.add_argument("--predictions")
    a = ap.parse_args(argv)

    from ..session import get_spark
    spark = get_spark()
    if a.driver_tables:
        roles = driver_roles(spark, a.driver_tables)
    else:
        roles = read_roles(spark, {r: f"{a.roles_dir.rstrip('/')}/{r}" for r in ROLES}, a.format,
                           dict(o.split("=", 1) for o in a.option))
    scorer = None
    if a.scorer:
        module, _, name = a.scorer.partition(":")
        scorer = getattr(importlib.import_module(module), name)
    run_job(spark, roles, a.abt, D.monthly_range(a.first, a.last), build=not a.score_only,
            score=not a.build_only, models_dir=a.models, predictions_path=a.predictions,
            model_version=a.model_version, scorer=scorer, prediction_type=a.prediction_type, versioned=a.versioned)


if __name__ == "__main__":
    main()
