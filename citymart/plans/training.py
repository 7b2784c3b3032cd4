"""Price models from the formatted listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession

from citymart.operators import regress
from citymart.session import scratch, stage
from citymart.sources import tables


def run_training(
    spark: SparkSession,
    formatted_zone: str,
    model_path: str,
    fmt: str = tables.DEFAULT_FORMAT,
    trees: int = 100,
    columns: Sequence[str] = regress.MODEL_COLUMNS,
    models: Mapping[str, Estimator] | None = None,
) -> DataFrame:
    """Train all models, save the best with its signature and an example, and return the ranking."""
    listings = tables.read_mart(spark, formatted_zone, "idealista", fmt)
    key = ["property_code"]
    with scratch(spark):
        rows = stage(regress.model_rows(listings, columns, keep=key), "model-rows")
        ranking, fitted = regress.train(rows, key, models or regress.regressors(trees=trees))
        best = fitted[regress.best_model(ranking)]
        regress.save_model(best, f"{model_path}/model")
        regress.save_signature(best, rows, f"{model_path}/signature")
        regress.model_example(best, rows).write.mode("overwrite").parquet(f"{model_path}/example")
    return ranking
