"""Price regression: features, split, models, ranking."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.operators.forest import ForestModel, ForestRegressor
from citymart.operators.standardize import fill_missing, numeric_text
from citymart.session import side_by_side

# The listing columns a model sees, and what replaces their NULLs.
MODEL_COLUMNS = [
    "neighborhood",
    "latitude",
    "longitude",
    "property_type",
    "size_m2",
    "rooms",
    "bathrooms",
    "floor",
    "status",
    "price_eur",
    "is_exterior",
    "has_lift",
    "has_parking",
]
CATEGORICAL = ["neighborhood", "property_type", "status"]
DEFAULTS = {"neighborhood": "unknown", "status": "good", "floor": 0}
TARGET = "price"

# The training rows are spread over so many partitions at least, and over more where one would hold more rows.
# Forests draw their samples by partition, so the number follows from the rows and not from the cluster.
PARTITIONS = 32
ROWS_PER_PARTITION = 1_000_000


def model_rows(
    listings: DataFrame, columns: Sequence[str] = MODEL_COLUMNS, keep: Sequence[str] = ()
) -> DataFrame:
    """Listings reduced to model columns; floors that are not plain numbers drop out."""
    chosen = listings.select(*keep, *columns)
    filled = fill_missing(chosen, {c: v for c, v in DEFAULTS.items() if c in columns})
    renamed = filled.withColumnRenamed("price_eur", TARGET)
    return numeric_text(renamed, "floor") if "floor" in columns else renamed


def split(df: DataFrame, keys: Sequence[str], train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows by a hash of the keys.

    A row's side depends on its key alone: a recomputed or differently partitioned input splits the
    same way, and copies of a row never sit on both sides. Any engine that knows MD5 splits alike.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def feature_stages(df: DataFrame, ignore: Sequence[str] = ()) -> list[Estimator]:
    """Index the text columns (unseen values are skipped) and assemble all features."""
    numeric = [c for c in df.columns if c not in (*CATEGORICAL, TARGET, *ignore)]
    text = [c for c in CATEGORICAL if c in df.columns]
    indexed = [f"{c}_idx" for c in text]
    indexer = [StringIndexer(inputCols=text, outputCols=indexed, handleInvalid="skip")] if text else []
    return [*indexer, VectorAssembler(inputCols=numeric + indexed, outputCol="features")]


def regressors(seed: int = 42, trees: int = 100) -> dict[str, Estimator]:
    """The competing models."""
    return {
        "LinearRegression": LinearRegression(labelCol=TARGET, maxIter=100),
        "RandomForestRegressor": ForestRegressor(labelCol=TARGET, numTrees=trees, maxBins=128, seed=seed),
    }


def _with_bins(model: Estimator, prepared: PipelineModel) -> Estimator:
    """The model with a bin for every label, where it needs one and would have fewer."""
    labels = [len(found) for s in prepared.stages if isinstance(s, StringIndexerModel) for found in s.labelsArray]
    if not labels or not model.hasParam("maxBins") or model.getOrDefault("maxBins") >= max(labels):
        return model
    return model.copy({model.getParam("maxBins"): max(labels)})


def train(
    rows: DataFrame,
    keys: Sequence[str],
    models: Mapping[str, Estimator] | None = None,
    train_percent: int = 80,
    seed: int = 42,
    partitions: int | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every model and rank them: ``(model, rmse)`` best first, and the fitted pipelines.

    Features are fitted on the training rows only. The algorithms pass over the rows many times, so
    these are spread evenly once, in the order of their keys, and kept for the duration of the fits, which
    run side by side. They are kept on disk, and so is the forest's own copy, which holds a count for every tree.
    ``partitions`` is their least number: large tables get one for each ``ROWS_PER_PARTITION`` rows.
    ``rows`` is read four times: pass a stored table.
    """
    spark = rows.sparkSession
    partitions = max(partitions or PARTITIONS, math.ceil(rows.count() / ROWS_PER_PARTITION))
    training, validation = split(rows, keys, train_percent, seed)
    prepared = Pipeline(stages=feature_stages(rows, ignore=keys)).fit(training)
    needed = ["features", TARGET]

    def ready(part: DataFrame) -> DataFrame:
        spread = prepared.transform(part).repartition(partitions, *keys).sortWithinPartitions(*keys)
        return spread.select(*needed).persist(StorageLevel.DISK_ONLY)

    train_set, validation_set = ready(training), ready(validation)
    evaluator = RegressionEvaluator(labelCol=TARGET, metricName="rmse")
    try:
        candidates = dict(models or regressors(seed))

        def fit(name: str) -> tuple[Model, float]:
            regression = _with_bins(candidates[name], prepared).fit(train_set)
            predicted = (
                regression.predictions(validation_set, TARGET)
                if isinstance(regression, ForestModel)
                else regression.transform(validation_set)
            )
            return regression, evaluator.evaluate(predicted)

        found = dict(zip(candidates, side_by_side(spark, fit, list(candidates), len(candidates))))
        fitted = {name: PipelineModel(stages=[*prepared.stages, model]) for name, (model, _) in found.items()}
        scores = [(name, score) for name, (_, score) in found.items()]
    finally:
        train_set.unpersist()
        validation_set.unpersist()
    return leaderboard(spark.createDataFrame(scores, "model string, rmse double")), fitted


def leaderboard(scores: DataFrame) -> DataFrame:
    """Models by error, smallest first."""
    return scores.orderBy("rmse", "model")


def best_model(scores: DataFrame) -> str:
    return scores.orderBy("rmse", "model").first()["model"]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def feature_names(model: PipelineModel) -> list[str]:
    """What stands at each place of a fitted pipeline's feature vector."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def labels(model: PipelineModel) -> list[tuple[str, str, int]]:
    """Column, label and index of every label a fitted pipeline knows: the most frequent first, ties by label."""
    indexers = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    return [
        (column, label, index)
        for s in indexers
        for column, found in zip(s.getInputCols(), s.labelsArray)
        for index, label in enumerate(found)
    ]


def signature(model: PipelineModel, rows: DataFrame) -> dict[str, dict[str, str]]:
    """Names and types of the columns a fitted pipeline needs and of those it adds."""
    made = {c for s in model.stages if isinstance(s, StringIndexerModel) for c in s.getOutputCols()}
    raw = [c for s in model.stages if isinstance(s, StringIndexerModel) for c in s.getInputCols()]
    needed = [c for c in feature_names(model) if c not in made] + raw
    kinds = {f.name: f.dataType.simpleString() for f in model.transform(rows).schema}
    return {
        "inputs": {c: kinds[c] for c in rows.columns if c in needed},
        "outputs": {c: kinds[c] for c in ("features", "prediction")},
    }


def save_signature(model: PipelineModel, rows: DataFrame, path: str) -> None:
    """Store the signature as one JSON document in the folder ``path``."""
    text = json.dumps(signature(model, rows), indent=2)
    rows.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_signature(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def model_example(model: PipelineModel, rows: DataFrame, n: int = 5) -> DataFrame:
    """A few inputs with their predictions, to store beside a model."""
    return model.transform(rows.limit(n)).select("features", "prediction")
