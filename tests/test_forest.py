"""Forests as tables, labels, signatures, and partitions that follow the rows."""

import random
import re
from pathlib import Path

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from citymart.operators import forest, regress, trees
from citymart.operators.forest import ForestModel, ForestRegressor
from citymart.session import staging_dir


def listings(spark, n=400, seed=1):
    rng = random.Random(seed)
    kinds = ["flat", "duplex", "loft", "chalet"]
    rows = []
    for i in range(n):
        kind, size = rng.choice(kinds), rng.randrange(20, 200)
        rows.append((f"c{i}", kind, size, rng.randrange(1, 6), 1000.0 * size * (1 + kinds.index(kind)) + rng.random()))
    return spark.createDataFrame(rows, "property_code string, property_type string, size_m2 int, rooms int, price double")


@pytest.fixture(scope="module")
def fitted(spark):
    rows = listings(spark)
    forest = RandomForestRegressor(labelCol="price", numTrees=7, maxDepth=4, seed=3)
    stages = regress.feature_stages(rows, ignore=["property_code"])
    return Pipeline(stages=[*stages, forest]).fit(rows)


def test_predictions_by_nodes_equal_the_models(spark, fitted):
    rows = fitted.transform(listings(spark, seed=2))
    nodes = trees.forest_nodes(spark, fitted.stages[-1], regress.feature_names(fitted))
    assert nodes.filter("categories is not null").count() and nodes.filter("threshold is not null").count()
    found = trees.predict_by_nodes(rows, nodes, 7, 4, ["property_code"]).withColumnRenamed("prediction", "ours")
    both = rows.join(found, "property_code")
    assert both.count() == 400 and both.filter(F.abs(F.col("ours") - F.col("prediction")) > 1e-6).count() == 0


def test_nodes_of_every_tree(spark, fitted):
    nodes = trees.forest_nodes(spark, fitted.stages[-1], regress.feature_names(fitted)).collect()
    assert {n["tree"] for n in nodes} == set(range(7))
    assert len(nodes) == sum(t.numNodes for t in fitted.stages[-1].trees)
    names = set(regress.feature_names(fitted))
    for n in nodes:
        assert (n["feature"] is None) == (n["left"] is None) == (n["right"] is None)
        assert n["feature"] is None or n["feature"] in names


def test_repeated_keys_nulls_and_empty_tables(spark, fitted):
    nodes = trees.forest_nodes(spark, fitted.stages[-1], regress.feature_names(fitted))
    one = fitted.transform(listings(spark, 1))
    rows = one.select(F.lit(None).cast("string").alias("k"), "features")
    rows = rows.unionByName(rows).unionByName(rows.withColumn("features", F.when(F.lit(False), F.col("features"))))
    found = [tuple(r) for r in trees.predict_by_nodes(rows, nodes, 7, 4, ["k"]).collect()]
    want = one.first()["prediction"]
    assert sorted((p is None, round(p or 0, 6)) for _, p in found) == [(False, round(want, 6))] * 2 + [(True, 0)]
    assert trees.predict_by_nodes(rows.limit(0), nodes, 7, 4, ["k"]).collect() == []


def test_a_tree_of_one_node(spark):
    rows = listings(spark, 20).withColumn("price", F.lit(5.0))
    stages = regress.feature_stages(rows.drop("property_type"), ignore=["property_code"])
    fitted = Pipeline(stages=[*stages, RandomForestRegressor(labelCol="price", numTrees=2, maxDepth=3)]).fit(rows)
    nodes = trees.forest_nodes(spark, fitted.stages[-1], regress.feature_names(fitted))
    for depth in (0, 3):
        found = trees.predict_by_nodes(fitted.transform(rows), nodes, 2, depth, ["property_code"])
        assert {r["prediction"] for r in found.collect()} == {5.0}


def test_labels_by_frequency_then_name(spark):
    rows = spark.createDataFrame([("b",), ("c",), ("a",), ("c",)], "property_type string")
    fitted = Pipeline(stages=regress.feature_stages(rows)[:1]).fit(rows)
    assert regress.labels(fitted) == [("property_type", "c", 0), ("property_type", "a", 1), ("property_type", "b", 2)]


def test_signature(spark, fitted, tmp_path):
    rows = listings(spark, 30)
    regress.save_signature(fitted, rows, str(tmp_path / "signature"))
    found = regress.read_signature(spark, str(tmp_path / "signature"))
    assert found["inputs"] == {"property_type": "string", "size_m2": "int", "rooms": "int"}
    assert found["outputs"]["prediction"] == "double" and list(found["outputs"]) == ["features", "prediction"]


@pytest.mark.parametrize("per_partition, want", [(1_000_000, 32), (10, 40)])
def test_partitions_follow_the_rows(spark, monkeypatch, per_partition, want):
    monkeypatch.setattr(regress, "ROWS_PER_PARTITION", per_partition)
    seen = []

    class Spy(RandomForestRegressor):
        def _fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    model = Spy(labelCol="price", numTrees=1, maxDepth=1)
    ranking, fitted = regress.train(listings(spark), ["property_code"], {"one": model})
    assert seen == [want] and ranking.count() == 1 and isinstance(fitted["one"], PipelineModel)


@pytest.mark.parametrize("per_partition, want", [(1_000_000, 8), (10, 40)])
def test_given_partitions_are_the_least(spark, monkeypatch, per_partition, want):
    monkeypatch.setattr(regress, "ROWS_PER_PARTITION", per_partition)
    seen = []

    class Spy(RandomForestRegressor):
        def _fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    regress.train(listings(spark), ["property_code"], {"one": Spy(labelCol="price", numTrees=1, maxDepth=1)}, partitions=8)
    assert seen == [want]


def test_rows_are_kept_on_disk_and_dropped_after_the_fits(spark):
    seen = []

    class Spy(RandomForestRegressor):
        def _fit(self, dataset):
            seen.append(dataset)
            level = dataset.storageLevel
            assert level.useDisk and not level.useMemory
            return super()._fit(dataset)

    ranking, _ = regress.train(listings(spark), ["property_code"], {"one": Spy(labelCol="price", numTrees=1, maxDepth=1)})
    assert ranking.count() == 1 and len(seen) == 1
    assert not seen[0].storageLevel.useDisk and not seen[0].storageLevel.useMemory


def test_models_are_ranked_as_if_fitted_in_turn(spark):
    rows = listings(spark)
    models = {"deep": RandomForestRegressor(labelCol="price", numTrees=3, maxDepth=5, seed=1), **regress.regressors(trees=3)}
    together = regress.train(rows, ["property_code"], models)[0].collect()
    alone = [regress.train(rows, ["property_code"], {n: m})[0].first() for n, m in models.items()]
    assert [(r["model"], round(r["rmse"], 6)) for r in together] == sorted(
        ((r["model"], round(r["rmse"], 6)) for r in alone), key=lambda r: (r[1], r[0])
    )


def described(model):
    """Structure and numbers of a forest: its trees as text without the numbers, and these rounded."""
    text = model.toDebugString.split("\n", 1)[1]
    number = r"-?\d+\.?\d*(?:E-?\d+)?"
    return re.sub(number, "#", text), [float(f"{float(x):.9g}") for x in re.findall(number, text)]


@pytest.mark.parametrize(
    "options",
    [
        {"numTrees": 7, "maxDepth": 7},
        {"numTrees": 3, "maxDepth": 0},
        {"numTrees": 2, "maxDepth": 3, "maxMemoryInMB": 0},
        {"numTrees": 24, "maxBins": 300, "maxMemoryInMB": 1, "featureSubsetStrategy": "0.75"},
        {"numTrees": 4, "featureSubsetStrategy": "all", "subsamplingRate": 0.4},
        {"numTrees": 6, "minInstancesPerNode": 30, "minInfoGain": 1000.0, "minWeightFractionPerNode": 0.1},
    ],
)
def test_the_forest_is_mllibs(spark, options):
    # whole prices add up to the same sums in any order, so that equal gains are equal in both
    rows = listings(spark, 900, seed=5).withColumn("price", F.round("price")).withColumn("metres", F.col("price") / 7)
    stages = regress.feature_stages(rows, ignore=["property_code"])
    ready = Pipeline(stages=stages).fit(rows).transform(rows).repartition(3, "property_code")
    ready = ready.sortWithinPartitions("property_code").select("features", "price").persist()
    ours = ForestRegressor(labelCol="price", seed=11, **options).fit(ready)
    theirs = RandomForestRegressor(labelCol="price", seed=11, **options).fit(ready)
    assert isinstance(ours, ForestModel) and described(ours) == described(theirs)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), rel=1e-9)
    assert (ours.numFeatures, ours.getNumTrees) == (theirs.numFeatures, theirs.getNumTrees)
    found = sorted(r["prediction"] for r in ours.predictions(ready, "price").collect())
    assert found == pytest.approx(sorted(r["prediction"] for r in theirs.transform(ready).collect()), rel=1e-9)
    ready.unpersist()


@pytest.mark.parametrize("value", ["double(5)", "double(size_m2)"])
def test_a_forest_of_few_and_equal_rows(spark, value):
    rows = listings(spark, 12).withColumn("price", F.expr(value)).withColumn("rooms", F.lit(2)).coalesce(1)
    rows = rows.unionByName(rows).coalesce(1)
    ready = Pipeline(stages=regress.feature_stages(rows, ignore=["property_code"])).fit(rows).transform(rows)
    options = {"labelCol": "price", "numTrees": 9, "seed": 3}
    ours, theirs = ForestRegressor(**options).fit(ready), RandomForestRegressor(**options).fit(ready)
    assert described(ours) == described(theirs)


def test_categories_that_were_not_seen_go_where_mllib_sends_them(spark):
    rows = listings(spark, 200)
    ready = Pipeline(stages=regress.feature_stages(rows, ignore=["property_code"])).fit(rows).transform(rows)
    model = ForestRegressor(labelCol="price", numTrees=5, seed=2).fit(ready)
    odd = [(Vectors.dense([size, rooms, kind]), float(i)) for i, (size, rooms, kind) in
           enumerate([(50, 2, 9), (500, 0, 77), (-1, 3, 3), (float("nan"), 2, 1)])]
    odd = spark.createDataFrame(odd, ["features", "price"])
    found = [r["prediction"] for r in model.predictions(odd, "price").orderBy("price").collect()]
    assert found == pytest.approx([r["prediction"] for r in model.transform(odd).orderBy("price").collect()], rel=1e-9)


def test_weighted_rows_and_samples_without_replacement_are_left_to_mllib(spark):
    rows = listings(spark, 60).withColumn("weight", F.lit(2.0))
    ready = Pipeline(stages=regress.feature_stages(rows, ignore=["property_code", "weight"])).fit(rows).transform(rows)
    for options in ({"weightCol": "weight"}, {"bootstrap": False}):
        model = ForestRegressor(labelCol="price", numTrees=2, **options).fit(ready)
        assert not isinstance(model, ForestModel) and model.getNumTrees == 2


def test_a_forest_is_stored_and_read_again_and_leaves_no_rows_behind(spark, tmp_path):
    rows = listings(spark)
    ranking, fitted = regress.train(rows, ["property_code"], {"forest": regress.regressors(trees=3)["RandomForestRegressor"]})
    regress.save_model(fitted["forest"], str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert described(again.stages[-1]) == described(fitted["forest"].stages[-1])
    assert ranking.count() == 1 and not list(Path(staging_dir(spark)).glob("run-*/forest-rows-*"))


def test_the_forest_keeps_no_rows_in_memory_and_passes_once_a_level(spark, monkeypatch):
    """Five passes over the stored rows for any number of trees, and none of MLlib's own."""
    seen, counted = [], forest._counted
    monkeypatch.setattr(forest, "_counted", lambda rows, *rest: seen.append(rows.inputFiles()) or counted(rows, *rest))
    regress.train(listings(spark), ["property_code"], regress.regressors(trees=20))
    assert len(seen) == 5 and all(files == seen[0] and "forest-rows-" in files[0] for files in seen)
