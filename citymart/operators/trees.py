"""Fitted forests as tables: their nodes, and predictions by joining rows with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.session import staged_path


def forest_nodes(spark: SparkSession, forest: RandomForestRegressionModel, names: Sequence[str]) -> DataFrame:
    """Every node of every tree, read from the forest as MLlib stores it.

    ``tree``, ``node``, ``feature`` (one of ``names``; NULL in leaves), ``place`` (its place in the feature vector),
    ``threshold`` (numbers up to it go left) or ``categories`` (these go left), ``left``, ``right``, ``prediction``,
    ``gain`` and ``rows``.
    """
    path = staged_path(spark, "forest")
    forest.write().save(path)
    split, node = F.col("nodeData.split"), F.col("nodeData")
    leaf = node["leftChild"] < 0
    continuous = split["numCategories"] < 0
    known = F.array(*[F.lit(n) for n in names])
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(~leaf, F.get(known, split["featureIndex"])).alias("feature"),
        F.when(~leaf, split["featureIndex"]).alias("place"),
        F.when(~leaf & continuous, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~leaf & ~continuous, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(~leaf, node["leftChild"]).alias("left"),
        F.when(~leaf, node["rightChild"]).alias("right"),
        node["prediction"].alias("prediction"),
        F.when(~leaf, node["gain"]).alias("gain"),
        node["rawCount"].alias("rows"),
    )


def _leaf(nodes: Column, features: Column, depth: int) -> Column:
    """The node that a row ends in: one step down for each level, none from a leaf."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at["node"])
        value = F.get(features, node["place"])
        left = F.coalesce(value <= node["threshold"], F.array_contains(node["categories"], value))
        below = F.when(left, node["left"]).otherwise(node["right"])
        return F.struct(F.when(node["left"].isNull(), at["node"]).otherwise(below).alias("node"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.struct(F.lit(0).alias("node")), step)["node"]


def predict_by_nodes(
    rows: DataFrame, nodes: DataFrame, trees: int, depth: int, keys: Sequence[str], features: str = "features"
) -> DataFrame:
    """``keys`` and ``prediction``: the mean over all trees of the leaf each row falls into.

    One join of rows with trees: a tree is one row that holds its nodes, so there are as many rows as trees. What it
    makes of a row is averaged map-side. Rows without features get none of the leaves and a NULL. Rows of one key are
    told apart. A tree of one node has depth 0.
    """
    node = F.struct("node", "place", "threshold", "categories", "left", "right", "prediction")
    known = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    values = F.when(F.col(features).isNotNull(), vector_to_array(features))
    asked = rows.select(F.monotonically_increasing_id().alias("row"), F.struct(*keys).alias("key"), values.alias("x"))
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    found = asked.select("*", every).join(known, "tree")
    leaf = _leaf(F.col("nodes"), F.col("x"), depth) if depth else F.lit(0)
    value = F.when(F.col("x").isNotNull(), F.get("nodes", leaf)["prediction"])
    means = found.groupBy("row", "key").agg(F.avg(value).alias("prediction"))
    return means.select("key.*", "prediction")
