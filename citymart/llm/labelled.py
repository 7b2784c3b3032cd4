"""Labelled documents that models are fitted on, and the third that is kept from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.session import stage

#: Labelled rows a model is fitted on at most.
TRAIN_ROWS = 20_000


def held_out(id_col: str) -> Column:
    """Whether a document's label is kept from learning."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int = TRAIN_ROWS
) -> DataFrame:
    """``text`` and ``label`` of at most ``limit`` labelled documents outside the held-out third.

    Taken by the hash of the id. Labels that are NULL are left out; several of one document count as
    their largest. The chosen labels are few, so broadcasting them is safe.
    """
    labels = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    labels = labels.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("label"))
    labels = stage(labels.withColumn("__at", F.pmod(F.xxhash64("__id"), F.lit(1_000_000))), "labels")
    share = min(1.0, 1.2 * limit / max(1, labels.count()))
    labels = labels.filter(F.col("__at") < share * 1_000_000).orderBy("__at", "__id").limit(limit)
    return docs.select(id_col, F.col(text_col).alias("text")).join(
        F.broadcast(labels.select("__id", (F.col("label") > 0).alias("label"))), F.col(id_col) == F.col("__id")
    ).select("text", "label")
