"""Exact duplicates at the price of a fingerprint: whole rows meet only where fingerprints repeat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.functions.columns import percent_of
from citymart.operators.profile import identity
from citymart.session import stage


def repeating_rows(df: DataFrame, marks: Sequence[Column], counts: DataFrame) -> DataFrame:
    """The rows whose fingerprint occurs more than once.

    The repeating fingerprints are staged, so Spark knows how few they are: a small set is broadcast and no row is
    shuffled; a large one is joined by fingerprint, with Spark's runtime filter before the shuffle.
    """
    again = counts.filter(F.col("copies") > 1).select(F.col("id_0").alias("__id_0"), F.col("id_1").alias("__id_1"))
    same = (marks[0] == F.col("__id_0")) & (marks[1] == F.col("__id_1"))
    return df.join(stage(again, "repeating"), same, "left_semi")


def exact_kinds(df: DataFrame, figures: Mapping[str, Column], keys: Sequence[str] | None = None) -> DataFrame:
    """Each kind of row with its ``copies`` and the ``figures``, which follow from the row; compared by value.

    A fingerprint that occurs once is a kind by itself, its figures come with the first pass. Rows that share one are
    compared column by column: copies of one kind collapse map-side, kinds that only share a fingerprint stay apart.
    """
    marks = identity(df, keys, exact=False)
    first = df.groupBy(*marks).agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(f).alias(n) for n, f in figures.items()]
    )
    first = stage(first, "fingerprints")
    taken = [f.alias(n) for n, f in figures.items()]
    compared = repeating_rows(df, marks, first).select(*identity(df, keys, exact=True), *taken)
    compared = compared.groupBy(*compared.columns).agg(F.count(F.lit(1)).alias("copies"))
    wanted = ["copies", *figures]
    return first.filter(F.col("copies") == 1).select(*wanted).unionByName(compared.select(*wanted))


def exact_duplicates(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of their kind, over all columns or the given keys; NULLs and NaN equal themselves.

    The figures of ``profile.duplicate_profile``, without shuffling the rows that do not repeat. ``df`` is read twice.
    """
    counted = exact_kinds(df, {}, keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("unique_rows")
    )
    beyond = F.col("total_rows") - F.col("unique_rows")
    return counted.select(
        "total_rows",
        "unique_rows",
        beyond.alias("duplicate_count"),
        percent_of(beyond, F.col("total_rows")).alias("duplicate_percentage"),
    )
