"""Mergeable sketches: kept per neighbourhood, merged to districts and the city without the rows.

Quantiles come from KLL sketches, distinct counts from theta sketches. Both are a few KB a group, whatever the
group's size, merge in any order, and are exact for small groups: KLL up to ``QUANTILE_K`` values, theta up to
2^``DISTINCT_LG`` different ones. Beyond, a quantile's rank is off by about 1.65 % at the default of 200 and in proportion
less with a larger k, a distinct count by about 2 / sqrt(2^lg) with 95 % confidence.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.operators import marts
from citymart.operators.marts import PLACE, valid_prices, valid_sites

# Size of the sketches: values a KLL sketch holds at full weight, binary logarithm of the hashes a theta sketch holds.
QUANTILE_K = 4096
DISTINCT_LG = 14

# Columns of the sketch tables: what is sketched, and the counts and sums kept beside the sketches.
PRICE_SKETCHES = ["price_eur", "price_per_m2"]
SITE_SKETCHES = ["category", "facility_type"]
SUMMED = [*PRICE_SKETCHES, "size_m2", "rooms"]


def _number(value: Column) -> Column:
    """A value as the sketches take it: NaN, which they would pass over, counts as the largest number."""
    number = value.cast("double")
    return F.when(F.isnan(number), float("inf")).otherwise(number)


def price_sketches(listings: DataFrame, k: int = QUANTILE_K) -> DataFrame:
    """Per neighbourhood and property type: valid listings, sums for the means, and a quantile sketch of each price.

    The finest grain that any mart needs; coarser ones follow by :func:`merge_prices`.
    """
    kept = valid_prices(listings)
    if "rooms" not in kept.columns:
        kept = kept.withColumn("rooms", F.lit(None).cast("int"))
    sums = [F.sum(F.col(m).cast("decimal(30,10)")).alias(f"{m}_sum") for m in SUMMED]
    sums += [F.count("rooms").alias("rooms_known"), F.sum(F.col("price_per_m2") ** 2).alias("price_per_m2_squares")]
    sketches = [F.kll_sketch_agg_double(_number(F.col(m)), F.lit(k)).alias(f"{m}_sketch") for m in PRICE_SKETCHES]
    limits = [F.min("price_per_m2").alias("price_per_m2_min"), F.max("price_per_m2").alias("price_per_m2_max")]
    return kept.groupBy(*PLACE, "property_type").agg(F.count(F.lit(1)).alias("listings"), *sums, *limits, *sketches)


def merge_prices(sketches: DataFrame, keys: Sequence[str], k: int = QUANTILE_K) -> DataFrame:
    """The same figures at a coarser grain, from the sketches alone. No keys: the whole city in one row."""
    sums = [F.sum(f"{m}_sum").cast("decimal(38,10)").alias(f"{m}_sum") for m in SUMMED]
    sums += [F.sum(c).alias(c) for c in ("rooms_known", "price_per_m2_squares")]
    merged = [F.kll_merge_agg_double(f"{m}_sketch", F.lit(k)).alias(f"{m}_sketch") for m in PRICE_SKETCHES]
    limits = [F.min("price_per_m2_min").alias("price_per_m2_min"), F.max("price_per_m2_max").alias("price_per_m2_max")]
    return sketches.groupBy(*keys).agg(F.sum("listings").alias("listings"), *sums, *limits, *merged)


def price_figures(
    sketches: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, tuple[str, float]],
    more: Sequence[Column] = (),
) -> DataFrame:
    """Listings, mean prices and sizes, and the wanted quantiles, read out of a sketch table.

    ``quantiles`` maps a result column to ``(measure, probability)``; the value of rank ceil(p * n) is taken. A group
    without values has NULLs. ``more`` are further columns of the sketch table.
    """
    known = {m: F.kll_sketch_get_n_double(f"{m}_sketch") > 0 for m in PRICE_SKETCHES}
    found = [
        F.when(known[m], F.kll_sketch_get_quantile_double(f"{m}_sketch", F.lit(float(p)))).alias(out)
        for out, (m, p) in quantiles.items()
    ]
    means = [
        F.try_divide(F.col(f"{m}_sum").cast("double"), F.col("listings")).alias(f"avg_{m}")
        for m in (*PRICE_SKETCHES, "size_m2")
    ]
    return sketches.select(*keys, "listings", *means, "price_per_m2_min", "price_per_m2_max", *found, *more)


def property_marts(sketches: DataFrame, k: int = QUANTILE_K) -> tuple[DataFrame, DataFrame]:
    """Both property marts out of a sketch table: what ``marts.property_marts`` gives, without the listings.

    The means come from exact sums, the deviation from the sum of squares; medians are as good as the sketches.
    """
    medians = {"median_price_eur": ("price_eur", 0.5), "median_price_per_m2": ("price_per_m2", 0.5)}
    levels = {"district": ["district"], "neighborhood": PLACE, "property_type": ["district", "property_type"]}
    found = {}
    for level, keys in levels.items():
        merged = merge_prices(sketches, keys, k)
        n, mean = F.col("listings"), F.col("price_per_m2_sum").cast("double") / F.col("listings")
        spread = F.greatest(F.col("price_per_m2_squares") - n * mean * mean, F.lit(0.0))
        rooms = F.try_divide(F.col("rooms_sum").cast("double"), F.col("rooms_known")).alias("avg_rooms")
        deviation = F.sqrt(F.try_divide(spread, n - 1)).alias("price_per_m2_stddev")
        stats = price_figures(merged, keys, medians, [rooms, deviation])
        found[level] = stats.withColumn("analysis_level", F.lit(level)).withColumnsRenamed(
            {
                "listings": "total_properties",
                "price_per_m2_min": "min_price_per_m2",
                "price_per_m2_max": "max_price_per_m2",
            }
        )
    places = [marts.property_columns(found[level]) for level in ("district", "neighborhood")]
    return places[0].unionByName(places[1]), marts.type_columns(found["property_type"])


def site_sketches(sites: DataFrame, lg: int = DISTINCT_LG) -> DataFrame:
    """Per neighbourhood: valid sites, and a distinct-count sketch of their categories and types. One scan, no
    row is expanded for the distinct counts."""
    sketches = [F.theta_sketch_agg(m, F.lit(lg)).alias(f"{m}_sketch") for m in SITE_SKETCHES]
    return valid_sites(sites).groupBy(*PLACE).agg(F.count(F.lit(1)).alias("sites"), *sketches)


def merge_sites(sketches: DataFrame, keys: Sequence[str], lg: int = DISTINCT_LG) -> DataFrame:
    """The same at a coarser grain: what two neighbourhoods share counts once. No keys: the whole city in one row."""
    merged = [F.theta_union_agg(f"{m}_sketch", F.lit(lg)).alias(f"{m}_sketch") for m in SITE_SKETCHES]
    return sketches.groupBy(*keys).agg(F.sum("sites").alias("sites"), *merged)


def site_figures(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sites and their different categories and types."""
    counts = [F.theta_sketch_estimate(f"{m}_sketch").alias(f"unique_{m}") for m in SITE_SKETCHES]
    return sketches.select(*keys, "sites", *counts)


def cultural_marts(sketches: DataFrame, income: DataFrame, lg: int = DISTINCT_LG) -> tuple[DataFrame, DataFrame]:
    """The cultural marts by district and by neighbourhood out of a sketch table, without the sites."""
    names = {"sites": "total_cultural_sites", "unique_category": "unique_categories"}
    names |= {"unique_facility_type": "unique_facility_types"}
    district, place = (
        site_figures(merge_sites(sketches, keys, lg), keys).withColumnsRenamed(names) for keys in (["district"], PLACE)
    )
    return marts.district_density(district, income), marts.neighborhood_density(place, income)


def refreshed(
    sketches: DataFrame,
    source: DataFrame,
    changed: Sequence[tuple[str, str]],
    build: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """A sketch table with some neighbourhoods built anew from ``source`` and all others kept as they are.

    ``changed`` lists (district, neighbourhood). Only their rows are read: the filter is on plain columns, so it
    prunes the partitions of a stored source and reaches its files. A neighbourhood without rows drops out.
    """
    if not changed:
        return sketches
    here = reduce(
        lambda a, b: a | b,
        [F.col("district").eqNullSafe(F.lit(d)) & F.col("neighborhood").eqNullSafe(F.lit(n)) for d, n in changed],
    )
    return sketches.filter(~here).unionByName(build(source.filter(here)))
