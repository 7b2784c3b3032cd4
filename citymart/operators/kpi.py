"""Headline indicators on top of the marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citymart.functions import columns as C
from citymart.operators.marts import valid_prices
from citymart.operators.quantiles import ACCURACY, group_stats


def pearson(a: Column, b: Column) -> Column:
    """Correlation over the rows where both are known; NULL where one of them never varies."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


# Fixed values in this module: the names of the indicators and of their figures.


def price_quartiles(
    listings: DataFrame, key: str = "property_type", exact: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """Price quartiles and number of listings per ``key``."""
    outputs = {"price_q1": ("price_eur", 0.25), "price_q2": ("price_eur", 0.5), "price_q3": ("price_eur", 0.75)}
    return group_stats(listings, [key], [F.count(F.lit(1)).alias("listings")], outputs, exact, accuracy)


def listing_counts(listings: DataFrame) -> DataFrame:
    """Valid listings on offer per neighbourhood."""
    return (
        valid_prices(listings)
        .groupBy("district", "neighborhood")
        .agg(F.count(F.lit(1)).alias("total_properties"))
    )


def district_prices(property_mart: DataFrame) -> DataFrame:
    """Districts by mean price per m², dearest first."""
    return (
        property_mart.filter(F.col("analysis_level") == "district")
        .select("district", "avg_price_per_m2", "total_properties")
        .orderBy(F.desc("avg_price_per_m2"), "district")
    )


def district_affordability(property_mart: DataFrame, socio_district: DataFrame) -> DataFrame:
    """Median price against median income index per district."""
    prices = property_mart.filter(F.col("analysis_level") == "district").select("district", "median_price_eur")
    incomes = socio_district.select(F.col("district_name").alias("district"), "median_income_index")
    return prices.join(incomes, "district").select(
        "district",
        "median_price_eur",
        "median_income_index",
        C.affordability(F.col("median_price_eur"), F.col("median_income_index")).alias("affordability_ratio"),
    )


def attractiveness_ranking(integrated: DataFrame) -> DataFrame:
    """Neighbourhoods by attractiveness, best first, those without a score last."""
    return integrated.select("district", "neighborhood", "attractiveness_score").orderBy(
        F.desc_nulls_last("attractiveness_score"), "district", "neighborhood"
    )


def economic_accessibility(integrated: DataFrame) -> DataFrame:
    """Do dear neighbourhoods coincide with rich ones? Correlation of income index and price."""
    return integrated.agg(
        F.count(F.lit(1)).alias("neighborhoods"),
        pearson(F.col("income_index_bcn_100"), F.col("avg_price_per_m2")).alias("corr_income_price_per_m2"),
        pearson(F.col("income_index_bcn_100"), F.col("avg_price_eur")).alias("corr_income_price"),
    )


def cultural_economic_correlation(integrated: DataFrame) -> DataFrame:
    """Correlation of amenity density and income index over neighbourhoods."""
    return integrated.agg(
        F.count(F.lit(1)).alias("neighborhoods"),
        pearson(F.col("cultural_sites_per_1000_residents"), F.col("income_index_bcn_100")).alias(
            "corr_culture_income"
        ),
    )


def spatial_equity(integrated: DataFrame) -> DataFrame:
    """Amenities per income band: how many, how dense, which share."""
    banded = integrated.groupBy("income_quintile").agg(
        F.count(F.lit(1)).alias("neighborhoods"),
        F.coalesce(F.sum("total_cultural_sites"), F.lit(0)).alias("total_sites"),
        F.avg("cultural_sites_per_1000_residents").alias("avg_density"),
    )
    # The window runs over one row per band.
    everything = F.sum("total_sites").over(Window.partitionBy())
    return banded.withColumn("site_share_pct", C.percent_of(F.col("total_sites"), everything))


# -------------------------------------------------------------------- digest


def price_kpi(property_mart: DataFrame) -> DataFrame:
    return property_mart.filter(F.col("analysis_level") == "district").agg(
        F.count(F.lit(1)).alias("count"),
        F.max("avg_price_per_m2").alias("max_price"),
        F.min("avg_price_per_m2").alias("min_price"),
        F.avg("avg_price_per_m2").alias("avg_price"),
    )


def inequality_kpi(socio_district: DataFrame) -> DataFrame:
    cv = "income_inequality_cv"
    return socio_district.agg(
        F.coalesce(F.avg(cv), F.lit(0.0)).alias("avg_inequality"),
        F.coalesce(F.max(cv), F.lit(0.0)).alias("max_inequality"),
        F.coalesce(F.min(cv), F.lit(0.0)).alias("min_inequality"),
    )


def culture_kpi(cultural_district: DataFrame) -> DataFrame:
    return cultural_district.agg(
        F.coalesce(F.avg("cultural_sites_per_1000_residents"), F.lit(0.0)).alias("avg_cultural_density"),
        F.coalesce(F.sum("total_cultural_sites"), F.lit(0)).alias("total_cultural_sites"),
    )


def completeness_kpi(integrated: DataFrame) -> DataFrame:
    needed = ["district", "neighborhood", "median_price_eur", "income_index_bcn_100"]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
    counts = integrated.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(complete).alias("complete_records")
    )
    return counts.withColumn(
        "completeness_percentage", C.percent_of(F.col("complete_records"), F.col("total_records"))
    )


def as_metrics(one_row: DataFrame, group: str) -> DataFrame:
    """A one-row frame of numbers as rows ``(kpi, metric, value)``."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns
    ]
    return one_row.select(F.lit(group).alias("kpi"), F.inline(F.array(*pairs)))


def kpi_digest(
    property_mart: DataFrame | None = None,
    socio_district: DataFrame | None = None,
    cultural_district: DataFrame | None = None,
    integrated: DataFrame | None = None,
) -> DataFrame:
    """All headline numbers as rows; marts that could not be loaded are left out."""
    builders = [
        ("avg_price_per_m2_by_district", price_kpi, property_mart),
        ("income_inequality", inequality_kpi, socio_district),
        ("cultural_accessibility", culture_kpi, cultural_district),
        ("integration_quality", completeness_kpi, integrated),
    ]
    frames = [as_metrics(build(mart), name) for name, build, mart in builders if mart is not None]
    if not frames:
        raise ValueError("no mart to take indicators from")
    return reduce(DataFrame.unionByName, frames)
