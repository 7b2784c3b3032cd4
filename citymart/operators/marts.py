"""The analytical marts: property, socio-economic, cultural and integrated."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.functions import columns as C
from citymart.operators.latest import latest_per_key
from citymart.operators.quantiles import ACCURACY, group_quantiles, group_stats, join_on, sketches
from citymart.session import stage

# Fixed value: listings at or above this price per square metre are outliers.
MAX_PRICE_PER_M2 = 20_000

# Neighbourhoods that listings spell otherwise than incomes beyond letter case.
NEIGHBORHOOD_ALIASES = [("El Poble Sec - Parc de Montjuïc", "el Poble Sec")]

PLACE = ["district", "neighborhood"]
INCOME_PLACE = ["district_name", "neighborhood_name"]


# ------------------------------------------------------------------ property


def valid_prices(listings: DataFrame, max_price_per_m2: float = MAX_PRICE_PER_M2) -> DataFrame:
    """Listings with positive price and size, a price per m² below the cut and a known place."""
    return listings.filter(
        (F.col("price_eur") > 0)
        & (F.col("size_m2") > 0)
        & (F.col("price_per_m2") > 0)
        & (F.col("price_per_m2") < max_price_per_m2)
        & F.col("district").isNotNull()
        & F.col("neighborhood").isNotNull()
    )


def _price_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_properties"),
        F.avg("price_eur").alias("avg_price_eur"),
        F.avg("price_per_m2").alias("avg_price_per_m2"),
        F.avg("size_m2").alias("avg_size_m2"),
        F.avg("rooms").alias("avg_rooms"),
        F.stddev_samp("price_per_m2").alias("price_per_m2_stddev"),
        F.min("price_per_m2").alias("min_price_per_m2"),
        F.max("price_per_m2").alias("max_price_per_m2"),
    ]


_PRICE_MEDIANS = {
    "median_price_eur": ("price_eur", 0.5),
    "median_price_per_m2": ("price_per_m2", 0.5),
}


_LEVELS = {
    "district": ["district"],
    "neighborhood": PLACE,
    "property_type": ["district", "property_type"],
}


def _price_stats(
    listings: DataFrame, levels: Sequence[str], exact: bool, medians: bool = True, accuracy: int = ACCURACY
) -> DataFrame:
    """Price statistics of valid listings at several levels, keys that do not apply NULL.

    All levels come out of one grouping-sets aggregation, medians included unless they are to be
    ``exact``, which costs two more scans.
    """
    clean = valid_prices(listings)
    grains = [_LEVELS[level] for level in levels]
    keys = list(dict.fromkeys(k for grain in grains for k in grain))
    level = F.lit(None).cast("string")
    for name, grain in zip(levels, grains):
        absent = int("".join("0" if k in grain else "1" for k in keys), 2)
        level = F.when(F.grouping_id(*keys) == absent, name).otherwise(level)
    measures = [level.alias("analysis_level"), *_price_measures()]
    if not medians:
        measures += [F.lit(None).cast("double").alias(m) for m in _PRICE_MEDIANS]
    elif not exact:
        measures += sketches(_PRICE_MEDIANS, accuracy)
    stats = clean.groupingSets(grains, *keys).agg(*measures)
    if not medians or not exact:
        return stats
    found = [
        frame.withColumns(
            {k: F.lit(None).cast(clean.schema[k].dataType) for k in keys if k not in grain}
        ).withColumn("analysis_level", F.lit(name))
        for name, grain, frame in zip(levels, grains, group_quantiles(clean, grains, _PRICE_MEDIANS))
    ]
    return join_on(stats, reduce(DataFrame.unionByName, found), [*keys, "analysis_level"], "left")


def property_columns(stats: DataFrame) -> DataFrame:
    """Price statistics as the property mart holds them."""
    if "neighborhood" not in stats.columns:
        stats = stats.withColumn("neighborhood", F.lit(None).cast("string"))
    return stats.select(
        *PLACE,
        "analysis_level",
        "total_properties",
        F.round("avg_price_eur", 2).alias("avg_price_eur"),
        F.round("median_price_eur", 2).alias("median_price_eur"),
        F.round("avg_price_per_m2", 2).alias("avg_price_per_m2"),
        F.round("median_price_per_m2", 2).alias("median_price_per_m2"),
        F.round("avg_size_m2", 1).alias("avg_size_m2"),
        F.round("avg_rooms", 1).alias("avg_rooms"),
        F.round("price_per_m2_stddev", 2).alias("price_per_m2_stddev"),
        "min_price_per_m2",
        "max_price_per_m2",
    )


def type_columns(stats: DataFrame) -> DataFrame:
    """Price statistics as the mart by type holds them."""
    return stats.select(
        "district",
        "property_type",
        F.col("total_properties").alias("type_count"),
        F.col("avg_price_per_m2").alias("avg_price_per_m2_by_type"),
        F.col("median_price_per_m2").alias("median_price_per_m2_by_type"),
    )


def property_analytics(
    listings: DataFrame,
    levels: Sequence[str] = ("district", "neighborhood"),
    exact: bool = False,
    medians: bool = True,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Price statistics of valid listings per district and per neighbourhood, one row set each.

    Without ``medians`` their columns are NULL.
    """
    return property_columns(_price_stats(listings, levels, exact, medians, accuracy))


def property_type_analytics(listings: DataFrame, exact: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """Listings, mean and median price per m² per district and property type."""
    return type_columns(_price_stats(listings, ["property_type"], exact, accuracy=accuracy))


def property_marts(
    listings: DataFrame, exact: bool = False, accuracy: int = ACCURACY
) -> tuple[DataFrame, DataFrame]:
    """Both property marts out of one staged result, so that they share every scan."""
    stats = stage(_price_stats(listings, list(_LEVELS), exact, accuracy=accuracy), "prices")
    by_type = F.col("analysis_level") == "property_type"
    return property_columns(stats.filter(~by_type)), type_columns(stats.filter(by_type))


# ------------------------------------------------------------ socio-economic


def valid_income(income: DataFrame) -> DataFrame:
    return income.filter(
        F.col("income_index_bcn_100").isNotNull()
        & (F.col("income_index_bcn_100") > 0)
        & F.col("district_name").isNotNull()
        & F.col("neighborhood_name").isNotNull()
    )


def latest_income(income: DataFrame) -> DataFrame:
    """The newest valid income row of each neighbourhood, with ``latest_year``."""
    return latest_per_key(valid_income(income), INCOME_PLACE, "year")


def socioeconomic_district(income: DataFrame, exact: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """Income level, inequality and population per district, from the newest year of each part."""
    measures = [
        F.min("district_code").alias("district_code"),
        F.count(F.lit(1)).alias("neighborhood_count"),
        F.avg("income_index_bcn_100").alias("avg_income_index"),
        F.stddev_samp("income_index_bcn_100").alias("income_inequality_stddev"),
        F.min("income_index_bcn_100").alias("min_income_index"),
        F.max("income_index_bcn_100").alias("max_income_index"),
        F.sum("population").cast("double").alias("total_population"),
        F.avg("population").alias("avg_neighborhood_population"),
    ]
    median = {"median_income_index": ("income_index_bcn_100", 0.5)}
    return group_stats(latest_income(income), ["district_name"], measures, median, exact, accuracy).select(
        "district_name",
        "district_code",
        "neighborhood_count",
        "avg_income_index",
        "median_income_index",
        "income_inequality_stddev",
        "min_income_index",
        "max_income_index",
        "total_population",
        "avg_neighborhood_population",
        C.variation_pct(F.col("income_inequality_stddev"), F.col("avg_income_index")).alias(
            "income_inequality_cv"
        ),
        F.lit("district").alias("analysis_level"),
    )


def socioeconomic_neighborhood(income: DataFrame) -> DataFrame:
    """The newest income and population of each neighbourhood."""
    return latest_income(income).select(
        "district_name",
        "neighborhood_name",
        "district_code",
        "neighborhood_code",
        "income_index_bcn_100",
        "population",
        F.col("latest_year").alias("data_year"),
        F.lit("neighborhood").alias("analysis_level"),
    )


def income_quintiles(
    income: DataFrame,
    cuts: Sequence[float] = C.INCOME_CUTS,
    labels: Sequence[str] = C.INCOME_LABELS,
) -> DataFrame:
    """The income band of each neighbourhood's newest index: fixed cuts, not equal shares."""
    return latest_income(income).select(
        *INCOME_PLACE,
        "income_index_bcn_100",
        C.band(F.col("income_index_bcn_100"), cuts, labels).alias("income_quintile"),
    )


# ------------------------------------------------------------------ cultural


def valid_sites(sites: DataFrame) -> DataFrame:
    return sites.dropna(subset=["site_id", "district", "facility_name"])


def latest_population(income: DataFrame) -> DataFrame:
    """Population in the newest year that has an income index, per neighbourhood."""
    newest = latest_per_key(income, INCOME_PLACE, "year", F.col("income_index_bcn_100").isNotNull())
    return newest.select(
        F.col("district_name").alias("district"),
        F.col("neighborhood_name").alias("neighborhood"),
        "population",
    )


def _site_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_cultural_sites"),
        F.count_distinct("category").alias("unique_categories"),
        F.count_distinct("facility_type").alias("unique_facility_types"),
    ]


def cultural_district(sites: DataFrame, income: DataFrame) -> DataFrame:
    """Sites, their variety and their density per district."""
    return district_density(valid_sites(sites).groupBy("district").agg(*_site_measures()), income)


def district_density(counted: DataFrame, income: DataFrame) -> DataFrame:
    """Counted sites of each district beside its residents."""
    population = latest_population(income).groupBy("district").agg(
        F.sum("population").alias("total_population")
    )
    return counted.join(population, "district", "left").select(
        "district",
        F.lit("district").alias("analysis_level"),
        "total_cultural_sites",
        "unique_categories",
        "unique_facility_types",
        "total_population",
        C.per_thousand(F.col("total_cultural_sites"), F.col("total_population")).alias(
            "cultural_sites_per_1000_residents"
        ),
    )


def cultural_neighborhood(sites: DataFrame, income: DataFrame) -> DataFrame:
    """Sites, their variety and their density per neighbourhood; 0.0 without residents."""
    return neighborhood_density(valid_sites(sites).groupBy(*PLACE).agg(*_site_measures()), income)


def neighborhood_density(counted: DataFrame, income: DataFrame) -> DataFrame:
    """Counted sites of each neighbourhood beside its residents."""
    return counted.join(latest_population(income), PLACE, "left").select(
        *PLACE,
        F.lit("neighborhood").alias("analysis_level"),
        "total_cultural_sites",
        "unique_categories",
        "unique_facility_types",
        "population",
        C.per_thousand_or_zero(F.col("total_cultural_sites"), F.col("population")).alias(
            "cultural_sites_per_1000_residents"
        ),
    )


def cultural_category(sites: DataFrame) -> DataFrame:
    """Sites per district and category."""
    return (
        valid_sites(sites)
        .filter(F.col("category").isNotNull())
        .groupBy("district", "category")
        .agg(F.count(F.lit(1)).alias("category_count"))
    )


# ---------------------------------------------------------------- integrated


def integrated_analytics(
    property_mart: DataFrame,
    socio_mart: DataFrame,
    cultural_mart: DataFrame,
    market_cuts: Sequence[float] = C.MARKET_CUTS,
    fold_names: bool = False,
    aliases: DataFrame | None = None,
    income_cuts: Sequence[float] = C.INCOME_CUTS,
) -> DataFrame:
    """Neighbourhood marts side by side with the composite scores.

    All inputs are neighbourhood-grain marts, so the joins are between small tables. Names must
    match exactly unless ``fold_names`` makes the match ignore letter case and outer blanks.
    ``aliases`` (``alias``, ``name``) first replaces other spellings of a neighbourhood. The income
    band follows from the index that the socio-economic mart holds.
    """

    def keyed(df: DataFrame, place: Sequence[str], keep: Sequence[str]) -> DataFrame:
        fold = C.matching_key if fold_names else (lambda c: c)
        if aliases is not None:
            kept = df.select("*", F.col(place[1]).alias("__as_written"))
            df = with_canonical_names(kept, "__as_written", aliases)
            place = [place[0], "__as_written"]
        names = [fold(F.col(p)).alias(k) for p, k in zip(place, ("k_district", "k_neighborhood"))]
        return df.select(*names, *keep)

    key = ["k_district", "k_neighborhood"]
    base = keyed(
        property_mart.filter(F.col("analysis_level") == "neighborhood"),
        PLACE,
        [
            *PLACE,
            "total_properties",
            "avg_price_eur",
            "median_price_eur",
            "avg_price_per_m2",
            "median_price_per_m2",
            "avg_size_m2",
        ],
    )
    socio = keyed(socio_mart, INCOME_PLACE, ["income_index_bcn_100", "population"])
    culture = keyed(cultural_mart, PLACE, ["total_cultural_sites", "cultural_sites_per_1000_residents"])
    return (
        base.join(socio, key, "left")
        .join(culture, key, "left")
        .drop(*key)
        .withColumns(
            {
                "income_quintile": C.band(F.col("income_index_bcn_100"), income_cuts, C.INCOME_LABELS),
                "affordability_ratio": C.affordability(
                    F.col("median_price_eur"), F.col("income_index_bcn_100")
                ),
                "attractiveness_score": C.attractiveness(
                    F.col("income_index_bcn_100"),
                    F.col("cultural_sites_per_1000_residents"),
                    F.col("avg_price_per_m2"),
                ),
                "market_accessibility": C.band(
                    F.col("total_properties"), market_cuts, C.MARKET_LABELS
                ),
            }
        )
        .dropna(subset=[*PLACE, "median_price_eur", "income_index_bcn_100"])
    )


def known_aliases(spark: SparkSession) -> DataFrame:
    """The alias table that comes with the package; add rows of the same columns as needed."""
    return spark.createDataFrame(NEIGHBORHOOD_ALIASES, "alias string, name string")


def with_canonical_names(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """``df`` with the names in ``column`` replaced where ``aliases`` lists them as an ``alias``.

    Letter case and outer blanks of an alias do not count. Of several names for one alias the
    smallest is taken; names without an entry, and NULLs, stay.
    """
    known = aliases.groupBy(C.matching_key(F.col("alias")).alias("__alias")).agg(F.min("name").alias("__name"))
    joined = df.join(known, C.matching_key(F.col(column)) == F.col("__alias"), "left")
    return joined.withColumn(column, F.coalesce("__name", column)).drop("__alias", "__name")


def stamped(df: DataFrame, column: str = "created_at") -> DataFrame:
    """``df`` with the time of the run; added when a mart is written."""
    return df.withColumn(column, F.current_timestamp())
