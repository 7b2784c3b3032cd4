"""The queries registered for the driver tables, one per operator or mart.

Figures whose last bits depend on the order of additions are rounded here, at the edge, so that
they can be compared with another engine; the operators themselves do not round them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citymart.functions import columns as C
from citymart.functions.schema import numeric_columns, type_counts
from citymart.operators import (
    duplicates,
    gram,
    heavy,
    kpi,
    marts,
    profile,
    quantiles,
    regress,
    rollups,
    standardize,
    trees,
    validate,
)
from citymart.operators.latest import dedup_latest, latest_per_key
from citymart.plans import bindings as B
from citymart.plans import training
from citymart.session import stage, staged_path
from citymart.sources import increments, landing, reports, schemas, tables
from citymart.sources.files import list_tables, required_datasets, table_file_counts, zone_inventory
from citymart.sources.storage import entries

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Cuts that spread the driver tables over all bands.
CUSTOM_INCOME_CUTS = (90, 97, 103, 110)
CUSTOM_MARKET_CUTS = (1000, 3000)

# Sketches of this accuracy are exact in groups of up to half a million rows.
ACCURACY = 1_000_000

# One task reads a compressed file, or a file of texts with line breaks, from its beginning to its end: landing files
# end after so many records, or after so many bytes of text on average.
LANDING_RECORDS = 500_000
LANDING_BYTES = 64 << 20


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income as a stored table of one row per nation and year.

    For marts that read it more than once: the orders are aggregated once, and joins know how small
    the result is.
    """
    return stage(B.income(spark, sf_dir), "income")


def _sparse_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(B.sparse_income(spark, sf_dir), "income")


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amenities as a stored table, for queries that read them more than once."""
    return stage(B.sites(spark, sf_dir), "sites")


# ------------------------------------------------------- standardise and clean


def _raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the shape of raw listing records, with gaps made from their own values."""
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    items = B.placed_items(spark, sf_dir)
    parking = F.when(line > 5, F.struct((F.col("l_linestatus") == "O").alias("hasParkingSpace")))
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("propertyCode"),
        F.concat(F.lit("item/"), F.col("l_orderkey").cast("string")).alias("url"),
        F.when(F.col("l_discount") < 0.1, F.col("district")).alias("district"),
        "neighborhood",
        F.col("s_name").alias("address"),
        F.lit("city").alias("municipality"),
        F.when(line < 3, F.col("l_tax") * 100).alias("latitude"),
        F.when(line < 4, F.col("l_discount") * 100).alias("longitude"),
        F.lower("l_returnflag").alias("propertyType"),
        F.struct(F.when(line == 1, F.lit("loft")).alias("subTypology"), F.lit("flat").alias("typology")).alias(
            "detailedType"
        ),
        F.when(quantity > 1, quantity + 0.5).alias("size"),
        F.when(line != 7, line.cast("bigint")).alias("rooms"),
        F.when(line != 6, line.cast("bigint") - 1).alias("bathrooms"),
        F.when(line != 5, line.cast("string")).alias("floor"),
        F.col("l_returnflag").alias("status"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("price"),
        F.col("l_extendedprice").alias("priceByArea"),
        F.when(line > 2, F.col("l_linestatus") == "F").alias("exterior"),
        F.when(line > 3, F.col("l_linestatus") == "O").alias("hasLift"),
        parking.alias("parkingSpace"),
    )


@register
def standardize_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, default, cast and filter raw listing records."""
    return standardize.format_listings(_raw_listings(spark, sf_dir)).drop("load_timestamp")


@register
def format_listings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through JSON landing files, partitioned storage and back."""
    path = staged_path(spark, "landing-listings")
    _raw_listings(spark, sf_dir).write.options(compression="gzip", maxRecordsPerFile=LANDING_RECORDS).json(path)
    raw = landing.read_json_lines(spark, path, schemas.LISTINGS_LANDING)
    zone = staged_path(spark, "formatted")
    tables.write_mart(standardize.format_listings(raw), zone, "idealista")
    return tables.read_mart(spark, zone, "idealista").drop("load_timestamp")


@register
def format_income_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income through CSV landing files with ``-`` and blanks, to the typed table and back."""
    index = F.col("income_index_bcn_100")
    population = F.col("population").cast("int").cast("string")
    raw = B.income(spark, sf_dir).select(
        F.col("year").cast("string").alias("Any"),
        F.when(F.col("district_code") == 4, "-").otherwise(F.col("district_code").cast("string")).alias(
            "Codi_Districte"
        ),
        F.col("district_name").alias("Nom_Districte"),
        F.col("neighborhood_code").cast("string").alias("Codi_Barri"),
        F.col("neighborhood_name").alias("Nom_Barri"),
        F.when(F.col("year") != 1996, population).alias("Població"),
        F.when(index < 95, "-").otherwise(index.cast("string")).alias("Índex RFD Barcelona = 100"),
    )
    path, zone = staged_path(spark, "landing-income"), staged_path(spark, "formatted")
    raw.write.option("header", True).csv(path)
    formatted = standardize.format_income(landing.read_csv(spark, path, schemas.INCOME_LANDING))
    tables.write_mart(formatted, zone, "income")
    return tables.read_mart(spark, zone, "income").drop("load_timestamp")


@register
def format_sites_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amenities through CSV landing files to the typed table and back."""
    site = B.sites(spark, sf_dir).select(
        F.col("site_id").alias("_id"),
        F.when(F.col("facility_type") != "Brand#9", F.col("facility_name")).alias("name"),
        F.col("category").alias("institution_name"),
        F.length("district").alias("addresses_district_id"),
        F.col("district").alias("addresses_district_name"),
        F.col("neighborhood").alias("addresses_neighborhood_name"),
        F.when(F.col("category") != "PROMO", F.length("facility_type") + 0.5).alias("geo_epgs_4326_y"),
        (F.length("category") + 0.25).alias("geo_epgs_4326_x"),
        F.col("category").alias("values_category"),
        F.col("facility_type").alias("values_value"),
    )
    path, zone = staged_path(spark, "landing-sites"), staged_path(spark, "formatted")
    site.write.option("header", True).csv(path)
    tables.write_mart(standardize.format_sites(landing.read_csv(spark, path, infer=False)), zone, "cultural_sites")
    return tables.read_mart(spark, zone, "cultural_sites").drop("load_timestamp")


@register
def clean_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from text that holds ``-`` and blanks."""
    quantity = F.col("l_quantity")
    text = F.when(quantity == 1, "-").when(quantity == 2, "").otherwise(quantity.cast("int").cast("string"))
    return B.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.clean_number(text, "int").alias("quantity")
    )


@register
def nested_struct_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a nested record and the record as text."""
    record = B.table(spark, sf_dir, "events").withColumn("record", F.from_json("props", "k int"))
    return record.select("event_id", F.col("record.k").alias("k"), F.col("record").cast("string").alias("as_text"))


@register
def outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.valid_prices(B.listings(spark, sf_dir)).select(
        "property_code", "district", "neighborhood", "size_m2", "price_eur", "price_per_m2"
    )


@register
def regex_numeric_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep floors that are plain numbers, after filling the missing ones."""
    size = F.col("p_size")
    floor = F.when(size == 1, "bj").when(size == 2, "en").when(size > 3, F.substring("p_brand", 7, 10))
    parts = B.table(spark, sf_dir, "part").select("p_partkey", floor.alias("floor"))
    return standardize.numeric_text(standardize.fill_missing(parts, {"floor": 0}), "floor")


@register
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.fill_missing(
        _dirty_orders(spark, sf_dir), {"o_orderstatus": "good", "o_orderpriority": 0, "o_totalprice": 0}
    )


@register
def union_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two tables by name; a column that is number here and text there becomes text."""
    parts = B.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("tag"), "p_retailprice"
    )
    events = B.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("tag"))
    return landing.union_relaxed([parts, events])


@register
def mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV and JSON files read without a schema and combined into one table."""
    csv, json = staged_path(spark, "labels"), staged_path(spark, "conversations")
    B.table(spark, sf_dir, "labels").write.option("header", True).csv(csv)
    B.table(spark, sf_dir, "conversations").write.json(json)
    return landing.read_files(
        spark,
        csv=[e.path for e in entries(spark, csv) if e.name.endswith(".csv")],
        json=[e.path for e in entries(spark, json) if e.name.endswith(".json")],
    )


@register
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "documents").select("text", "lang", "source").distinct()


# ---------------------------------------------------------------------- marts


@register
def property_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.property_analytics(B.listings(spark, sf_dir), ["district"], accuracy=ACCURACY)


@register
def property_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.property_analytics(B.listings(spark, sf_dir), ["neighborhood"], accuracy=ACCURACY)


@register
def property_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.property_analytics(B.listings(spark, sf_dir), accuracy=ACCURACY)


@register
def property_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mart with medians that are exact at any size."""
    return marts.property_analytics(B.listings(spark, sf_dir), exact=True)


_NON_FINITE = {"p25": ("price", 0.25), "p50": ("price", 0.5), "p72": ("price", 0.72), "p99": ("price", 0.99)}


def _non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of which some are infinite and some are not a number."""
    line = F.col("rooms")
    price = F.when(line == 6, float("inf")).when(line == 7, float("nan")).when(line == 1, -float("inf"))
    return B.listings(spark, sf_dir).select("district", price.otherwise(F.col("price_eur")).alias("price"))


def _as_text(df: DataFrame) -> DataFrame:
    """Numbers as text that engines agree on, whatever they are."""

    def text(value: Column) -> Column:
        named = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(value == -float("inf"), "-inf")
        return F.when(value.isNotNull(), named.otherwise(value.try_cast("decimal(18,2)").cast("string")))

    return df.select("district", *[text(F.col(c)).alias(c) for c in df.columns[1:]])


@register
def quantiles_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles; infinities rank at the ends, NaN last."""
    [found] = quantiles.group_quantiles(_non_finite(spark, sf_dir), [["district"]], _NON_FINITE, refinements=1)
    return _as_text(found)


@register
def sketches_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from sketches, in one aggregation."""
    found = quantiles.sketches(_NON_FINITE, ACCURACY)
    return _as_text(_non_finite(spark, sf_dir).groupBy("district").agg(*found))


@register
def property_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The property mart written by level; reading one level touches one partition."""
    zone = staged_path(spark, "exploitation")
    mart = marts.stamped(property_analytics(spark, sf_dir))
    tables.write_mart(mart, zone, "property_analytics")
    stored = tables.read_mart(spark, zone, "property_analytics")
    return stored.filter(F.col("analysis_level") == "neighborhood").drop("created_at")


@register
def property_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.property_type_analytics(B.listings(spark, sf_dir, parts=True), accuracy=ACCURACY)
    return rounded(mart, ["avg_price_per_m2_by_type"])


@register
def property_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings per level out of both marts, built together."""
    places, types = marts.property_marts(B.listings(spark, sf_dir, parts=True), accuracy=ACCURACY)
    place_rows = places.select(
        "district",
        F.coalesce("neighborhood", F.lit("all")).alias("part"),
        "analysis_level",
        F.col("total_properties").alias("listings"),
        F.col("median_price_per_m2").alias("median_price"),
    )
    type_rows = types.select(
        "district",
        F.col("property_type").alias("part"),
        F.lit("property_type").alias("analysis_level"),
        F.col("type_count").alias("listings"),
        F.round("median_price_per_m2_by_type", 2).alias("median_price"),
    )
    return place_rows.unionByName(type_rows)


@register
def latest_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.latest_income(_sparse_income(spark, sf_dir))


@register
def latest_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.latest_population(_sparse_income(spark, sf_dir))


@register
def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each customer's newest order day, ties kept."""
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", staged=True).select("o_orderkey", "o_custkey")


_SOCIO_FIGURES = [
    "avg_income_index",
    "income_inequality_stddev",
    "avg_neighborhood_population",
]


@register
def socioeconomic_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.socioeconomic_district(_income(spark, sf_dir)), _SOCIO_FIGURES)


@register
def socioeconomic_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.socioeconomic_neighborhood(_sparse_income(spark, sf_dir))


@register
def income_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.income_quintiles(_income(spark, sf_dir))


@register
def income_bands_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.income_quintiles(_income(spark, sf_dir), CUSTOM_INCOME_CUTS)


@register
def cultural_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.cultural_district(B.sites(spark, sf_dir), _income(spark, sf_dir))


@register
def cultural_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population is known only where some year has an index, which every third nation lacks."""
    income = _income(spark, sf_dir).withColumn(
        "income_index_bcn_100", F.when(F.col("neighborhood_code") % 3 != 0, F.col("income_index_bcn_100"))
    )
    return marts.cultural_neighborhood(B.sites(spark, sf_dir), income)


@register
def cultural_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.cultural_category(B.sites(spark, sf_dir))


def _integrated(
    spark: SparkSession,
    sf_dir: str,
    market_cuts: Sequence[float] = C.MARKET_CUTS,
    income_cuts: Sequence[float] = C.INCOME_CUTS,
) -> DataFrame:
    income, sites = _income(spark, sf_dir), B.sites(spark, sf_dir)
    return marts.integrated_analytics(
        property_neighborhood(spark, sf_dir),
        marts.socioeconomic_neighborhood(income),
        marts.cultural_neighborhood(sites, income),
        market_cuts,
        income_cuts=income_cuts,
    )


@register
def integrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir)


@register
def market_accessibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings on offer per neighbourhood, banded with the standard and with wider cuts."""
    counts = marts.valid_prices(B.listings(spark, sf_dir)).groupBy(*marts.PLACE).agg(
        F.count(F.lit(1)).alias("total_properties")
    )
    total = F.col("total_properties")
    return counts.select(
        "*",
        C.market_accessibility(total).alias("market_accessibility"),
        C.band(total, CUSTOM_MARKET_CUTS, C.MARKET_LABELS).alias("market_accessibility_custom"),
    )


# ----------------------------------------------------------------- indicators


@register
def price_quartiles_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.price_quartiles(B.listings(spark, sf_dir, parts=True), accuracy=ACCURACY)


@register
def listing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.listing_counts(B.listings(spark, sf_dir))


@register
def district_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The medians of the mart are not shown here, so it comes without."""
    return kpi.district_prices(marts.property_analytics(B.listings(spark, sf_dir), ["district"], medians=False))


@register
def district_affordability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.district_affordability(
        property_district(spark, sf_dir), marts.socioeconomic_district(_income(spark, sf_dir))
    )


@register
def attractiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.attractiveness_ranking(_integrated(spark, sf_dir))


@register
def affordability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir).select("district", "neighborhood", "affordability_ratio")


@register
def economic_accessibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kpi.economic_accessibility(_integrated(spark, sf_dir))
    return rounded(found, ["corr_income_price_per_m2", "corr_income_price"])


@register
def cultural_economic_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kpi.cultural_economic_correlation(_integrated(spark, sf_dir)), ["corr_culture_income"])


@register
def spatial_equity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kpi.spatial_equity(_integrated(spark, sf_dir, income_cuts=CUSTOM_INCOME_CUTS))
    return rounded(found, ["avg_density", "site_share_pct"])


@register
def kpi_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicators over stored marts, as a run has them: no mart is computed for two of them."""
    income, sites = _income(spark, sf_dir), _sites(spark, sf_dir)
    property_mart = stage(property_analytics(spark, sf_dir), "property")
    integrated_mart = marts.integrated_analytics(
        property_mart,
        marts.socioeconomic_neighborhood(income),
        marts.cultural_neighborhood(sites, income),
    )
    digest = kpi.kpi_digest(
        property_mart,
        marts.socioeconomic_district(income),
        marts.cultural_district(sites, income),
        integrated_mart,
    )
    return rounded(digest, ["value"])


# ------------------------------------------------------------------ profiling


def _dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with gaps made from their own values."""
    return B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50_000, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.year("o_orderdate").alias("o_year"),
    )


def _order_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders without key and price: mostly copies of each other."""
    return _dirty_orders(spark, sf_dir).drop("o_orderkey", "o_totalprice")


@register
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(_dirty_orders(spark, sf_dir))


@register
def missing_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_top(_dirty_orders(spark, sf_dir), 2)


@register
def missing_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_matrix(_dirty_orders(spark, sf_dir), order_by=["o_orderkey"])


@register
def duplicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows of the order kinds, compared by value."""
    return profile.duplicate_profile(_order_kinds(spark, sf_dir))


@register
def duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among whole document texts, compared by fingerprint."""
    return profile.duplicate_profile(B.table(spark, sf_dir, "documents"), ["text"], exact=False)


@register
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_profile(B.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quality_metrics(_order_kinds(spark, sf_dir))


@register
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        profile.quality_scores(quality_metrics(spark, sf_dir)),
        ["overview_score", "completeness", "uniqueness", "overall_quality"],
    )


@register
def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules tripped by the text columns of the order kinds."""
    kinds = _order_kinds(spark, sf_dir).drop("o_year")
    found = profile.insights(profile.quality_metrics(kinds, exact=False), len(numeric_columns(kinds)))
    return rounded(found, ["value"])


@register
def quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table's quality score split into gauge parts."""
    scored = []
    for name, df in (("orders", _dirty_orders(spark, sf_dir)), ("kinds", _order_kinds(spark, sf_dir))):
        score = profile.quality_scores(profile.quality_metrics(df)).select(
            F.lit(name).alias("dataset"), F.round("overall_quality", 6).alias("score")
        )
        scored.append(score)
    both = scored[0].unionByName(scored[1])
    banded = both.select("dataset", "score", profile.quality_bands(F.col("score")).alias("b")).select(
        "dataset", "score", "b.*"
    )
    return rounded(banded, ["high_quality", "medium_quality", "low_quality"])


@register
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        profile.histogram(B.table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity", "l_tax"]),
        ["lower", "upper"],
    )


@register
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_values(B.table(spark, sf_dir, "documents"), "source")


@register
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part of the columns have gaps; pairs count where both values are known."""
    gap = F.when(F.col("l_quantity") > 5, F.col("l_quantity")).alias("l_quantity")
    items = B.table(spark, sf_dir, "lineitem").select("l_extendedprice", gap, "l_discount", "l_linenumber")
    return rounded(profile.correlation_matrix(items), ["r"])


@register
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(_dirty_orders(spark, sf_dir)), ["mean", "std"], 4)


@register
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type classes of the columns as stored, beside the number of rows."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kinds = type_counts(events)
    rows = events.agg(F.count(F.lit(1)).alias("n")).scalar()
    return kinds.select("type_class", "column_count", rows.alias("total_rows"))


@register
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = profile.sample_rows(B.table(spark, sf_dir, "orders"), 1000, ["o_orderkey"])
    return sampled.select("o_orderkey", "o_custkey", "o_totalprice")


@register
def clipped_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = B.table(spark, sf_dir, "documents").select("doc_id", "text", "lang").orderBy("doc_id")
    return profile.clipped_preview(newest, 3)


# ----------------------------------------------------------------- validation


def _zone_status(
    spark: SparkSession, sf_dir: str, income: DataFrame | None = None, sites: DataFrame | None = None
) -> DataFrame:
    """Status of formatted inputs and marts, and of one mart that is not there."""
    income = income or _income(spark, sf_dir)
    sites = sites or _sites(spark, sf_dir)
    frames = [
        validate.table_status(_net_listings(spark, sf_dir), "formatted", "idealista"),
        validate.table_status(B.without_low_index(income), "formatted", "income"),
        validate.table_status(sites, "formatted", "cultural_sites"),
        validate.table_status(marts.cultural_category(sites), "exploitation", "categories", nulls=False),
        validate.table_status(marts.income_quintiles(income), "exploitation", "income_quintiles", nulls=False),
    ]
    absent = ("exploitation", "integrated_analytics", "error", None, None, None, None, "", "not found")
    frames.append(spark.createDataFrame([absent], validate.STATUS_SCHEMA))
    return reduce(DataFrame.unionByName, frames)


def _net_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings at a net price that may fall below zero, with the rooms unknown in some."""
    return B.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("status"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("rooms"),
        (F.col("l_quantity").cast("int") - 1).alias("size_m2"),
        (F.round(F.col("l_extendedprice") / 1000) - 5).alias("price_eur"),
    )


def _checks(
    spark: SparkSession, sf_dir: str, income: DataFrame | None = None, sites: DataFrame | None = None
) -> DataFrame:
    income = income or _income(spark, sf_dir)
    sites = sites or B.sites(spark, sf_dir)
    tested = {
        "idealista": _net_listings(spark, sf_dir),
        "income": B.without_low_index(income),
        "cultural_sites": sites,
    }
    frames = [validate.quality_checks(df, "formatted", name) for name, df in tested.items()]
    return reduce(DataFrame.unionByName, frames)


@register
def zone_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_zone_status(spark, sf_dir).drop("path"), ["null_percentage"])


@register
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules: dict[str, Column | str] = {
        **validate.RULES["idealista"],
        "many_rooms": "rooms > 4",
        "unknown_rooms": F.col("rooms").isNull(),
    }
    return validate.rule_violations(_net_listings(spark, sf_dir), rules)


@register
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_checks(spark, sf_dir).drop("error"), ["value"])


@register
def row_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the tables with a least row count has no status at all."""
    return validate.row_count_gate(_zone_status(spark, sf_dir), {**validate.MIN_RECORDS, "weather": 1})


@register
def required_mart_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = ["categories", "income_quintiles", "integrated_analytics", "property_analytics"]
    return validate.required_mart_gate(_zone_status(spark, sf_dir), required)


@register
def zone_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validate.zone_summary(_zone_status(spark, sf_dir)), ["success_rate"])


@register
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.run_summary(_zone_status(spark, sf_dir))


def _staged_verdicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Status and checks as stored tables of a few rows: no verdict scans the inputs again."""
    income, sites = _income(spark, sf_dir), _sites(spark, sf_dir)
    status = _zone_status(spark, sf_dir, income, sites)
    return stage(status, "status"), stage(_checks(spark, sf_dir, income, sites), "checks")


@register
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quality_score(*_staged_verdicts(spark, sf_dir))


@register
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, checks = _staged_verdicts(spark, sf_dir)
    found = validate.recommendations(validate.quality_score(status, checks), checks)
    return rounded(found, ["value"])


@register
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored report read back: its executive summary and a figure of each part."""
    report = validate.validation_report(
        spark,
        *_staged_verdicts(spark, sf_dir),
        kpi.as_metrics(kpi.culture_kpi(cultural_district(spark, sf_dir)), "cultural_accessibility"),
        "2025-01-01 00:00:00",
        "2025-01-01 00:00:02.5",
    )
    output = staged_path(spark, "output")
    reports.write_report(report, f"{output}/data_validation_report.json")
    return reports.read_reports(spark, f"{output}/*validation_report*").select(
        "executive_summary.*",
        F.col("zone_summary.formatted.total_records").alias("formatted_records"),
        F.col("zone_summary.exploitation.successful_loads").alias("marts_loaded"),
        F.col("kpi_summary.cultural_accessibility.total_cultural_sites").cast("bigint").alias("sites"),
        F.col("data_quality_details.idealista.negative_prices").cast("bigint").alias("negative_prices"),
        F.col("detailed_results.exploitation_details.integrated_analytics.error").alias("error"),
        F.size("recommendations").alias("advice"),
    )


@register
def zone_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart folders found in a zone after writing two marts, with the rows stored in each."""
    zone = staged_path(spark, "zone")
    tables.write_mart(marts.cultural_category(B.sites(spark, sf_dir)), zone, "cultural_category_analytics")
    tables.write_mart(marts.income_quintiles(_income(spark, sf_dir)), zone, "income_quintiles")
    names = [r["dataset"] for r in list_tables(spark, zone).collect()]
    status = validate.validate_zone(spark, "exploitation", zone, [*names, "integrated_analytics"], nulls=False)
    return status.select("zone", "dataset", "status", "record_count", "column_count")


@register
def log_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as log lines, searched whatever the letter case."""
    path = staged_path(spark, "logs")
    lines = F.format_string("%s user=%d %s", F.upper("event_type"), "user_id", "props")
    B.table(spark, sf_dir, "events").select(lines).write.text(path)
    return reports.search_logs(spark, f"{path}/*.txt", "error User").select("line")


# ------------------------------------------------------------------- learning


@register
def price_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two regressors trained on the listings, by validation error."""
    ranking, _ = regress.train(stage(model_rows(spark, sf_dir), "rows"), ["property_code"])
    return ranking


@register
def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as the models see them."""
    columns = ["neighborhood", "property_type", "size_m2", "rooms", "floor", "status", "price_eur", "is_exterior"]
    return regress.model_rows(B.listings(spark, sf_dir, parts=True), columns, keep=["property_code"])


@register
def model_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which side of the split each listing is on."""
    rows = B.listings(spark, sf_dir).select("property_code")
    sides = zip(("train", "validation"), regress.split(rows, ["property_code"]))
    return reduce(DataFrame.unionByName, [part.withColumn("side", F.lit(side)) for side, part in sides])


@register
def linear_price_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation error of a linear model of the price by size alone."""
    rows = B.listings(spark, sf_dir).select("property_code", "size_m2", F.col("price_eur").alias(regress.TARGET))
    models = {name: m for name, m in regress.regressors().items() if name == "LinearRegression"}
    ranking, _ = regress.train(stage(rows, "rows"), ["property_code"], models, partitions=8)
    return rounded(ranking, ["rmse"], 4)


# ------------------------------------------------------- landing files and zones


@register
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one array of records each."""
    path = staged_path(spark, "arrays")
    record = F.struct("conv_id", "turn", "role", "text")
    groups = B.table(spark, sf_dir, "conversations").groupBy(F.expr("conv_id div 50").alias("part"))
    groups.agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("part").text(path)
    return landing.read_json_arrays(spark, path, B.TABLES["conversations"]).drop("part")


@register
def folder_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of JSON lines, read without a schema."""
    path = staged_path(spark, "folder")
    B.table(spark, sf_dir, "conversations").write.json(path)
    return landing.read_folder(spark, path)


@register
def folder_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of CSV files whose texts hold line breaks, quotes and commas."""
    path = staged_path(spark, "folder")
    texts = B.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias('id "of", it'), "text", "lang")
    options = {"header": True, "quoteAll": True, "escape": '"'}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    mean = texts.agg(F.avg(F.octet_length("text"))).first()[0] or 0
    records = max(1, int(LANDING_BYTES / (mean + 1)))
    texts.write.options(maxRecordsPerFile=records, **options).csv(path)
    found = landing.read_folder(spark, path)
    return found.select(F.col('`id "of", it`').cast("bigint").alias("doc_id"), "text", "lang")


@register
def load_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes beyond the range of their type and districts of blanks do not stop or bend a load."""
    size = F.when(F.col("rooms") == 2, 3e10).otherwise(F.col("size"))
    district = F.when(F.col("floor") == "3", " ").otherwise(F.col("district"))
    raw = _raw_listings(spark, sf_dir).withColumns({"size": size, "district": district})
    zone = staged_path(spark, "formatted")
    tables.write_mart(standardize.format_listings(raw), zone, "idealista")
    return tables.read_mart(spark, zone, "idealista").select("property_code", "district", "size_m2")


@register
def load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a load, and of a mart, has the same known time."""
    loaded = standardize.format_listings(_raw_listings(spark, sf_dir)).select(F.col("load_timestamp").alias("at"))
    made = marts.stamped(marts.cultural_category(B.sites(spark, sf_dir))).select(F.col("created_at").alias("at"))
    counts = [F.count(F.lit(1)).alias("row_count"), F.count("at").alias("known"), F.count_distinct("at").alias("times")]
    both = [df.agg(*counts).withColumn("what", F.lit(name)) for name, df in (("load", loaded), ("mart", made))]
    return both[0].unionByName(both[1])


def _small_zone(spark: SparkSession, sf_dir: str) -> str:
    """A zone of two tables of one file each; one of them breaks the rules' expectations."""
    zone = staged_path(spark, "zone")
    B.table(spark, sf_dir, "nation").coalesce(1).write.parquet(f"{zone}/idealista")
    B.without_low_index(_income(spark, sf_dir)).coalesce(1).write.parquet(f"{zone}/income")
    return zone


@register
def zone_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a zone holds, and one that is not there."""
    zone = _small_zone(spark, sf_dir)
    found = zone_inventory(spark, {"formatted": zone, "landing": f"{zone}/none"})
    known = F.col("latest_modification").isNotNull().alias("dated")
    return found.select("zone", "exists", "dir_count", (F.col("total_size_mb") > 0).alias("has_content"), known)


@register
def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_file_counts(spark, _small_zone(spark, sf_dir))


@register
def required_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = _small_zone(spark, sf_dir)
    return required_datasets(spark, zone, ["idealista", "income", "cultural-sites"]).drop("path")


@register
def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(B.table(spark, sf_dir, "nation"))


@register
def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files of two runs, newest first."""
    path = staged_path(spark, "logs")
    events = B.table(spark, sf_dir, "events").select("event_type")
    for run in ("one", "two"):
        events.coalesce(1).write.text(f"{path}/{run}")
    listed = reports.list_logs(spark, f"{path}/*/*.txt").withColumn("run", F.element_at(F.split("path", "/"), -2))
    return listed.limit(1).select("run", (F.col("size") > 0).alias("has_content"))


@register
def newest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two stored reports the newer one."""
    path = staged_path(spark, "output")
    counted = B.table(spark, sf_dir, "labels").groupBy(F.col("toxic").alias("run")).agg(F.count(F.lit(1)).alias("rows"))
    for run in (1, 0):
        reports.write_report(counted.filter(F.col("run") == run), f"{path}/{run}_validation_report.json")
    return reports.read_reports(spark, f"{path}/*validation_report*").limit(1).select("run", "rows")


@register
def zone_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a zone in which one table lacks the columns that its rules need."""
    zone = _small_zone(spark, sf_dir)
    status = validate.validate_zone(spark, "formatted", zone, ["idealista", "income", "cultural_sites"])
    checks = validate.check_zone(spark, status)
    named = F.col("error").contains("price_eur").alias("names_column")
    return rounded(checks, ["value"]).select("zone", "dataset", "check", "value", named)


@register
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that lacks a dataset has failed, however good the tables are."""
    zone = _small_zone(spark, sf_dir)
    presence = required_datasets(spark, zone, ["idealista", "income", "cultural-sites"])
    formatted = validate.validate_zone(spark, "formatted", zone, ["idealista", "income"])
    made = validate.validate_zone(spark, "exploitation", zone, ["income"], nulls=False)
    checks = validate.check_zone(spark, formatted)
    score = validate.quality_score(formatted.unionByName(made), checks)
    return validate.pipeline_report(presence, formatted, made, score, "run-1", "2025-01-01")


# ----------------------------------------------------------- names, copies, gaps


@register
def newest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per customer, the newest; of several on that day the one with the largest key."""
    orders = B.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return dedup_latest(orders, ["o_custkey"], ["o_orderdate"]).drop("o_orderdate")


@register
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation, of which those with odd keys are spelt otherwise."""
    nation = B.table(spark, sf_dir, "nation")
    odd = nation.filter(F.col("n_nationkey") % 2 == 1)
    aliases = odd.select(F.concat(F.lit("  "), F.upper("n_name")).alias("alias"), F.concat("n_name", F.lit("!")).alias("name"))
    customers = B.table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return marts.with_canonical_names(customers.select("c_custkey", "n_name"), "n_name", aliases)


@register
def completeness_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness of rows of which some lack an index and some a price."""
    rows = _sparse_income(spark, sf_dir).select(
        F.col("district_name").alias("district"),
        F.col("neighborhood_name").alias("neighborhood"),
        F.when(F.col("year") != 1996, F.col("population")).alias("median_price_eur"),
        "income_index_bcn_100",
    )
    return rounded(kpi.completeness_kpi(rows), ["completeness_percentage"])


_ALL_NUMBERS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]


@register
def histogram_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numeric columns of the line items, one with infinities and NaN."""
    line = F.col("l_linenumber")
    odd = F.when(line == 6, float("inf")).when(line == 7, float("nan")).otherwise(F.col("l_tax")).alias("odd_tax")
    return rounded(profile.histogram(B.table(spark, sf_dir, "lineitem").select("*", odd)), ["lower", "upper"])


@register
def correlation_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven columns, all by default."""
    quantity = F.col("l_quantity")
    more = [
        (quantity * F.col("l_tax")).alias("quantity_tax"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("saved"),
        F.when(quantity > 5, F.col("l_linenumber")).alias("some_lines"),
    ]
    return rounded(profile.correlation_matrix(B.table(spark, sf_dir, "lineitem").select(*_ALL_NUMBERS, *more)), ["r"])


# ------------------------------------------------------------------- replacement


def _segments(customers: DataFrame, state: str) -> DataFrame:
    """Customers and their balance per market segment, as seen in one state of the table."""
    balance = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    found = customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), balance.alias("balance"))
    return found.withColumn("state", F.lit(state))


def _failing(customers: DataFrame) -> DataFrame:
    """Rows that cannot be written to the end."""
    broken = F.when(F.col("c_custkey") % 7 == 3, F.raise_error(F.lit("broken row"))).otherwise(F.col("c_acctbal"))
    return customers.withColumn("c_acctbal", broken)


def _replaced(spark: SparkSession, sf_dir: str, versioned: bool) -> DataFrame:
    """A table replaced from its own rows, then by a write that fails. ``before`` was opened in between."""
    path = staged_path(spark, "customers")
    how = {"partition_by": ["c_mktsegment"], "versioned": versioned}
    tables.write_table(B.table(spark, sf_dir, "customer"), path, **how)
    before = tables.read_table(spark, path)
    states = [] if versioned else [stage(_segments(before, "before"), "segments")]
    doubled = before.filter(F.col("c_acctbal") > 0).withColumn("c_acctbal", 2 * F.col("c_acctbal"))
    tables.write_table(doubled, path, **how)
    try:
        tables.write_table(_failing(before if versioned else tables.read_table(spark, path)), path, **how)
    except (PySparkException, Py4JJavaError):
        states.append(_segments(tables.read_table(spark, path), "after"))
    return reduce(DataFrame.unionByName, [*states, _segments(before, "before")] if versioned else states)


@register
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, versioned=False)


@register
def replaced_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader of the version before still sees all of its rows."""
    return _replaced(spark, sf_dir, versioned=True)


@register
def written_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of two tables from the figures of their writes."""
    zone, written = staged_path(spark, "zone"), {}
    for name, df in (("idealista", _net_listings(spark, sf_dir)), ("cultural_sites", _dirty_orders(spark, sf_dir))):
        figures = tables.write_table(df, f"{zone}/{name}", figures=validate.status_figures(df), versioned=True)
        written[name] = len(df.columns), figures
    return rounded(validate.written_status(spark, "formatted", zone, written).drop("path"), ["null_percentage"])


# ------------------------------------------------------------------------ forest


def _stump() -> RandomForestRegressor:
    """A forest of one tree that splits once, on all rows and all features."""
    return RandomForestRegressor(
        labelCol=regress.TARGET, numTrees=1, maxDepth=1, maxBins=128, bootstrap=False, featureSubsetStrategy="all"
    )


def _model_listings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    listings = B.listings(spark, sf_dir).select("property_code", *columns, F.col("price_eur").alias(regress.TARGET))
    return stage(listings, "rows")


@register
def forest_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of a tree that splits once: where, and the mean price on either side."""
    rows = _model_listings(spark, sf_dir, "size_m2", "rooms")
    _, fitted = regress.train(rows, ["property_code"], {"Stump": _stump()})
    found = trees.forest_nodes(spark, fitted["Stump"].stages[-1], regress.feature_names(fitted["Stump"]))
    return rounded(found.select("node", "feature", "threshold", "rows", "prediction"), ["prediction"], 4)


@register
def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation rows' prices by that tree, from a join of rows and nodes."""
    rows = _model_listings(spark, sf_dir, "size_m2", "rooms")
    _, fitted = regress.train(rows, ["property_code"], {"Stump": _stump()})
    *features, forest = fitted["Stump"].stages
    nodes = trees.forest_nodes(spark, forest, regress.feature_names(fitted["Stump"]))
    _, validation = regress.split(rows, ["property_code"])
    ready = PipelineModel(stages=features).transform(validation)
    return rounded(trees.predict_by_nodes(ready, nodes, trees=1, depth=1, keys=["property_code"]), ["prediction"], 4)


def _ranked(ranking: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.orderBy("rmse", "model")).cast("long")  # a row for each model
    return rounded(ranking.select(place.alias("place"), "model", "rmse"), ["rmse"], 4)


@register
def forest_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear model and a tree by their validation error, the best first."""
    models = {"LinearRegression": regress.regressors()["LinearRegression"], "Stump": _stump()}
    ranking, _ = regress.train(_model_listings(spark, sf_dir, "size_m2"), ["property_code"], models)
    return _ranked(ranking)


@register
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number each text label gets in the training rows: the most frequent first, ties by label."""
    rows = B.listings(spark, sf_dir, parts=True).select("property_code", "neighborhood", "property_type", "status", "rooms")
    known, _ = regress.split(rows, ["property_code"])
    fitted = Pipeline(stages=regress.feature_stages(rows, ignore=["property_code"])).fit(known)
    found = spark.createDataFrame(regress.labels(fitted), "column string, label string, index int")
    times = [known.groupBy(F.lit(c).alias("column"), F.col(c).alias("label")).count() for c in regress.CATEGORICAL]
    return found.join(reduce(DataFrame.unionByName, times), ["column", "label"])


@register
def training_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over the stored listings: the ranking, what was saved for the best and what it predicts from."""
    zone, path = staged_path(spark, "formatted"), staged_path(spark, "models")
    tables.write_mart(standardize.format_listings(_raw_listings(spark, sf_dir)), zone, "idealista")
    models = {"LinearRegression": regress.regressors()["LinearRegression"], "Stump": _stump()}
    ranking = _ranked(training.run_training(spark, zone, path, columns=["size_m2", "price_eur"], models=models))
    inputs = ",".join(f"{c} {t}" for c, t in regress.read_signature(spark, f"{path}/signature")["inputs"].items())
    saved = F.col("place") == 1
    examples = spark.read.parquet(f"{path}/example").agg(F.count("prediction")).scalar()
    return ranking.select("*", F.when(saved, inputs).alias("inputs"), F.when(saved, examples).alias("examples"))


# ------------------------------------------------------------------------ rollups

# KLL sketches of this size are exact in groups of so many rows.
SKETCH_K = 65_535

_MEDIANS = {"median_price_eur": ("price_eur", 0.5), "p90_price_per_m2": ("price_per_m2", 0.9)}
_GRAINS = {
    "city": [],
    "district": ["district"],
    "neighborhood": marts.PLACE,
    "property_type": ["district", "property_type"],
}


def _merged_prices(sketches: DataFrame, grain: str) -> DataFrame:
    keys = _GRAINS[grain]
    found = rollups.price_figures(rollups.merge_prices(sketches, keys, SKETCH_K), keys, _MEDIANS)
    absent = {k: F.lit(None).cast("string") for k in (*marts.PLACE, "property_type") if k not in keys}
    return found.withColumns(absent).withColumn("grain", F.lit(grain))


def _rounded_prices(sketches: DataFrame, grains: Sequence[str]) -> DataFrame:
    found = reduce(DataFrame.unionByName, [_merged_prices(sketches, g) for g in grains])
    return rounded(found, ["avg_price_eur", "avg_price_per_m2", "avg_size_m2"], 4)


@register
def price_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices at four grains out of stored sketches of the finest one; the listings are read once."""
    path = staged_path(spark, "sketches")
    tables.write_table(rollups.price_sketches(B.listings(spark, sf_dir, parts=True), SKETCH_K), path)
    return _rounded_prices(tables.read_table(spark, path), list(_GRAINS))


@register
def rollup_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The property mart by district and neighbourhood out of sketches; no group is aggregated from its rows."""
    sketches = stage(rollups.price_sketches(B.listings(spark, sf_dir, parts=True), SKETCH_K), "sketches")
    return rollups.property_marts(sketches, SKETCH_K)[0]


@register
def rollup_culture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cultural mart by district out of sketches."""
    sketches = stage(rollups.site_sketches(B.sites(spark, sf_dir)), "sketches")
    return rollups.cultural_marts(sketches, _income(spark, sf_dir))[0]


@register
def price_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of which one neighbourhood was built anew after its prices doubled and its cheap listings went."""
    path, source = staged_path(spark, "sketches"), staged_path(spark, "listings")
    listings = B.listings(spark, sf_dir, parts=True)
    build = lambda df: rollups.price_sketches(df, SKETCH_K)
    tables.write_table(build(listings), path, versioned=True)
    here = F.col("neighborhood") == "FRANCE"
    changed = listings.withColumn("price_eur", F.when(here, 2 * F.col("price_eur")).otherwise(F.col("price_eur")))
    tables.write_table(changed.filter(~here | (F.col("price_eur") > 30_000)), source, ["district"])
    stored = tables.read_table(spark, source)
    new = rollups.refreshed(tables.read_table(spark, path), stored, [("EUROPE", "FRANCE")], build)
    tables.write_table(new, path, versioned=True)
    return _rounded_prices(tables.read_table(spark, path), ["district", "neighborhood"]).drop("property_type")


@register
def site_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites and their different categories and types per neighbourhood, district and city, from stored sketches."""
    path = staged_path(spark, "sketches")
    tables.write_table(rollups.site_sketches(B.sites(spark, sf_dir)), path)
    stored = tables.read_table(spark, path)
    found = []
    for grain in ("city", "district", "neighborhood"):
        keys = _GRAINS[grain]
        absent = {k: F.lit(None).cast("string") for k in marts.PLACE if k not in keys}
        merged = rollups.site_figures(rollups.merge_sites(stored, keys), keys)
        found.append(merged.withColumns(absent).withColumn("grain", F.lit(grain)))
    return reduce(DataFrame.unionByName, found)


# ------------------------------------------------- bounded profiles, landing, increments


@register
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among whole documents, compared by value where fingerprints repeat."""
    return duplicates.exact_duplicates(B.table(spark, sf_dir, "documents").select("text", "lang", "source"))


@register
def exact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates and broken rules of the listings, rows compared by value."""
    checks = validate.quality_checks(_net_listings(spark, sf_dir), "formatted", "idealista", exact=True)
    return rounded(checks.drop("error"), ["value"])


@register
def heavy_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts sold most often, of many that are sold nearly as often."""
    return heavy.heavy_values(B.table(spark, sf_dir, "lineitem"), "l_partkey", tracked=256, buckets=4096)


@register
def heavy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources and kinds of documents, NULL among them."""
    label = F.when(F.col("doc_id") % 5 > 0, F.concat_ws("/", "source", "lang")).alias("label")
    return heavy.heavy_values(B.table(spark, sf_dir, "documents").select(label), "label", n=20)


@register
def gram_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven columns of ``correlation_all`` by matrix products, blocks of four columns."""
    quantity = F.col("l_quantity")
    more = [
        (quantity * F.col("l_tax")).alias("quantity_tax"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("saved"),
        F.when(quantity > 5, F.col("l_linenumber")).alias("some_lines"),
    ]
    items = B.table(spark, sf_dir, "lineitem").select(*_ALL_NUMBERS, *more)
    return rounded(gram.gram_correlations(items, block=4), ["r"])


@register
def mixed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by line, arrays and documents of several lines, whose columns differ and conflict, read without a schema."""
    path = staged_path(spark, "mixed")
    orders = B.table(spark, sf_dir, "orders").withColumn("kind", F.col("o_orderkey") % 4)
    key, customer = F.col("o_orderkey").alias("k"), F.col("o_custkey")
    shapes = [
        F.struct(key, customer.alias("v")),
        F.struct(key, F.col("o_orderstatus").alias("v"), F.struct(customer.alias("c")).alias("n")),
        F.array(F.struct(key, (F.col("o_totalprice") > 1e5).alias("big"))),
    ]
    for kind, shape in enumerate(shapes):
        orders.filter(F.col("kind") == kind).select(F.to_json(shape).alias("value")).write.text(f"{path}/{kind}")
    record = F.to_json(F.struct(key, F.lit("x").alias("it's")), {"pretty": "true"})
    documents = orders.filter(F.col("kind") == 3).groupBy((F.col("o_orderkey") % 64).alias("part"))
    documents = documents.agg(F.array_join(F.collect_list(record), ",\n").alias("all"))
    value = F.concat(F.lit("[\n"), "all", F.lit("\n]")).alias("value")
    documents.select("part", value).write.partitionBy("part").text(f"{path}/3")
    files = [e.path for kind in range(3) for e in entries(spark, f"{path}/{kind}") if e.name.endswith(".txt")]
    parts = [e.path for e in entries(spark, f"{path}/3") if e.is_dir]
    files += [e.path for part in parts for e in entries(spark, part) if e.name.endswith(".txt")]
    found = landing.read_files(spark, json=files)
    return found.select("k", "v", "big", F.col("n.c").alias("c"), F.col("`it's`").alias("its"))


@register
def log_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error lines of logs that came in two parts, and the run that read each; the third run finds nothing new."""
    logs, target = staged_path(spark, "logs"), staged_path(spark, "ingested")
    lines = F.format_string("%s user=%d %s", F.upper("event_type"), "user_id", "props")
    events = B.table(spark, sf_dir, "events")
    came = []
    for part in (0, 1):
        events.filter(F.col("event_id") % 2 == part).select(lines).write.mode("append").text(logs)
        came.append(increments.ingest_files(spark, logs, target, "*.txt"))
    came.append(increments.ingest_files(spark, logs, target, "*.txt"))
    found = increments.search_ingested(spark, target, "error User")
    rows_came = F.get(F.array(*map(F.lit, came)), F.col("batch")).cast("long").alias("came")
    return found.select("line", "batch", rows_came, F.lit(came[2]).cast("long").alias("again"))


# ---------------------------------------------------------------- counted folders


def _region_zone(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """A zone with a folder for each region that has nations, and a file in it for each of its nations."""
    zone = staged_path(spark, "zone")
    nation = B.table(spark, sf_dir, "nation")
    regions = [r["n_regionkey"] for r in nation.select("n_regionkey").distinct().orderBy("n_regionkey").collect()]
    for key in regions:
        here = nation.filter(F.col("n_regionkey") == key).coalesce(1)
        here.write.option("maxRecordsPerFile", 1).parquet(f"{zone}/region-{key}")
    return zone, [f"region-{key}" for key in regions]


@register
def zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders and files of a zone: one file a nation and the mark of a finished write in each folder."""
    zone, _ = _region_zone(spark, sf_dir)
    found = zone_inventory(spark, {"regions": zone, "none": f"{zone}/none"})
    return found.select("zone", "exists", "dir_count", "file_count")


@register
def folder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each folder, once as the tables of the zone, once as required folders of which one is missing."""
    zone, names = _region_zone(spark, sf_dir)
    asked = F.lit("table").alias("asked")
    listed = table_file_counts(spark, zone).select("dataset", F.lit(True).alias("exists"), "file_count", asked)
    required = required_datasets(spark, zone, [*names, "region-none"]).drop("path").withColumn("asked", F.lit("required"))
    return listed.unionByName(required)


@register
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a long and of a short table a preview holds."""
    counts = []
    for name in ("orders", "nation"):
        preview = profile.preview(B.table(spark, sf_dir, name))
        shown = preview.agg(F.count(F.lit(1)).alias("shown"))
        counts.append(shown.select(F.lit(name).alias("dataset"), "shown", F.lit(len(preview.columns)).alias("columns")))
    return counts[0].unionByName(counts[1])
