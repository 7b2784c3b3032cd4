"""Data validation: table status, rule checks, gates, scores, recommendations and the report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from citymart.functions.columns import percent_of
from citymart.operators.duplicates import exact_kinds
from citymart.operators.profile import distinct_kinds, null_totals, row_nulls
from citymart.session import side_by_side
from citymart.sources.tables import DEFAULT_FORMAT, read_table

STATUS_SCHEMA = """
    zone string, dataset string, status string, record_count bigint, column_count int,
    null_count bigint, null_percentage double, path string, error string
"""
CHECK_SCHEMA = "zone string, dataset string, check string, value double, error string"

# So many tables of a zone are looked at side by side.
SIDE_BY_SIDE = 4

# Fixed value: the last year that income can be known for.
LAST_YEAR = 2025


def rules(last_year: int = LAST_YEAR) -> dict[str, dict[str, str]]:
    """Rules per dataset, counted as violations."""
    return {
        "idealista": {"negative_prices": "price_eur <= 0", "zero_sizes": "size_m2 <= 0"},
        "income": {"negative_income": "income_index_bcn_100 < 0", "future_years": f"year > {int(last_year)}"},
    }


RULES = rules()

# Least row counts of the formatted tables, marts that must not be empty.
MIN_RECORDS = {"idealista": 10_000, "income": 500, "cultural_sites": 400}
REQUIRED_MARTS = [
    "property_analytics",
    "socioeconomic_district_analytics",
    "cultural_district_analytics",
    "integrated_analytics",
]

# Thresholds of the overall status and the recommendations.
PASS_LOAD_RATE = 80
MIN_QUALITY_SCORE = 80
MAX_DUPLICATE_PCT = 10

# The advice given, as formats.
FAILED_LOADS = "⚠️ %d datasets failed to load. Check data paths and file formats."
LOW_QUALITY = "⚠️ Data quality score is %.1f%%. Review data cleaning processes."
MANY_DUPLICATES = "⚠️ High duplicate rate in %s (%.1f%%). Consider deduplication."
INVALID_PRICES = "⚠️ Found %d records with invalid prices in %s. Review price validation rules."
HEALTHY = "✅ All validations passed. Data pipeline is healthy."


class GateError(RuntimeError):
    """A gate found datasets that must not pass."""


# ----------------------------------------------------------------- status


def table_status(df: DataFrame, zone: str, dataset: str, path: str = "", nulls: bool = True) -> DataFrame:
    """One status row of a table that loads, with null figures if wanted, from one pass."""
    figures = (
        null_totals(df)
        if nulls
        else df.agg(F.count(F.lit(1)).alias("record_count")).select(
            "record_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(None).cast("bigint").alias("null_count"),
            F.lit(None).cast("double").alias("null_percentage"),
        )
    )
    return figures.select(
        F.lit(zone).alias("zone"),
        F.lit(dataset).alias("dataset"),
        F.lit("success").alias("status"),
        "record_count",
        "column_count",
        "null_count",
        "null_percentage",
        F.lit(path).alias("path"),
        F.lit(None).cast("string").alias("error"),
    )


def _failure(error: Exception) -> str:
    return str(error).strip() or type(error).__name__


def status_figures(df: DataFrame, nulls: bool = True) -> dict[str, Column]:
    """What a status row needs to know of a table, as aggregates that a write can take along."""
    figures = {"record_count": F.count(F.lit(1))}
    if nulls:
        figures["null_count"] = F.coalesce(F.sum(row_nulls(df)), F.lit(0))
    return figures


def written_status(spark: SparkSession, zone: str, path: str, written: Mapping[str, tuple[int, Mapping]]) -> DataFrame:
    """Status rows of tables just written, from their number of columns and the figures of the write."""
    rows = [
        (zone, name, "success", figures["record_count"], columns, figures.get("null_count"), None, f"{path}/{name}", None)
        for name, (columns, figures) in written.items()
    ]
    cells = F.col("record_count") * F.col("column_count")
    share = F.when(F.col("null_count").isNotNull(), percent_of(F.col("null_count"), cells))
    return spark.createDataFrame(rows, STATUS_SCHEMA).withColumn("null_percentage", share)


def validate_zone(
    spark: SparkSession,
    zone: str,
    path: str,
    datasets: Sequence[str],
    nulls: bool = True,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """Status rows of a zone's tables. A table that cannot be read gets an error row.

    Each table is one aggregation run on its own, so a broken one does not stop the others; only
    its single result row comes back to the driver.
    """

    def status(dataset: str) -> tuple:
        where = f"{path}/{dataset}"
        try:
            return tuple(table_status(read_table(spark, where, fmt), zone, dataset, where, nulls).first())
        except (PySparkException, Py4JJavaError) as error:
            return zone, dataset, "error", None, None, None, None, where, _failure(error)

    return spark.createDataFrame(side_by_side(spark, status, datasets, SIDE_BY_SIDE), STATUS_SCHEMA)


def failed_status(spark: SparkSession, zone: str, path: str, failed: Mapping[str, Exception]) -> DataFrame:
    """Error rows for datasets that could not be built."""
    rows = [
        (zone, name, "error", None, None, None, None, f"{path}/{name}", _failure(error))
        for name, error in failed.items()
    ]
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def run_summary(status: DataFrame) -> DataFrame:
    """Datasets, failures and records of a run in one row."""
    return status.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if(F.col("status") == "success").alias("successful_loads"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
    )


def zone_summary(status: DataFrame) -> DataFrame:
    """Datasets, successful loads, their share and their records per zone."""
    ok = F.col("status") == "success"
    return status.groupBy("zone").agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if(ok).alias("successful_loads"),
        F.coalesce(F.sum(F.when(ok, F.col("record_count"))), F.lit(0)).alias("total_records"),
        percent_of(F.count_if(ok), F.count(F.lit(1))).alias("success_rate"),
    )


# ----------------------------------------------------------------- checks


def rule_violations(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """How many rows break each rule, all rules in one pass: ``(check, value)``."""
    predicates = {n: F.expr(p) if isinstance(p, str) else p for n, p in rules.items()}
    counted = df.agg(*[F.count_if(p).alias(f"v_{i}") for i, p in enumerate(predicates.values())])
    pairs = [
        F.struct(F.lit(n).alias("check"), F.col(f"v_{i}").cast("double").alias("value"))
        for i, n in enumerate(predicates)
    ]
    return counted.select(F.inline(F.array(*pairs)))


def quality_checks(
    df: DataFrame,
    zone: str,
    dataset: str,
    rules: Mapping[str, Column | str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Duplicates and rule violations of a table as rows ``(zone, dataset, check, value, error)``.

    Rows are compared by a 128-bit fingerprint, in one pass. If ``exact``, those whose fingerprint repeats are then
    compared column by column.
    """
    rules = RULES.get(dataset, {}) if rules is None else rules
    broken = {
        f"rule_{i}": F.coalesce((F.expr(p) if isinstance(p, str) else p).cast("int"), F.lit(0))
        for i, p in enumerate(rules.values())
    }
    copies = F.col("copies")
    duplicates, total = F.coalesce(F.sum(copies - 1), F.lit(0)), F.coalesce(F.sum(copies), F.lit(0))
    kinds = exact_kinds(df, broken) if exact else distinct_kinds(df, broken, exact=False)
    counted = kinds.agg(
        duplicates.alias("duplicate_count"),
        percent_of(duplicates, total).alias("duplicate_percentage"),
        *[F.coalesce(F.sum(copies * F.col(r)), F.lit(0)).alias(r) for r in broken],
    )
    values = {"duplicate_count": "duplicate_count", "duplicate_percentage": "duplicate_percentage"}
    values |= dict(zip(rules, broken))
    pairs = [F.struct(F.lit(c).alias("check"), F.col(v).cast("double").alias("value")) for c, v in values.items()]
    return counted.select(
        F.lit(zone).alias("zone"),
        F.lit(dataset).alias("dataset"),
        F.inline(F.array(*pairs)),
        F.lit(None).cast("string").alias("error"),
    )


def check_zone(
    spark: SparkSession, status: DataFrame, fmt: str = DEFAULT_FORMAT, exact: bool = False
) -> DataFrame:
    """Quality checks of every table that loaded; a check that fails to run becomes an ``error`` row
    with the whole text of the error."""

    def check(table: Row) -> list[tuple]:
        try:
            df = read_table(spark, table["path"], fmt)
            return [tuple(r) for r in quality_checks(df, table["zone"], table["dataset"], exact=exact).collect()]
        except (PySparkException, Py4JJavaError) as error:
            return [(table["zone"], table["dataset"], "error", None, _failure(error))]

    loaded = status.filter(F.col("status") == "success").orderBy("zone", "dataset").collect()
    checked = side_by_side(spark, check, loaded, SIDE_BY_SIDE)
    return spark.createDataFrame([r for found in checked for r in found], CHECK_SCHEMA)


# ------------------------------------------------------------------ gates


def row_count_gate(status: DataFrame, minimums: Mapping[str, int] = MIN_RECORDS) -> DataFrame:
    """PASS or FAIL of each loaded table against its least row count, ERROR of one that did not load,
    MISSING of one that has a least row count but no status."""
    spark = status.sparkSession
    limits = spark.createDataFrame(list(minimums.items()), "dataset string, min_required bigint")
    needed = F.coalesce("min_required", F.lit(0).cast("bigint"))
    gate = (
        F.when(F.col("status").isNull(), "MISSING")
        .when(F.col("status") != "success", "ERROR")
        .when(F.col("record_count") >= needed, "PASS")
        .otherwise("FAIL")
    )
    found = status.select("dataset", "status", "record_count")
    return limits.join(found, "dataset", "full").select(
        "dataset", "record_count", needed.alias("min_required"), gate.alias("gate")
    )


def required_mart_gate(status: DataFrame, required: Sequence[str] = REQUIRED_MARTS) -> DataFrame:
    """Each required mart must exist, load and hold rows: PASS, FAIL, ERROR or MISSING."""
    spark = status.sparkSession
    names = spark.createDataFrame([(n,) for n in required], "dataset string")
    gate = (
        F.when(F.col("status").isNull(), "MISSING")
        .when(F.col("status") != "success", "ERROR")
        .when(F.col("record_count") > 0, "PASS")
        .otherwise("FAIL")
    )
    return names.join(status.select("dataset", "status", "record_count"), "dataset", "left").select(
        "dataset", "record_count", gate.alias("gate")
    )


def assert_gate(gate: DataFrame, fail_on: Sequence[str] = ("FAIL", "ERROR", "MISSING")) -> None:
    """Raise if any dataset has one of the given outcomes."""
    failed = [r["dataset"] for r in gate.filter(F.col("gate").isin(*fail_on)).orderBy("dataset").collect()]
    if failed:
        raise GateError(f"datasets that failed validation: {', '.join(failed)}")


def assert_required(presence: DataFrame) -> None:
    """Raise if a required landing dataset is missing."""
    missing = [r["dataset"] for r in presence.filter(~F.col("exists")).orderBy("dataset").collect()]
    if missing:
        raise GateError(f"missing required datasets: {', '.join(missing)}")


# --------------------------------------------------------------- verdicts


def quality_score(status: DataFrame, checks: DataFrame) -> DataFrame:
    """Quality score, load success rate and dataset counts in one row.

    The score is the mean of 100 minus the duplicate percentage over the checked tables.
    """
    scores = checks.filter(F.col("check") == "duplicate_percentage").select(
        F.greatest(F.lit(0.0), 100 - F.col("value")).alias("score"),
        F.lit(None).cast("string").alias("status"),
    )
    loads = status.select(F.lit(None).cast("double").alias("score"), "status")
    total, good = F.count("status"), F.count_if(F.col("status") == "success")
    return scores.unionByName(loads).agg(
        F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 2).alias("overall_quality_score"),
        F.round(percent_of(good, total), 2).alias("load_success_rate"),
        total.alias("total_datasets"),
        good.alias("successful_loads"),
        (total - good).alias("failed_loads"),
    )


def overall_status(load_success_rate: Column) -> Column:
    return F.when(load_success_rate > PASS_LOAD_RATE, "PASSED").otherwise("FAILED")


def recommendations(score: DataFrame, checks: DataFrame) -> DataFrame:
    """What to look into, as rows ``(rule, dataset, value, message)``; one "healthy" row if nothing."""
    none = F.lit(None).cast("string")

    def advice(source: DataFrame, hit: Column, rule: str, value: Column, message: Column, dataset: Column = none):
        return source.filter(hit).select(
            F.lit(rule).alias("rule"),
            dataset.alias("dataset"),
            value.cast("double").alias("value"),
            message.alias("message"),
        )

    failed, points, value = F.col("failed_loads"), F.col("overall_quality_score"), F.col("value")
    duplicates = (F.col("check") == "duplicate_percentage") & (value > MAX_DUPLICATE_PCT)
    prices = (F.col("check") == "negative_prices") & (value > 0)
    name = F.col("dataset")
    found = [
        advice(
            score, F.col("load_success_rate") < 100, "failed_loads", failed, F.format_string(FAILED_LOADS, failed)
        ),
        advice(
            score, points < MIN_QUALITY_SCORE, "low_quality_score", points, F.format_string(LOW_QUALITY, points)
        ),
        advice(
            checks, duplicates, "high_duplicate_rate", value, F.format_string(MANY_DUPLICATES, name, value), name
        ),
        advice(
            checks, prices, "invalid_prices", value, F.format_string(INVALID_PRICES, value.cast("long"), name), name
        ),
    ]
    rows = reduce(DataFrame.unionByName, found)
    # The rule rows are few: gathering them in one array lets the empty case produce its own row.
    row_type = "array<struct<rule:string,dataset:string,value:double,message:string>>"
    healthy = F.array(
        F.struct(
            F.lit("healthy").alias("rule"),
            none.alias("dataset"),
            F.lit(None).cast("double").alias("value"),
            F.lit(HEALTHY).alias("message"),
        )
    ).cast(row_type)
    gathered = F.collect_list(F.struct("rule", "dataset", "value", "message")).cast(row_type)
    return rows.agg(gathered.alias("found")).select(
        F.inline(F.when(F.size("found") > 0, F.col("found")).otherwise(healthy))
    )


# ----------------------------------------------------------------- report


def _entries(key: str, value: Column) -> Column:
    """Aggregate of a small table into a map with its keys in a stable order."""
    pairs = F.collect_list(F.struct(F.col(key).alias("key"), value.alias("value")))
    by_key = F.array_sort(pairs, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.map_from_entries(by_key)


def _as_map(df: DataFrame, key: str, value: Column) -> DataFrame:
    return df.agg(_entries(key, value).alias("map"))


def _nested(df: DataFrame, outer: str, inner: str, value: Column) -> DataFrame:
    """A small result table as one row with a map of maps."""
    return _as_map(df.groupBy(outer).agg(_entries(inner, value).alias("inner")), outer, F.col("inner"))


def validation_report(
    spark: SparkSession,
    status: DataFrame,
    checks: DataFrame,
    kpis: DataFrame,
    started: str,
    finished: str,
    version: str = "1.0",
) -> DataFrame:
    """The whole validation run as one nested row, a document keyed by zone, dataset and indicator.

    Its parts are result tables of a few rows each. Scalar subqueries place them in the document, so
    no join is needed.
    """
    score = quality_score(status, checks)
    summary = F.struct("total_datasets", "successful_loads", "total_records", "success_rate")
    details = F.struct(*[c for c in status.columns if c not in ("zone", "dataset")])
    advice = recommendations(score, checks).agg(F.sort_array(F.collect_list("message")))
    zoned = status.withColumn("zone", F.concat("zone", F.lit("_details")))
    parts = spark.range(1).select(
        score.select(F.struct("*")).scalar().alias("verdict"),
        _as_map(zone_summary(status), "zone", summary).scalar().alias("zone_summary"),
        _nested(kpis, "kpi", "metric", F.col("value")).scalar().alias("kpi_summary"),
        _nested(checks, "dataset", "check", F.col("value")).scalar().alias("data_quality_details"),
        _as_map(checks.filter("error is not null"), "dataset", F.col("error")).scalar().alias("check_errors"),
        _nested(zoned, "zone", "dataset", details).scalar().alias("detailed_results"),
        advice.scalar().alias("recommendations"),
    )
    seconds = F.to_timestamp(F.lit(finished)).cast("double") - F.to_timestamp(F.lit(started)).cast("double")
    return parts.select(
        F.struct(
            F.lit(finished).alias("generated_at"),
            F.lit(version).alias("pipeline_version"),
            F.lit("data_validation_summary").alias("report_type"),
        ).alias("report_metadata"),
        F.struct(
            overall_status(F.col("verdict.load_success_rate")).alias("overall_status"),
            F.col("verdict.overall_quality_score").alias("data_quality_score"),
            F.col("verdict.load_success_rate").alias("load_success_rate"),
            F.col("verdict.total_datasets").alias("total_datasets_validated"),
            F.format_string("%.2fs", seconds).alias("execution_time"),
        ).alias("executive_summary"),
        "zone_summary",
        "kpi_summary",
        "data_quality_details",
        "check_errors",
        F.struct(
            seconds.alias("execution_time_seconds"),
            F.format_string("%.2fs", seconds).alias("execution_time_formatted"),
            F.lit(started).alias("start_time"),
            F.lit(finished).alias("end_time"),
            F.lit(spark.version).alias("spark_version"),
        ).alias("performance_metrics"),
        "detailed_results",
        "recommendations",
    )


def pipeline_report(
    presence: DataFrame,
    formatted: DataFrame,
    exploitation: DataFrame,
    score: DataFrame,
    run_id: str,
    run_date: str,
) -> DataFrame:
    """One row on a whole run: datasets per stage, records formatted and the verdict.

    The run failed if a required dataset is absent, a table did not load or the validation failed.
    """
    counted = [
        presence.agg(F.count(F.lit(1)).alias("n")).scalar().alias("landing_zone_datasets"),
        formatted.agg(F.count(F.lit(1)).alias("n")).scalar().alias("formatted_datasets"),
        exploitation.agg(F.count(F.lit(1)).alias("n")).scalar().alias("analytics_datasets"),
        formatted.agg(F.coalesce(F.sum("record_count"), F.lit(0)).alias("n"))
        .scalar()
        .alias("total_records_processed"),
    ]
    absent = presence.agg(F.count_if(~F.col("exists")).alias("n")).scalar()
    broken = formatted.unionByName(exploitation).agg(F.count_if(F.col("status") != "success").alias("n")).scalar()
    verdict = overall_status(F.col("load_success_rate"))
    failed = (absent > 0) | (broken > 0) | (verdict != "PASSED")
    return score.select(
        F.lit(run_date).alias("execution_date"),
        F.lit(run_id).alias("run_id"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("pipeline_status"),
        *counted,
        verdict.alias("status"),
        F.col("overall_quality_score").alias("quality_score"),
        "load_success_rate",
    )
