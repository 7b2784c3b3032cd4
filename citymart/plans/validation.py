"""Validation of both zones, with its report."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymart.operators import kpi, validate
from citymart.sources import reports, tables
from citymart.sources.schemas import EXPLOITATION, FORMATTED

REPORT = "data_validation_report.json"

# Which stored mart feeds which argument of the KPI digest.
_DIGEST_INPUTS = {
    "property_mart": "property_analytics",
    "socio_district": "socioeconomic_district_analytics",
    "cultural_district": "cultural_district_analytics",
    "integrated": "integrated_analytics",
}


def stored_kpis(
    spark: SparkSession, status: DataFrame, exploitation_zone: str, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Indicators of the marts that loaded; empty if none did."""
    loaded = {r["dataset"] for r in status.filter(F.col("status") == "success").collect()}
    inputs = {
        argument: tables.read_mart(spark, exploitation_zone, name, fmt)
        for argument, name in _DIGEST_INPUTS.items()
        if name in loaded
    }
    if not inputs:
        return spark.createDataFrame([], "kpi string, metric string, value double")
    return kpi.kpi_digest(**inputs)


def run_validation(
    spark: SparkSession,
    formatted_zone: str,
    exploitation_zone: str,
    output: str,
    fmt: str = tables.DEFAULT_FORMAT,
    exact: bool = False,
) -> DataFrame:
    """Validate all tables, store the report under ``output`` and return it as one row."""
    started = datetime.now(timezone.utc)
    formatted = validate.validate_zone(spark, "formatted_zone", formatted_zone, list(FORMATTED), fmt=fmt)
    marts = validate.validate_zone(
        spark, "exploitation_zone", exploitation_zone, list(EXPLOITATION), nulls=False, fmt=fmt
    )
    checks = validate.check_zone(spark, formatted, fmt, exact)
    kpis = stored_kpis(spark, marts, exploitation_zone, fmt)
    rows = spark.createDataFrame(kpis.collect(), kpis.schema)  # about a dozen numbers
    finished = datetime.now(timezone.utc)
    report = validate.validation_report(
        spark, formatted.unionByName(marts), checks, rows, _text(started), _text(finished)
    )
    reports.write_report(report, f"{output}/{REPORT}")
    return report


def _text(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%d %H:%M:%S.%f")
