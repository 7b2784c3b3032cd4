"""Landing zone to formatted zone."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from citymart.operators import standardize, validate
from citymart.sources import landing, schemas, tables
from citymart.sources.files import required_datasets

# Landing folder of each formatted table.
LANDING_FOLDERS = {"idealista": "idealista", "income": "income", "cultural_sites": "cultural-sites"}

READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "idealista": lambda spark, path: standardize.format_listings(
        landing.read_json_arrays(spark, path, schemas.LISTINGS_LANDING)
    ),
    "income": lambda spark, path: standardize.format_income(
        landing.read_csv(spark, path, schemas.INCOME_LANDING)
    ),
    # Wide files of which few columns count: read as text, typed by the standardising projection. Their
    # free texts may hold line breaks.
    "cultural_sites": lambda spark, path: standardize.format_sites(
        landing.read_csv(spark, path, infer=False, multi_line=True)
    ),
}


def landing_presence(spark: SparkSession, landing_zone: str) -> DataFrame:
    """Which landing folders exist; see ``validate.assert_required`` for the gate."""
    return required_datasets(spark, landing_zone, list(LANDING_FOLDERS.values()))


def run_formatting(
    spark: SparkSession, landing_zone: str, formatted_zone: str, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Format and store every dataset; an error in one does not stop the rest. One status row each, its figures taken
    while the table is written."""
    failed, written = {}, {}
    for name, folder in LANDING_FOLDERS.items():
        try:
            formatted = READERS[name](spark, f"{landing_zone}/{folder}")
            figures = validate.status_figures(formatted)
            written[name] = len(formatted.columns), tables.write_mart(formatted, formatted_zone, name, fmt, figures)
        except (PySparkException, Py4JJavaError) as error:
            failed[name] = error
    status = validate.written_status(spark, "formatted", formatted_zone, written)
    return status.unionByName(validate.failed_status(spark, "formatted", formatted_zone, failed))
