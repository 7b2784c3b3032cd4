"""Formatted zone to exploitation zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citymart.operators import marts, rollups, validate
from citymart.plans.rollups import ROLLUPS, build_rollups
from citymart.session import scratch
from citymart.sources import tables
from citymart.sources.schemas import EXPLOITATION


def run_exploitation(
    spark: SparkSession,
    formatted_zone: str,
    exploitation_zone: str,
    fmt: str = tables.DEFAULT_FORMAT,
    exact: bool = False,
    fold_names: bool = False,
    aliases: DataFrame | None = None,
    from_sketches: bool = False,
) -> DataFrame:
    """Build and store the nine marts; one status row each, its figures taken while the mart is written.

    ``from_sketches`` first stores sketch tables per neighbourhood (see ``plans.rollups``) and builds the property and
    cultural marts from them: a few KB a group, whatever its size, and a later run needs to read changed neighbourhoods only.

    The integrated mart is built from the stored neighbourhood marts, so nothing is computed twice.
    """
    with scratch(spark):
        written = _build(spark, formatted_zone, exploitation_zone, fmt, exact, fold_names, aliases, from_sketches)
    in_order = {name: written[name] for name in EXPLOITATION}
    return validate.written_status(spark, "exploitation", exploitation_zone, in_order)


def _build(
    spark: SparkSession,
    formatted_zone: str,
    exploitation_zone: str,
    fmt: str,
    exact: bool,
    fold_names: bool,
    aliases: DataFrame | None,
    from_sketches: bool,
) -> dict[str, tuple[int, dict]]:
    """The number of columns and the figures of each mart that was written."""
    written = {}

    def formatted(name: str) -> DataFrame:
        return tables.read_mart(spark, formatted_zone, name, fmt)

    def stored(name: str) -> DataFrame:
        return tables.read_mart(spark, exploitation_zone, name, fmt)

    def write(df: DataFrame, name: str) -> None:
        figures = validate.status_figures(df, nulls=False)
        written[name] = len(df.columns), tables.write_mart(df, exploitation_zone, name, fmt, figures)

    listings, income, sites = formatted("idealista"), formatted("income"), formatted("cultural_sites")
    if from_sketches:
        build_rollups(spark, formatted_zone, exploitation_zone, fmt)
        sketched = [tables.read_table(spark, f"{exploitation_zone}/{name}", fmt) for name in ROLLUPS]
        prices, prices_by_type = rollups.property_marts(sketched[0])
        culture = rollups.cultural_marts(sketched[1], income)
    else:
        prices, prices_by_type = marts.property_marts(listings, exact)
        culture = marts.cultural_district(sites, income), marts.cultural_neighborhood(sites, income)
    write(marts.stamped(prices), "property_analytics")
    write(prices_by_type, "property_type_analytics")
    write(marts.socioeconomic_district(income, exact), "socioeconomic_district_analytics")
    write(marts.socioeconomic_neighborhood(income), "socioeconomic_neighborhood_analytics")
    write(marts.income_quintiles(income), "income_quintiles")
    write(culture[0], "cultural_district_analytics")
    write(culture[1], "cultural_neighborhood_analytics")
    write(marts.cultural_category(sites), "cultural_category_analytics")
    integrated = marts.integrated_analytics(
        stored("property_analytics"),
        stored("socioeconomic_neighborhood_analytics"),
        stored("cultural_neighborhood_analytics"),
        fold_names=fold_names,
        aliases=aliases,
    )
    write(marts.stamped(integrated), "integrated_analytics")
    return written
