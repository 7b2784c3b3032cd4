"""Sketches: exact in small groups, bounded errors in large ones, refreshed without reading the rest."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from citymart.operators import rollups, standardize
from citymart.plans.exploitation import run_exploitation
from citymart.plans.rollups import build_rollups, refresh_rollups
from citymart.sources import schemas, tables
from citymart.sources.schemas import EXPLOITATION
from tests.test_pipelines import formatted, listing, zones  # noqa: F401  (fixtures and a landing record)

SCHEMA = "district string, neighborhood string, property_type string, price_eur double, size_m2 int, price_per_m2 double"
MEDIAN = {"median": ("price_eur", 0.5), "p90": ("price_per_m2", 0.9)}


def listings(spark, n, seed=0, places=(("A", "a1"), ("A", "a2"), ("B", "b1"))):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        price = rng.lognormvariate(12, 1)
        rows.append((*rng.choice(places), rng.choice(["flat", "loft", None]), price, 50, min(price / 50, 19_999.0)))
    return spark.createDataFrame(rows, SCHEMA)


def disc(values, p):
    return sorted(values)[max(1, math.ceil(p * len(values))) - 1]


@pytest.mark.parametrize("keys", [[], ["district"], ["district", "neighborhood"], ["district", "property_type"]])
def test_merged_figures_of_small_groups_are_exact(spark, keys):
    df = listings(spark, 300)
    found = rollups.price_figures(rollups.merge_prices(rollups.price_sketches(df), keys), keys, MEDIAN)
    groups = {}
    for r in df.collect():
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    rows = found.collect()
    assert len(rows) == len(groups)
    for r in rows:
        members = groups[tuple(r[k] for k in keys)]
        assert r["listings"] == len(members)
        assert r["median"] == disc([m["price_eur"] for m in members], 0.5)
        assert r["p90"] == disc([m["price_per_m2"] for m in members], 0.9)
        assert r["avg_price_eur"] == pytest.approx(sum(m["price_eur"] for m in members) / len(members))


@pytest.mark.parametrize("k, error", [(200, 0.04), (4096, 0.004)])
def test_rank_error_of_a_large_group(spark, k, error):
    n = 200_000
    values = spark.range(n, numPartitions=16).select(
        F.lit("A").alias("district"),
        F.concat(F.lit("n"), (F.col("id") % 50).cast("string")).alias("neighborhood"),
        F.lit("flat").alias("property_type"),
        (F.pmod(F.xxhash64("id"), F.lit(n)) + 1).cast("double").alias("price_eur"),
        F.lit(10).alias("size_m2"),
        F.lit(1.0).alias("price_per_m2"),
    )
    wanted = {f"q{p}": ("price_eur", p / 100) for p in (1, 25, 50, 75, 99)}
    merged = rollups.merge_prices(rollups.price_sketches(values, k), ["district"], k)
    assert merged.select(F.length("price_eur_sketch")).first()[0] < 64 * k  # bytes, whatever the rows
    row = rollups.price_figures(merged, ["district"], wanted).first()
    below = {c: F.count_if(F.col("price_eur") <= row[c]).alias(c) for c in wanted}
    ranks = values.agg(*below.values()).first()
    assert all(abs(ranks[c] / n - p) <= error for c, (_, p) in wanted.items())


def test_distinct_counts(spark):
    rows = [(i, f"s{i}", "A" if i % 3 else "B", f"n{i % 4}" if i % 4 else None, f"c{i % 7}", None) for i in range(200)]
    rows += [(None, "x", "A", "n1", "dropped", "y"), (1, None, "A", "n1", "dropped", "y")]
    sites = spark.createDataFrame(
        rows, "site_id int, facility_name string, district string, neighborhood string, category string, facility_type string"
    )
    sketches = rollups.site_sketches(sites)
    by = {r["district"]: r for r in rollups.site_figures(rollups.merge_sites(sketches, ["district"]), ["district"]).collect()}
    assert (by["A"]["sites"], by["A"]["unique_category"], by["A"]["unique_facility_type"]) == (133, 7, 0)
    city = rollups.site_figures(rollups.merge_sites(sketches, []), []).first()
    assert tuple(city) == (200, 7, 0)


def test_distinct_error_of_a_large_group(spark):
    sites = spark.range(400_000, numPartitions=8).select(
        F.col("id").alias("site_id"), F.lit("x").alias("facility_name"), F.lit("A").alias("district"),
        (F.col("id") % 9).cast("string").alias("neighborhood"), (F.col("id") % 100_000).cast("string").alias("category"),
        F.lit("t").alias("facility_type"),
    )
    row = rollups.site_figures(rollups.merge_sites(rollups.site_sketches(sites), []), []).first()
    assert abs(row["unique_category"] / 100_000 - 1) < 0.03 and row["unique_facility_type"] == 1


def test_infinities_nan_and_empty(spark):
    odd = [("A", "a", "t", v, 1, 5.0) for v in (1.0, float("inf"), float("nan"), 7.0, 3.0)]
    df = spark.createDataFrame(odd + [("A", "a", "t", None, 1, 5.0)], SCHEMA)
    figures = rollups.price_figures(rollups.price_sketches(df), ["district"], {"m": ("price_eur", 0.5), "top": ("price_eur", 1.0)})
    assert [(r["m"], r["top"]) for r in figures.collect()] == [(7.0, float("inf"))]
    empty = rollups.price_sketches(df.limit(0))
    assert empty.collect() == [] and rollups.merge_prices(empty, ["district"]).collect() == []
    city = rollups.price_figures(rollups.merge_prices(empty, []), [], MEDIAN).collect()
    assert [(r["listings"], r["median"]) for r in city] == [(None, None)]


def test_refresh_reads_only_what_changed(spark, tmp_path):
    df, path = listings(spark, 200), str(tmp_path / "listings")
    before = rollups.price_sketches(df).cache()
    changed = df.withColumn("price_eur", F.when(F.col("neighborhood") == "a1", F.col("price_eur") * 3).otherwise(F.col("price_eur")))
    tables.write_table(changed.filter("neighborhood != 'b1'"), path, ["district"])
    source = tables.read_table(spark, path)
    new = rollups.refreshed(before, source, [("A", "a1")], rollups.price_sketches)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(district" in plan or "(district#" in plan.split("PartitionFilters:")[1][:120]
    figures = {tuple(r)[:3]: tuple(r)[3:] for r in rollups.price_figures(new, ["district", "neighborhood", "property_type"], MEDIAN).collect()}
    want = rollups.price_figures(rollups.price_sketches(changed), ["district", "neighborhood", "property_type"], MEDIAN)
    assert figures == {tuple(r)[:3]: tuple(r)[3:] for r in want.collect()}
    gone = rollups.refreshed(before, source, [("B", "b1")], rollups.price_sketches)
    assert gone.filter("neighborhood = 'b1'").count() == 0 and gone.count() == before.filter("neighborhood != 'b1'").count()
    assert rollups.refreshed(before, source, [], rollups.price_sketches) is before


def test_rollups_of_the_zones(spark, tmp_path):
    zone, out = str(tmp_path / "f"), str(tmp_path / "e")

    def store(*prices):
        raw = [(json.dumps(listing(str(i), *"AaBb"[2 * i : 2 * i + 2], price, 10.0)),) for i, price in enumerate(prices)]
        landed = spark.createDataFrame(raw, "v string").select(F.from_json("v", schemas.LISTINGS_LANDING).alias("r"))
        tables.write_mart(standardize.format_listings(landed.select("r.*")), zone, "idealista")

    tables.write_mart(spark.createDataFrame([], schemas.FORMATTED["cultural_sites"]), zone, "cultural_sites")
    store(100.0, 50.0)
    build_rollups(spark, zone, out)
    store(300.0, 999.0)
    refresh_rollups(spark, zone, out, [("A", "a")])
    stored = tables.read_table(spark, f"{out}/price_sketches")
    got = {r["district"]: r["median"] for r in rollups.price_figures(stored, ["district"], MEDIAN).collect()}
    assert got == {"A": 300.0, "B": 50.0}  # only the neighbourhood named was read again
    assert tables.read_table(spark, f"{out}/site_sketches").count() == 0


def test_marts_from_sketches_equal_those_from_rows(spark, zones, formatted, tmp_path):  # noqa: F811
    """A whole run either way; the tables differ in nothing but the time of the run."""
    found = []
    for name, from_sketches in (("rows", False), ("sketches", True)):
        zone = str(tmp_path / name)
        status = run_exploitation(spark, zones["formatted"], zone, from_sketches=from_sketches)
        assert {r["status"] for r in status.collect()} == {"success"}
        marts = {n: tables.read_mart(spark, zone, n).drop("created_at") for n in EXPLOITATION}
        by_type = marts["property_type_analytics"]  # its means are not rounded in the mart
        marts["property_type_analytics"] = by_type.withColumn("avg_price_per_m2_by_type", F.round("avg_price_per_m2_by_type", 6))
        found.append({n: (df.dtypes, sorted(map(str, df.collect()))) for n, df in marts.items()})
    assert found[0] == found[1]
    assert tables.read_table(spark, f"{tmp_path}/sketches/price_sketches").count() > 0


def test_one_listing_has_no_deviation(spark):
    places, kinds = rollups.property_marts(rollups.price_sketches(listings(spark, 1)))
    assert [(r["total_properties"], r["price_per_m2_stddev"], r["avg_rooms"]) for r in places.collect()] == [(1, None, None)] * 2
    assert kinds.count() == 1
