"""Operators on small literal tables: NULLs, empty input, ties, single rows."""

import math
import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymart.functions import columns as C
from citymart.functions.schema import columns_by_class, common_type, type_counts
from citymart.operators import kpi, marts, profile, quantiles, regress, standardize, validate
from citymart.operators.latest import latest_per_key

calm = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(spark, column, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


# ------------------------------------------------------------------- columns


def test_income_band_edges(spark):
    data = [(70.0,), (70.01,), (85.0,), (100.0,), (120.0,), (120.01,), (None,)]
    assert values(spark, C.income_band(F.col("v")), data, "v double") == [
        "Q1_Lowest", "Q2_Low", "Q2_Low", "Q3_Medium", "Q4_High", "Q5_Highest", None,
    ]


def test_market_edges(spark):
    data = [(50,), (51,), (100,), (101,)]
    assert values(spark, C.market_accessibility(F.col("v")), data, "v int") == ["Low", "Medium", "Medium", "High"]


def test_band_rejects_bad_cuts():
    with pytest.raises(ValueError):
        C.band(F.lit(1), (2, 1), ("a", "b", "c"))
    with pytest.raises(ValueError):
        C.band(F.lit(1), (1, 2), ("a", "b"))


def test_ratios_survive_zero(spark):
    row = spark.range(1).select(
        C.variation_pct(F.lit(1.0), F.lit(0.0)),
        C.per_thousand(F.lit(3), F.lit(0.0)),
        C.per_thousand_or_zero(F.lit(3), F.lit(0.0)),
        C.per_thousand_or_zero(F.lit(3), F.lit(None).cast("double")),
        C.affordability(F.lit(1.0), F.lit(0.0)),
        C.attractiveness(F.lit(100.0), F.lit(None).cast("double"), F.lit(1000.0)),
        C.attractiveness(F.lit(100.0), F.lit(2.0), F.lit(1000.0)),
    ).first()
    assert tuple(row) == (None, None, 0.0, 0.0, None, None, 76.0)


def test_clean_number(spark):
    data = [("-",), ("",), (None,), ("12",), ("-5",), ("x",), (" 7",), ("3.0",)]
    assert values(spark, C.clean_number(F.col("v"), "int"), data, "v string") == [None, None, None, 12, -5, None, 7, 3]


def test_numeric_text(spark):
    df = spark.createDataFrame([(None,), ("bj",), ("en",), ("3",), ("03",), ("-1",)], "floor string")
    filled = standardize.fill_missing(df, {"floor": 0})
    assert rows(standardize.numeric_text(filled, "floor")) == [(0,), (3,), (3,)]


def test_clip_and_fold(spark):
    row = spark.range(1).select(C.clip_text(F.lit("x" * 30)), C.matching_key(F.lit("  El Raval "))).first()
    assert tuple(row) == ("x" * 20 + "...", "el raval")


# ----------------------------------------------------------------- quantiles


def disc(data, p):
    ordered = sorted(data, key=lambda v: (v != v, v))  # NaN last, as Spark sorts
    return ordered[max(1, math.ceil(p * len(ordered))) - 1] if ordered else None


def check_quantiles(spark, data, **options):
    df = spark.createDataFrame(data, "k string, j int, v double, w int")
    outputs = {"v_mid": ("v", 0.5), "v_low": ("v", 0.1), "w_high": ("w", 0.75)}
    by_k, by_kj = quantiles.group_quantiles(df, [["k"], ["k", "j"]], outputs, **options)
    for frame, width in ((by_k, 1), (by_kj, 2)):
        groups = {}
        for row in data:
            groups.setdefault(row[:width], []).append(row)
        want = []
        for key, members in groups.items():
            v = [m[2] for m in members if m[2] is not None]
            w = [m[3] for m in members if m[3] is not None]
            found = (disc(v, 0.5), disc(v, 0.1), disc(w, 0.75))
            if any(x is not None for x in found):
                want.append((*key, *found))
        plain = lambda r: repr(tuple(x + 0.0 if isinstance(x, (int, float)) else x for x in r))
        assert sorted(map(plain, rows(frame))) == sorted(map(plain, want))


def test_quantiles_against_sorting(spark):
    data = [("a", i % 3, float((i * 7919) % 1000) / 7 - 50, i % 11) for i in range(500)]
    data += [("b", 0, 5.0, 1)] * 4 + [("c", 1, -0.0, -3), ("d", 2, None, None), (None, None, 1e300, 7)]
    data += [("e", 0, v, 0) for v in (1.0, 2.0, 3.0, 4.0, float("nan"), float("inf"), 5e-324, -1e-300, 0.0)]
    nan, inf = float("nan"), float("inf")
    data += [("inf", 0, v, 0) for v in (1.0, 2.0, inf, inf, inf)] + [("nan", 0, v, 0) for v in (100.0, nan, nan)]
    data += [("low", 0, v, 0) for v in (-inf, -inf, 5.0)] + [("all", 1, v, 0) for v in (nan, inf, -inf, 0.0)]
    check_quantiles(spark, data)


@pytest.mark.parametrize("refinements", [0, 1, 2])
def test_quantiles_with_refinement(spark, monkeypatch, refinements):
    """A hot group whose values nearly coincide: each refinement is one more scan that splits buckets."""
    data = [("hot", 0, 1000.0 + i * 1e-7, 5) for i in range(400)] + [("hot", 1, 1000.0, 5)] * 200
    data += [("cold", 0, -3.0, 2), ("cold", 0, -2.0, 9)]
    scans = []
    real = quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda df, name: scans.append(name) or real(df, name))
    check_quantiles(spark, data, refinements=refinements)
    assert len(scans) == 1 + refinements


@calm
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.integers(0, 1),
            st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
            st.one_of(st.none(), st.integers(-5, 5)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_quantiles_property(spark, data):
    check_quantiles(spark, data)


def test_quantiles_of_awkwardly_named_columns(spark):
    df = spark.createDataFrame([("a", "b", 1, 2.0), ("a", "b", 1, 3.0)], "value string, measure string, n int, bucket double")
    [found] = quantiles.group_quantiles(df, [["value", "measure", "n"]], {"rank": ("bucket", 0.5)})
    assert found.columns == ["value", "measure", "n", "rank"]
    assert rows(found) == [("a", "b", 1, 2.0)]


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)], "v double")
    outputs = {f"p{p}": ("v", p / 100) for p in (25, 50, 75)}
    [found] = quantiles.group_quantiles(df.withColumn("k", F.lit(1)), [["k"]], outputs, rule="nearest")
    # Ranks 0.75, 1.5 and 2.25 of 0..3 round to 1, 2 and 2.
    assert rows(found) == [(1, 2.0, 3.0, 3.0)]


def test_approximate_quantiles_agree_on_small_groups(spark):
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(101)], "k int, v double")
    nonfinite = [(2, v) for v in (1.0, float("inf"), float("nan"))] + [(3, v) for v in (float("nan"), -float("inf"))]
    df = df.union(spark.createDataFrame(nonfinite, df.schema))
    size, outputs = [F.count("*").alias("n")], {"m": ("v", 0.5)}
    exact, sketch = (quantiles.group_stats(df, ["k"], size, outputs, exact) for exact in (True, False))
    assert repr(rows(exact)) == repr(rows(sketch)) and len(rows(exact)) == 4


# -------------------------------------------------------------------- latest


def test_latest_keeps_ties_and_drops_unknown_years(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "u"), ("c", 1, "v"), (None, 5, "w")],
        "k string, year int, p string",
    )
    want = [("a", 2, "y", 2), ("a", 2, "z", 2), ("c", 1, "v", 1)]
    assert rows(latest_per_key(df, ["k"], "year")) == want
    assert rows(latest_per_key(df, ["k"], "year", staged=True)) == want


def test_latest_with_basis_brings_back_all_rows_of_that_year(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 1, None), ("a", 2, None), ("b", 1, None)], "k string, year int, x double"
    )
    assert rows(latest_per_key(df, ["k"], "year", F.col("x").isNotNull())) == [("a", 1, 5.0, 1), ("a", 1, None, 1)]


# --------------------------------------------------------------------- marts

LISTING = "district string, neighborhood string, property_type string, price_eur double, price_per_m2 double, size_m2 int, rooms int"


def test_outlier_cut(spark):
    prices = [19999.99, 20000.0, 20001.0, 0.0, -1.0, None]
    df = spark.createDataFrame([("d", "n", "t", 1.0, p, 1, 1) for p in prices], LISTING)
    assert [r["price_per_m2"] for r in marts.valid_prices(df).collect()] == [19999.99]
    bad = [(None, "n", "t", 1.0, 1.0, 1, 1), ("d", None, "t", 1.0, 1.0, 1, 1), ("d", "n", "t", 1.0, 1.0, 0, 1)]
    assert marts.valid_prices(spark.createDataFrame(bad, LISTING)).count() == 0


def test_property_levels_and_single_row_group(spark):
    data = [("d", "n", "t", float(p), float(p), 10, 2) for p in (1, 2, 3, 4)] + [("d", "m", None, 9.0, 9.0, 11, 3)]
    df = spark.createDataFrame(data, LISTING)
    got = {(r["analysis_level"], r["neighborhood"]): r for r in marts.property_analytics(df).collect()}
    assert got[("neighborhood", "n")]["median_price_eur"] == 2.0  # lower median
    assert got[("district", None)]["median_price_eur"] == 3.0
    assert got[("district", None)]["total_properties"] == 5
    assert got[("neighborhood", "m")]["price_per_m2_stddev"] is None
    assert rows(marts.property_type_analytics(df)) == [("d", "t", 4, 2.5, 2.0), ("d", None, 1, 9.0, 9.0)]
    assert rows(marts.property_analytics(df, exact=False)) == rows(marts.property_analytics(df))
    empty = marts.property_analytics(df.filter("false"))
    assert empty.count() == 0


@calm
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(1, 30_000)), min_size=1, max_size=30
    )
)
def test_district_rolls_up_neighborhoods(spark, data):
    df = spark.createDataFrame([(d, n, "t", float(p), float(p), 1, 1) for d, n, p in data], LISTING)
    got = marts.property_analytics(df).collect()
    for top in [r for r in got if r["analysis_level"] == "district"]:
        parts = [r for r in got if r["analysis_level"] == "neighborhood" and r["district"] == top["district"]]
        assert top["total_properties"] == sum(r["total_properties"] for r in parts)
        assert top["min_price_per_m2"] == min(r["min_price_per_m2"] for r in parts)
        assert top["max_price_per_m2"] == max(r["max_price_per_m2"] for r in parts)
        members = [p for d, _, p in data if d == top["district"] and p < 20_000]
        assert top["median_price_eur"] == statistics.median_low(members)


INCOME = "year int, district_code int, district_name string, neighborhood_code int, neighborhood_name string, population double, income_index_bcn_100 double"
SITE = "site_id string, facility_name string, district string, neighborhood string, category string, facility_type string"


def test_population_basis_is_looser_than_income(spark):
    income = spark.createDataFrame(
        [(2016, 1, "d", 1, "n", 10.0, 5.0), (2017, 1, "d", 1, "n", 20.0, -1.0), (2018, 1, "d", 1, "n", 30.0, None)],
        INCOME,
    )
    assert rows(marts.latest_population(income)) == [("d", "n", 20.0)]
    assert [r["year"] for r in marts.latest_income(income).collect()] == [2016]


def test_cultural_counts_ignore_unknown_categories(spark):
    sites = spark.createDataFrame(
        [("1", "a", "d", "n", "x", "u"), ("2", "b", "d", "n", None, "u"), ("3", None, "d", "n", "y", "v"), ("4", "c", "d", None, "x", "w")],
        SITE,
    )
    income = spark.createDataFrame([], INCOME)
    assert rows(marts.cultural_district(sites, income)) == [("d", "district", 3, 1, 2, None, None)]
    assert rows(marts.cultural_neighborhood(sites, income)) == [
        ("d", "n", "neighborhood", 2, 1, 1, None, 0.0),
        ("d", None, "neighborhood", 1, 1, 1, None, 0.0),
    ]
    assert rows(marts.cultural_category(sites)) == [("d", "x", 2)]


def test_names_match_exactly_unless_folded(spark):
    prop = marts.property_analytics(spark.createDataFrame([("D", "La Font", "t", 1.0, 1.0, 1, 1)], LISTING))
    income = spark.createDataFrame([(2017, 1, "D", 1, "la Font", 5.0, 90.0)], INCOME)
    sites = spark.createDataFrame([("1", "a", "D", "la font ", "x", "u")], SITE)
    inputs = (
        prop,
        marts.socioeconomic_neighborhood(income),
        marts.cultural_neighborhood(sites, income),
    )
    assert marts.integrated_analytics(*inputs).count() == 0
    aliases = spark.createDataFrame([(" LA font", "the fountain"), ("other", "x")], "alias string, name string")
    assert marts.integrated_analytics(*inputs, aliases=aliases).count() == 1
    named = marts.with_canonical_names(spark.createDataFrame([("La Font",), (None,), ("z",)], "n string"), "n", aliases)
    assert sorted(rows(named), key=repr) == [("the fountain",), ("z",), (None,)]
    [folded] = marts.integrated_analytics(*inputs, fold_names=True).collect()
    assert (folded["neighborhood"], folded["total_cultural_sites"], folded["income_quintile"]) == ("La Font", 1, "Q3_Medium")


# ------------------------------------------------------------------ profiling


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert rows(profile.null_profile(empty)) == [("a", 0, 0.0), ("b", 0, 0.0)]
    assert rows(profile.quality_metrics(empty)) == [(0, 2, 0, 0.0, 0, 0.0)]
    assert rows(profile.duplicate_profile(empty)) == [(0, 0, 0, 0.0)]
    assert rows(profile.null_totals(empty)) == [(0, 2, 0, 0.0)]


@pytest.mark.parametrize("exact", [True, False])
def test_duplicates_with_nulls_maps_and_hot_rows(spark, exact):
    data = [(1, None, {"a": 1, "b": 2}), (1, None, {"b": 2, "a": 1}), (1, "x", {}), (2, None, None)]
    df = spark.createDataFrame(data + [(7, "hot", {})] * 100, "i int, s string, m map<string,int>")
    assert rows(profile.duplicate_profile(df, exact=exact)) == [(104, 4, 100, 100 / 104 * 100)]
    assert rows(profile.duplicate_profile(df, ["i"], exact)) == [(104, 3, 101, 101 / 104 * 100)]
    metrics = profile.quality_metrics(df, exact).first()
    assert (metrics["total_missing"], metrics["duplicate_count"], metrics["total_columns"]) == (4, 100, 3)


@pytest.mark.parametrize("exact", [True, False])
def test_place_of_a_null_matters(spark, exact):
    data = [("a", None, [None, 1]), (None, "a", [None, 1]), ("a", None, [1, None]), ("a", "", [1]), ("a", None, [1])]
    df = spark.createDataFrame(data, "s string, t string, a array<int>")
    assert profile.duplicate_profile(df, exact=exact).first()["unique_rows"] == 5


words = st.sampled_from(["a", "", None])


@pytest.mark.parametrize("exact", [True, False])
@calm
@given(data=st.lists(st.tuples(words, st.integers(0, 1) | st.none(), words), min_size=1, max_size=40))
def test_unique_and_duplicate_rows_add_up(spark, exact, data):
    got = profile.duplicate_profile(spark.createDataFrame(data, "s string, i int, t string"), exact=exact).first()
    assert got["unique_rows"] == len(set(data))
    assert got["unique_rows"] + got["duplicate_count"] == got["total_rows"] == len(data)


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, `c d=` string")
    assert rows(profile.null_profile(df)) == [("a.b", 0, 0.0), ("c d=", 1, 50.0)]
    assert profile.missing_matrix(df, order_by=["`a.b`"]).columns == ["a.b", "c d="]
    assert rows(profile.missing_top(df)) == [("c d=", 1, 50.0)]


def test_histogram(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(101)] + [(None, None)], "v double, c double")
    got = profile.histogram(df, bins=10)
    by_column = {name: sorted(tuple(r)[1:] for r in got.collect() if r["column_name"] == name) for name in "vc"}
    assert [r[3] for r in by_column["v"]] == [10] * 9 + [11]
    assert by_column["v"][0][1:3] == (0.0, 10.0)
    assert by_column["c"] == [(0, 5.0, 5.0, 101)]


def test_histogram_counts_by_one_number(spark):
    """Names and limits are put to the counted rows, not to every value."""
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(0.0, 1), (10.0, 1), (inf, 1), (nan, None), (None, 1)], "`a.b` double, n int")
    got = profile.histogram(df, bins=2)
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("a.b", 0, 0.0, 5.0, 1),
        ("a.b", 1, 5.0, 10.0, 1),
        ("a.b", None, None, None, 2),
        ("n", 0, 1.0, 1.0, 4),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[cell#\d+\]", plan)


def test_correlation(spark):
    df = spark.createDataFrame([(1, 2.0, 5, None), (2, 1.0, 5, 3), (3, None, 5, 9), (4, 3.0, 5, 1)], "a int, b double, c int, d int")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df).collect()}
    assert len(got) == 16
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(0.6546536707)
    assert got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "c")] is None  # a constant has no correlation
    with pytest.raises(ValueError):
        profile.correlation_matrix(df.select("a"))


def test_describe(spark):
    df = spark.createDataFrame([(1, "b", True), (2, None, False), (3, "a", None), (None, "c", None)], "n int, s string, f boolean")
    got = {r["column_name"]: r for r in profile.describe(df).collect()}
    n = got["n"]
    assert (n["count"], n["null_count"], n["mean"], n["std"], n["min"], n["p50"], n["max"]) == (3, 1, 2.0, 1.0, 1.0, 2.0, 3.0)
    assert (got["s"]["min_text"], got["s"]["max_text"], got["s"]["p50"]) == ("a", "c", None)
    assert (got["f"]["count"], got["f"]["null_count"]) == (2, 2)
    assert profile.describe(df.select("s")).columns == profile.describe(df).columns


@pytest.mark.parametrize("n", [5, 300, 5000])
def test_sample_matches_a_full_sort(spark, n):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")))
    full = df.orderBy(F.md5(F.concat_ws("|", F.lit("42"), "k")), "k").limit(n).select("k")
    got = profile.sample_rows(df, n, ["k"])
    assert got.count() == min(n, 1000)
    assert rows(got.select("k")) == rows(full)


def test_previews(spark):
    df = spark.createDataFrame([("y" * 25, i, *[0] * 8) for i in range(5)], "s string, i int, " + ", ".join(f"c{j} int" for j in range(8)))
    assert profile.preview(df, 2).count() == 2
    clipped = profile.clipped_preview(df)
    assert (clipped.count(), len(clipped.columns), clipped.first()["s"]) == (3, 8, "y" * 20 + "...")


def test_scores_insights_and_bands(spark):
    metrics = spark.createDataFrame([(50, 2, 30, 30.0, 40, 80.0)], profile.quality_metrics(spark.range(1)).schema)
    assert rows(profile.quality_scores(metrics)) == [(0.0, 70.0, 20.0, 45.0)]
    assert [r["rule"] for r in profile.insights(metrics, 0).collect()] == [
        "high_missing_rate", "significant_duplicates", "no_numeric_columns", "small_dataset",
    ]
    fine = spark.createDataFrame([(100, 2, 0, 10.0, 0, 5.0)], metrics.schema)
    assert profile.insights(fine, 1).count() == 0
    banded = spark.createDataFrame([(90.0,), (60.0,), (30.0,), (0.0,)], "s double").select(profile.quality_bands(F.col("s")).alias("b")).select("b.*")
    assert [tuple(r) for r in banded.collect()] == [(10.0, 40.0, 0.0), (0.0, 10.0, 0.0), (0.0, 30.0, 20.0), (0.0, 0.0, 50.0)]


def test_type_classes(spark):
    df = spark.createDataFrame([], "i int, d decimal(5,2), s string, t timestamp_ntz, b boolean, a array<int>, x float")
    assert columns_by_class(df) == {"numeric": ["i", "x"], "categorical": ["s"], "date": ["t"], "other": ["d", "b", "a"]}
    assert rows(type_counts(df)) == [("categorical", 1), ("date", 1), ("numeric", 2), ("other", 3)]


def test_common_type():
    i, l, d, s, b = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
    assert common_type([i, i]) == i
    assert common_type([i, l]) == l
    assert common_type([i, d, b]) == d
    assert common_type([i, b]) == i
    assert common_type([l, s]) == s
    assert common_type([T.NullType(), i]) == i
    assert common_type([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert common_type([T.DateType(), i]) == s


# ----------------------------------------------------------------- indicators


def test_spatial_equity_and_digest(spark):
    schema = "district string, neighborhood string, median_price_eur double, income_index_bcn_100 double, avg_price_eur double, avg_price_per_m2 double, income_quintile string, total_cultural_sites bigint, cultural_sites_per_1000_residents double"
    df = spark.createDataFrame(
        [("d", "a", 1.0, 80.0, 1.0, 1.0, "Q2_Low", 3, 1.0), ("d", "b", 1.0, 80.0, 2.0, 2.0, "Q2_Low", None, None), ("d", "c", None, 90.0, 3.0, 3.0, "Q3_Medium", 1, 3.0)],
        schema,
    )
    assert rows(kpi.spatial_equity(df)) == [("Q2_Low", 2, 3, 1.0, 75.0), ("Q3_Medium", 1, 1, 3.0, 25.0)]
    assert rows(kpi.kpi_digest(integrated=df)) == [
        ("integration_quality", "complete_records", 2.0),
        ("integration_quality", "completeness_percentage", 2 / 3 * 100),
        ("integration_quality", "total_records", 3.0),
    ]
    assert kpi.cultural_economic_correlation(df).first()["corr_culture_income"] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        kpi.kpi_digest()


# ----------------------------------------------------------------- validation


def status_rows(spark, data):
    return spark.createDataFrame(
        [(z, d, s, n, 1 if n is not None else None, None, None, "", None) for z, d, s, n in data], validate.STATUS_SCHEMA
    )


def test_score_and_recommendations(spark):
    status = status_rows(spark, [("f", "a", "success", 10), ("f", "b", "error", None), ("e", "c", "success", 0)])
    checks = spark.createDataFrame(
        [
            ("f", "a", "duplicate_percentage", 60.0, None),
            ("f", "c", "duplicate_percentage", 0.0, None),
            ("f", "a", "negative_prices", 2.0, None),
        ],
        validate.CHECK_SCHEMA,
    )
    score = validate.quality_score(status, checks)
    assert rows(score) == [(70.0, 66.67, 3, 2, 1)]
    messages = [r["message"] for r in validate.recommendations(score, checks).collect()]
    assert sorted(messages) == [
        "⚠️ 1 datasets failed to load. Check data paths and file formats.",
        "⚠️ Data quality score is 70.0%. Review data cleaning processes.",
        "⚠️ Found 2 records with invalid prices in a. Review price validation rules.",
        "⚠️ High duplicate rate in a (60.0%). Consider deduplication.",
    ]
    assert rows(validate.zone_summary(status)) == [("e", 1, 1, 0, 100.0), ("f", 2, 1, 10, 50.0)]


def test_healthy_run(spark):
    status = status_rows(spark, [("f", "a", "success", 10)])
    checks = spark.createDataFrame([("f", "a", "duplicate_percentage", 0.0, None)], validate.CHECK_SCHEMA)
    got = validate.recommendations(validate.quality_score(status, checks), checks).collect()
    assert [r["rule"] for r in got] == ["healthy"]


def test_nothing_checked_scores_zero(spark):
    score = validate.quality_score(status_rows(spark, [("f", "a", "error", None)]), spark.createDataFrame([], validate.CHECK_SCHEMA))
    assert rows(score) == [(0.0, 0.0, 1, 0, 1)]


def test_required_mart_outcomes(spark):
    status = status_rows(spark, [("e", "a", "success", 1), ("e", "b", "success", 0), ("e", "c", "error", None)])
    gate = validate.required_mart_gate(status, ["a", "b", "c", "d"])
    assert {r["dataset"]: r["gate"] for r in gate.collect()} == {"a": "PASS", "b": "FAIL", "c": "ERROR", "d": "MISSING"}
    validate.assert_gate(gate.filter("dataset = 'c'"), fail_on=["FAIL"])


def test_row_count_gate_outcomes(spark):
    status = status_rows(spark, [("f", "a", "success", 5), ("f", "b", "success", 4), ("f", "c", "error", None), ("f", "e", "success", 0)])
    gate = validate.row_count_gate(status, {"a": 5, "b": 5, "c": 5, "d": 5})
    assert {r["dataset"]: r["gate"] for r in gate.collect()} == {
        "a": "PASS", "b": "FAIL", "c": "ERROR", "d": "MISSING", "e": "PASS"
    }
    with pytest.raises(validate.GateError, match="b, c, d"):
        validate.assert_gate(gate)


def test_last_year_of_the_rules_is_a_parameter(spark):
    income = spark.createDataFrame([(1.0, 2025), (1.0, 2026)], "income_index_bcn_100 double, year int")
    found = {r["check"]: r["value"] for r in validate.quality_checks(income, "f", "income").collect()}
    assert found == {"duplicate_count": 0.0, "duplicate_percentage": 0.0, "negative_income": 0.0, "future_years": 1.0}
    later = validate.quality_checks(income, "f", "income", validate.rules(2026)["income"], exact=True)
    assert {r["check"]: r["value"] for r in later.collect()}["future_years"] == 0.0


def test_failed_check_keeps_its_error(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/idealista")
    status = validate.validate_zone(spark, "f", str(tmp_path), ["idealista", "income"])
    [missing] = status.filter("status = 'error'").collect()
    assert "income" in missing["error"]
    [row] = validate.check_zone(spark, status).collect()  # the rules name columns that are not there
    assert row["check"] == "error" and row["value"] is None and "price_eur" in row["error"]


def test_dedup_latest(spark):
    from citymart.operators.latest import dedup_latest

    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("a", 2, "z"), (None, 1, "n"), (None, None, "m"), ("b", None, None)]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(dedup_latest(df, ["k"], ["t"])) == [("a", 2, "z"), ("b", None, None), (None, 1, "n")]
    assert dedup_latest(df.limit(0), ["k"], ["t"]).collect() == []


def test_rule_counts_skip_nulls(spark):
    df = spark.createDataFrame([(0.0, 1), (-1.0, 0), (None, None), (5.0, 2)], "price_eur double, size_m2 int")
    assert rows(validate.rule_violations(df, validate.RULES["idealista"])) == [("negative_prices", 2.0), ("zero_sizes", 1.0)]


# ------------------------------------------------------------------- learning


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).withColumn("x", F.col("id") * 2)
    train, rest = regress.split(df, ["id"])
    again, _ = regress.split(df.repartition(7), ["id"])
    assert rows(train) == rows(again)
    assert train.count() + rest.count() == 2000
    assert 0.75 < train.count() / 2000 < 0.85
    assert train.join(rest, "id").count() == 0


def test_unseen_categories_are_skipped(spark):
    data = [(str(i), "n1" if i < 60 else f"rare{i}", "flat", "good", float(i), 1000.0 * i) for i in range(80)]
    df = spark.createDataFrame(data, "key string, neighborhood string, property_type string, status string, size_m2 double, price double")
    ranking, fitted = regress.train(df, ["key"], regress.regressors(trees=3))
    assert ranking.count() == 2
    best = regress.best_model(ranking)
    assert best == ranking.first()["model"]
    assert fitted[best].transform(df.withColumn("neighborhood", F.lit("never seen"))).count() == 0


def listing_rows(spark, n=600, names=200):
    data = [
        (str(i), f"n{i % names}", "flat", "good", float(i * 37 % 101), 1000.0 * (i * 37 % 101) + 50 * (i % names)) for i in range(n)
    ]
    return spark.createDataFrame(
        data, "key string, neighborhood string, property_type string, status string, size_m2 double, price double"
    )


def test_a_forest_takes_any_number_of_labels(spark):
    ranking, _ = regress.train(listing_rows(spark), ["key"], regress.regressors(trees=2), partitions=4)
    assert {r["model"] for r in ranking.collect()} == {"LinearRegression", "RandomForestRegressor"}


def test_models_do_not_follow_the_partitions_of_their_input(spark):
    df = listing_rows(spark, names=20)
    found = []
    for parts in (1, 2, 8):
        ranking, _ = regress.train(df.repartition(parts), ["key"], regress.regressors(trees=5), partitions=4)
        found.append({r["model"]: round(r["rmse"], 6) for r in ranking.collect()})
    assert found[0] == found[1] == found[2]


def test_shipped_aliases_let_names_meet(spark):
    df = spark.createDataFrame([("El Poble Sec - Parc de Montjuïc",), ("la Font de la Guatlla",)], "n string")
    named = marts.with_canonical_names(df, "n", marts.known_aliases(spark))
    assert rows(named) == [("el Poble Sec",), ("la Font de la Guatlla",)]
