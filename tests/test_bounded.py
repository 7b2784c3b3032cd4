"""Duplicates by fingerprint and value, heavy values, correlations by blocks: against plain versions."""

import math
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citymart.operators import duplicates, gram, heavy, profile, validate

calm = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

ROWS = [("a", 1.0, [1], None), ("a", 1.0, [1], None), ("a", 1.0, [1, None], None), (None, None, None, "z")] * 2
ROWS += [("nan", float("nan"), [], "x"), ("nan", float("nan"), [], "x"), ("zero", 0.0, [], ""), ("one", 0.5, [], "")]
SCHEMA = "s string, d double, l array<int>, z string"


def plain(rows):
    kinds = Counter(map(repr, rows))
    return len(rows), len(kinds), len(rows) - len(kinds)


@pytest.mark.parametrize("keys", [None, ["s"], ["s", "l"]])
def test_duplicates_equal_the_plain_ones(spark, keys):
    df = spark.createDataFrame(ROWS, SCHEMA)
    names = keys or df.columns
    places = [df.columns.index(k) for k in names]
    want = plain([tuple(r[p] for p in places) for r in ROWS])
    assert tuple(duplicates.exact_duplicates(df, keys).first())[:3] == want
    assert tuple(profile.duplicate_profile(df, keys).first())[:3] == want


def test_rows_that_share_a_fingerprint_stay_apart(spark, monkeypatch):
    """With a fingerprint of three values nearly all rows share one; the result is the same."""
    real = profile.identity

    def weak(df, keys, exact):
        if exact:
            return real(df, keys, exact)
        return [F.pmod(real(df, keys, exact)[0], F.lit(3)).alias("id_0"), F.lit(0).alias("id_1")]

    monkeypatch.setattr(duplicates, "identity", weak)
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert tuple(duplicates.exact_duplicates(df).first())[:3] == plain(ROWS)
    checks = {r["check"]: r["value"] for r in validate.quality_checks(df, "z", "t", {"small": "d < 1"}, exact=True).collect()}
    assert checks["duplicate_count"] == plain(ROWS)[2] and checks["small"] == 2


def test_only_repeating_rows_are_compared_in_full(spark, monkeypatch):
    seen = []
    real = duplicates.repeating_rows
    monkeypatch.setattr(duplicates, "repeating_rows", lambda *a: seen.append(real(*a)) or seen[-1])
    df = spark.range(1000).select(F.concat(F.lit("wide"), F.col("id")).alias("t")).unionAll(spark.createDataFrame([("x",), ("x",)], "t string"))
    row = duplicates.exact_duplicates(df).first()
    assert (row["total_rows"], row["duplicate_count"]) == (1002, 1) and seen[0].count() == 2


def test_a_hot_kind_and_an_empty_table(spark):
    hot = spark.range(30_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("t"))
    row = duplicates.exact_duplicates(hot).first()
    assert (row["total_rows"], row["unique_rows"]) == (30_000, 20_001)
    assert tuple(duplicates.exact_duplicates(hot.limit(0)).first()) == tuple(profile.duplicate_profile(hot.limit(0)).first())


# -------------------------------------------------------------------- heavy values


def top(values, n):
    counts = Counter(values)
    return sorted(counts.items(), key=lambda i: (-i[1], i[0] is not None, i[0]))[:n]


def test_heavy_values_of_a_long_tail_need_no_third_scan(spark, monkeypatch):
    rng = random.Random(1)
    values = [f"v{min(int(rng.paretovariate(0.9)), 5000)}" for _ in range(20_000)] + [None] * 700
    df = spark.createDataFrame([(v, 1) for v in values], "bucket string, count int").repartition(4)
    staged = []
    real = heavy.stage
    monkeypatch.setattr(heavy, "stage", lambda d, name: staged.append(name) or real(d, name))
    found = [tuple(r) for r in heavy.heavy_values(df, "bucket", 6, tracked=64, buckets=4096).collect()]
    assert found == top(values, 6) and "open-buckets" not in staged


@pytest.mark.parametrize("tracked, buckets", [(16, 2), (16, 64), (1024, 4)])
def test_heavy_values_that_are_hardly_heavier(spark, tracked, buckets):
    rng = random.Random(2)
    values = [rng.randrange(3000) for _ in range(9000)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    found = [tuple(r) for r in heavy.heavy_values(df, "v", 9, tracked, buckets).collect()]
    assert found == top(values, 9)


@calm
@given(st.lists(st.one_of(st.none(), st.integers(0, 12)), max_size=60), st.integers(1, 15))
def test_heavy_values_equal_the_plain_ones(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "`odd``name` int")
    found = [tuple(r) for r in heavy.heavy_values(df, "odd`name", n, tracked=16, buckets=3).collect()]
    assert found == top(values, n) == [tuple(r) for r in profile.top_values(df, "odd`name", n).collect()]


# -------------------------------------------------------------------- correlations


def cells(df):
    return {(r["col_a"], r["col_b"]): r["r"] for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for key, want in b.items():
        got = a[key]
        if want is None or math.isnan(want):
            assert got is want if want is None else math.isnan(got), (key, got, want)
        else:
            assert got == pytest.approx(want, abs=1e-9), key


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_gram_equals_one_aggregate_a_pair(spark, block):
    rng = random.Random(3)
    gap = lambda v: None if rng.random() < 0.2 else v
    rows = []
    for i in range(300):  # the third column does not vary
        x = rng.gauss(1e6, 2)
        rows.append((gap(x), gap(x * 2 + rng.gauss(0, 1)), 7.0, gap(i), None, float("nan") if i == 5 else rng.random(), 1e300 if i else float("inf")))
    df = spark.createDataFrame(rows, "a double, b double, c double, `d.e` int, n double, odd double, inf double").repartition(3)
    varying = df.drop("inf", "c")
    same(cells(gram.gram_correlations(varying, block=block)), cells(profile.correlation_matrix(varying)))
    still = cells(gram.gram_correlations(df.drop("inf", "odd"), block=block))
    assert {r for pair, r in still.items() if "c" in pair} == {None}
    assert math.isnan(cells(gram.gram_correlations(df.select("a", "inf"), block=block))["a", "inf"])


def test_three_hundred_columns_with_gaps(spark):
    base = spark.range(400, numPartitions=4)
    columns = [F.when((F.col("id") + i) % 11 > 0, F.sin(F.col("id") * (i + 1))).alias(f"c{i}") for i in range(300)]
    found = gram.gram_correlations(base.select(*columns))
    assert found.count() == 90_000
    rows = base.select(*columns).select("c7", "c250").collect()
    both = [(r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None]
    mx, my = (sum(v) / len(both) for v in zip(*both))
    want = sum((x - mx) * (y - my) for x, y in both) / math.sqrt(sum((x - mx) ** 2 for x, _ in both) * sum((y - my) ** 2 for _, y in both))
    assert found.filter("col_a = 'c7' and col_b = 'c250'").first()["r"] == pytest.approx(want)


def test_gram_of_empty_and_single_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert set(cells(gram.gram_correlations(df)).values()) == {None}
    assert gram.gram_correlations(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        gram.gram_correlations(df, ["a"])
