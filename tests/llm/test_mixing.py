"""Mixing: Pfair windows, the deviation at every point, and that no row is lost."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citymart.llm import mixing
from citymart.llm.mixing import integer_shares, mix_documents, mixing_positions, schedule

SCHEMA = "doc_id long, text string, source string, slot long, at string"


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text(max_size=3) | st.none(), st.integers(1, 40), min_size=1, max_size=8))
def test_every_block_runs_in_its_window(shares):
    period = sum(shares.values())
    plan = schedule(shares)
    assert Counter(s for s, *_ in plan) == shares and [slot for *_, slot in plan] == list(range(period))
    done = Counter()
    for source, block, release, deadline, slot in plan:
        assert block == done[source] and release <= slot < deadline
        done[source] += 1
        for s, a in shares.items():
            assert abs(done[s] - Fraction(a * (slot + 1), period)) < 1


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 9), st.floats(0.001, 1000), min_size=1, max_size=8), st.integers(10, 500))
def test_shares_add_up(weights, period):
    shares = integer_shares(weights, period)
    assert sum(shares.values()) == period and set(shares) == set(weights) and min(shares.values()) >= 1
    total = sum(weights.values())
    slack = len(weights)
    assert all(abs(shares[s] - period * w / total) <= slack for s, w in weights.items())


def docs(spark, n=600, seed=1):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["a", "b", None]
    rows = [(i, "x" * rng.choice([0, 10, 80, 200]), rng.choice(sources), 1, "k") for i in range(n)]
    rows += [(7000, None, "a", 1, "k"), (None, "no id", "b", 1, "k"), (None, "no id", "b", 1, "k"), (8000, "y" * 20_000, "a", 1, "k")]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("weights", [None, {"hot": 1, "a": 2, "b": 3, None: 2}, {"a": 1, "b": 1}])
def test_sources_keep_their_shares_until_they_run_out(spark, monkeypatch, weights):
    monkeypatch.setattr(mixing, "SLICE_UNITS", 40)
    rows, df = docs(spark)
    places = mixing_positions(df.repartition(5), weights=weights, alpha=0.5, block_chars=500, period=100).collect()
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len(text or "") + 1
    weights = weights or {s: n**0.5 for s, n in sizes.items()}
    shares = integer_shares({s: weights[s] for s in sizes if s in weights}, 100)
    blocks = defaultdict(set)
    for r in places:
        assert r.release <= r.slot < r.deadline
        blocks[r.source].add((r.block, r.slot))
    for source, share in shares.items():
        for block, slot in blocks[source]:
            # blocks before this one, against the source's share of the slots before
            assert abs(block - Fraction(share * slot, 100)) < 1
    ends = [max(slot for _, slot in blocks[s]) for s in shares]
    for source in set(sizes) - set(shares):
        assert min(slot for _, slot in blocks[source]) > max(ends)
    # starts follow the hashed order, each unit after those before it
    for source in sizes:
        units = sorted((r.at, r.id is None, r.id or 0, r.block) for r in places if r.source == source)
        assert [u[3] for u in units] == sorted(u[3] for u in units)


def test_all_rows_stay_in_mixed_order(spark):
    rows, df = docs(spark)
    mixed = mix_documents(df, block_chars=300, period=50)
    assert mixed.columns == df.columns
    found = [tuple(r) for r in mixed.collect()]
    assert Counter(found) == Counter(rows)
    place = {(r.source, r.id): r.slot for r in mixing_positions(df, block_chars=300, period=50).collect()}
    order = [place[r[2], r[0]] for r in found]
    assert order == sorted(order)


def test_same_result_whatever_the_partitions(spark):
    _, df = docs(spark)
    one = mixing_positions(df.repartition(7), block_chars=300).collect()
    two = mixing_positions(df.coalesce(1), block_chars=300).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_empty_table_and_too_many_sources(spark, monkeypatch):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing_positions(empty).collect() == [] and mix_documents(empty).collect() == []
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        mixing_positions(docs(spark, 40)[1])


def test_exact_weights_hold_over_many_periods():
    weights = [n**0.5 for n in (10_000_000_000, *range(1_000_000, 400_000_000, 20_000_000), 3, 1)]
    total = sum(map(Fraction, weights))
    last = 0
    for i, k, release, deadline, slot in mixing.plan_blocks(weights, [60_000, *[900] * (len(weights) - 1)]):
        share = Fraction(weights[i]) / total
        assert release == k / share // 1 and deadline == -(-(k + 1) / share // 1) and release <= slot < deadline
        assert abs(k - share * slot) < 1 and abs(k + 1 - share * (slot + 1)) < 1
        assert slot >= last
        last = slot + 1
    assert last > 200_000


def test_positions_follow_the_weights_themselves(spark):
    weights = {"hot": 2**0.5, "a": 1e-4, "b": 1e-6, None: 0.3}
    places = mixing_positions(docs(spark)[1], weights=weights, block_chars=20)
    total = sum(map(Fraction, weights.values()))
    found = places.select("source", "block", "slot").distinct().collect()
    assert all(abs(r.block - Fraction(weights[r.source]) / total * r.slot) < 1 for r in found)
    assert max(r.slot for r in found) > 10_000_000 and len({r.slot for r in found}) == len(found)
