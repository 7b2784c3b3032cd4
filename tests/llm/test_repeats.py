"""Periodic runs against a comparison of all words at all distances."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citymart.llm import repeats
from citymart.llm.queries import op11_periodic_runs
from citymart.llm.repeats import find_runs, inverse_transform, mismatches, periodic_runs, transform

COLUMNS = "doc_id long, text string, runs string, n_words string, collapsed int, words int, picked int"


def plain(words):
    """All maximal stretches of every period; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def digest(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain(words)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    sums = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (doc_id, len(runs), *best, milli, *sums)


def nested(rng, depth, kinds):
    if not depth:
        return [rng.randrange(kinds) for _ in range(rng.randrange(1, 12))]
    words = nested(rng, depth - 1, kinds) * rng.randrange(1, 6)
    if rng.random() < 0.5:
        words = words + [rng.randrange(kinds)]
    return nested(rng, depth - 1, kinds) + words if rng.random() < 0.3 else words


def test_transform_and_back():
    values = np.random.default_rng(3).integers(0, repeats.PRIME, (5, 64)).astype(np.uint64)
    assert (inverse_transform(transform(values)) == values).all()


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 4), st.integers(0, 40), st.integers(0, 10**6))
def test_mismatches_are_sums_of_squares(power, more, seed):
    rng, size = np.random.default_rng(seed), 2**power
    blocks, windows = rng.integers(0, 3000, (3, size)), rng.integers(0, 3000, (3, size + more))
    want = [[((b - w[j : j + size]) ** 2).sum() for j in range(more + 1)] for b, w in zip(blocks, windows)]
    assert mismatches(blocks, windows).tolist() == want


@pytest.mark.parametrize("kinds", [1, 2, 3, 60])
def test_runs_equal_the_plain_ones(kinds):
    rng = random.Random(kinds)
    for _ in range(150):
        words = sum((nested(rng, rng.randrange(4), kinds) for _ in range(rng.randrange(1, 4))), [])[:700]
        assert find_runs(np.array(words, np.int64), kinds) == plain(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=200))
def test_runs_of_any_bits_equal_the_plain_ones(words):
    assert find_runs(np.array(words, np.int64), 2) == plain(words)


def test_words_that_share_a_number_are_told_apart(monkeypatch):
    monkeypatch.setattr(repeats, "_symbols", lambda words, kinds, block: words % 2)
    rng = random.Random(9)
    for _ in range(40):
        words = nested(rng, 3, 6)[:400]
        assert find_runs(np.array(words, np.int64), 6) == plain(words)


def test_small_batches_give_the_same_runs(monkeypatch):
    words = np.array(nested(random.Random(2), 3, 3) * 4, np.int64)
    want = find_runs(words, 3)
    monkeypatch.setattr(repeats, "BATCH_VALUES", 1)
    assert find_runs(words, 3) == want == plain(words.tolist())


def test_long_texts_end_in_time():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 60_000:
        fibonacci, before = fibonacci + before, fibonacci
    for words in (np.zeros(300_000, np.int64), np.tile(np.arange(997), 200), np.array(fibonacci)):
        runs = find_runs(words, int(words.max()) + 1)
        assert runs and all(m >= 3 * p for _, m, p in runs)


ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a " * 23),
    (5, "a " * 24),
    (6, "x " + "a b c " * 8 + "a y"),
    (7, "a b  c\x1cd " * 30),
    (8, "a b " * 20 + "c d e " * 20),
    (None, "q " * 30),
    (9, "to be or not to be that is the question"),
    (9, "to be or not to be that is the question"),
    (10, "é ü \U0001f642 " * 9),
]


def test_query_equals_the_plain_version(spark, tmp_path):
    rng = random.Random(4)
    long = [" ".join(rng.choices("abcdefgh", k=rng.choice([5, 40, 300]))) for _ in range(150)]
    rows = ROWS + [(i, t) for i, t in enumerate(long, 100)] + [(300 + i, "w" + " v" * i) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert found == sorted((digest(*r) for r in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(100, 250))


def test_operator_gives_runs_and_texts(spark):
    docs = spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in ROWS], COLUMNS)
    found = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert [tuple(r) for r in found[6].runs] == [(1, 25, 3)] and found[6].collapsed == "x a b c y"
    assert [tuple(r) for r in found[8].runs] == [(0, 40, 2), (40, 60, 3)] and found[8].collapsed == "a b c d e"
    assert found[1].n_words == 0 and found[1].runs == [] and found[1].collapsed == ""
    assert found[4].runs == [] and [tuple(r) for r in found[5].runs] == [(0, 24, 1)]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert periodic_runs(docs).collect() == [] and op11_periodic_runs(spark, str(tmp_path)).collect() == []
