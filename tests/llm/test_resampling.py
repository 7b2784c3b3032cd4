"""Importance resampling against a plain version, and its use as a classifier."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citymart.llm.labelled import held_out
from citymart.llm.resampling import BUCKETS, bucket_counts, log_ratios, mark_largest, ngrams, resample

DOCS = "doc_id long, text string, kept string, log_weight int"
LABELS = "doc_id long, quality int, text string"


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcde", k=4)) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text, good = rng.choices(words, k=rng.choice([30, 120])), rng.random() < 0.75
        if not good:
            text = [w + "###" for w in text] if rng.random() < 0.5 else sorted(text[:5] * 12)
        docs.append((i, " ".join(text), "k", 3))
        if rng.random() < 0.7:
            labels.append((i, int(good), "t"))
    return docs, labels


def test_ngrams_of_a_text():
    assert len(ngrams("One, two")) == 3 + 2
    assert ngrams("a b").tolist() == ngrams("A\n\tB").tolist() != ngrams("b a").tolist()
    assert ngrams("x x y y")[4] == ngrams("x x y y")[6] == 0  # repeats are one pair
    assert ngrams(None).tolist() == ngrams("").tolist() == [] and len(ngrams("one")) == 1


def test_weights_equal_a_plain_version(spark):
    docs, labels = corpus()
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in resample(df.repartition(4), marks).collect()}
    held = {r.doc_id for r in df.filter(held_out("doc_id")).collect()}
    target, raw = [1] * BUCKETS, [1] * BUCKETS
    good = {i for i, q, _ in labels if q and i not in held}
    for i, text, *_ in docs:
        for b in ngrams(text):
            raw[b] += 1
            target[b] += i in good
    logs = [math.log(t / sum(target)) for t in target], [math.log(r / sum(raw)) for r in raw]
    for i, text, *_ in docs:
        assert found[i].log_weight == pytest.approx(sum(logs[0][b] - logs[1][b] for b in ngrams(text)))
    trained = [q for i, q, _ in labels if i not in held]
    k = round(sum(trained) / len(trained) * len(docs))
    best = sorted(found.values(), key=lambda r: (-r.sampling_key, r.doc_id))[:k]
    assert {r.doc_id for r in best} == {r.doc_id for r in found.values() if r.kept}


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    truth = {i: q for i, q, _ in labels}
    rows = [r for r in resample(df, marks).filter(held_out("doc_id")).collect() if r.doc_id in truth]
    assert sum(r.kept == truth[r.doc_id] for r in rows) / len(rows) > 0.9


def test_noise_samples_by_weight(spark):
    """Without labels all weights are equal: each row has the same chance, given by its id."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    none = spark.createDataFrame([], LABELS)
    kept = [r.doc_id for r in resample(df, none, keep=0.25).filter("kept").collect()]
    assert len(kept) == 1000 and 1700 < sum(kept) / len(kept) < 2300
    assert resample(df, none).filter("kept").count() == 4000


@pytest.mark.parametrize("k", [0, 1, 37, 99, 100, 150])
def test_largest_rows_with_ties(spark, k):
    rows = [(i, float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, key double").repartition(6)
    found = {r.id for r in mark_largest(df, "key", "id", k, "top").filter("top").collect()}
    assert found == {i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}


def test_odd_rows_and_empty_tables(spark):
    docs = [(None, None, "", 0), (1, "", "", 0), (1, "", "", 0), (2, "word " * 100_000, "", 0)]
    df = spark.createDataFrame(docs, DOCS)
    marks = spark.createDataFrame([(1, None, ""), (None, 1, ""), (2, 1, ""), (2, 0, "")], LABELS)
    rows = resample(df, marks).collect()
    assert len(rows) == 4 and sorted(r.n_grams for r in rows) == [0, 0, 0, 199_999]
    empty, none = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert resample(empty, none).collect() == [] and resample(empty, marks).collect() == []
    assert log_ratios(bucket_counts(empty, "text"), bucket_counts(empty, "text")).any() == False  # noqa: E712
