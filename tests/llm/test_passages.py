"""Shared passages against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from citymart.llm.passages import anchors, shared_passages, split_words

SCHEMA = "doc_id long, text string, start int, pos string"


def plain_passages(rows, least):
    seen = defaultdict(set)
    texts = [(i, split_words(t)) for i, t in rows if i is not None]
    for i, w in texts:
        for p in range(len(w) - least + 1):
            seen[tuple(w[p : p + least])].add(i)
    spans = defaultdict(set)
    for i, w in texts:
        for p in range(len(w) - least + 1):
            if len(seen[tuple(w[p : p + least])]) > 1:
                spans[i].add((p, p + least))
    out = set()
    for i, found in spans.items():
        merged = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        out |= {(i, a, b, b - a) for a, b in merged}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "p") for i, t in rows], SCHEMA)


def corpus(seed, least, vocabulary=50):
    """Documents that share passages in changing surroundings, some a little changed, some too short."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(vocabulary)]
    make = lambda n: rng.choices(words, k=n)
    passages = [make(n) for n in (least - 1, least, least + 1, 2 * least, 5 * least)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rng.randint(0, 4)):
            passage = list(rng.choice(passages))
            if rng.random() < 0.3:
                passage[rng.randrange(len(passage))] = "changed"
            text += make(rng.randint(0, 2 * least)) + passage[rng.choice([0, 0, 1, 5]) :]
        rows.append((i, " ".join(text)))
    rows += [(200, " ".join(["same"] * 200)), (201, " ".join(["same"] * 90)), (202, rows[3][1]), (203, rows[3][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, least", [(1, 50), (2, 50), (3, 20), (4, 12)])
def test_passages_equal_brute_force(spark, seed, least):
    rows = corpus(seed, least)
    found = [tuple(r) for r in shared_passages(frame(spark, rows).repartition(6), least=least).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_passages(rows, least)


def test_few_words_make_many_near_misses(spark):
    rows = corpus(5, 16, vocabulary=3)
    assert {tuple(r) for r in shared_passages(frame(spark, rows), least=16).collect()} == plain_passages(rows, 16)


def test_anchors_follow_content():
    rng = random.Random(9)
    words = [b"%d" % rng.randrange(1000) for _ in range(3000)]
    at, hashes, first, last = anchors(words, 50)
    assert first[0] == 0 and last[-1] == 2950 and (first[1:] == last[:-1] + 1).all()
    assert ((at >= first) & (at <= last + 42) & (at >= last)).all()
    part, part_hashes, _, _ = anchors(words[1000:1050], 50)
    assert len(part) == 1 and part[0] + 1000 in at and part_hashes[0] in hashes
    assert len(anchors(words[:49], 50)[0]) == 0
    long = [b"%d" % (i * i % 9973) for i in range(200_000)]
    at, _, first, last = anchors(long, 50)
    assert (first[1:] == last[:-1] + 1).all() and np.diff(at).max() <= 43


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "short " * 10)]
    assert shared_passages(frame(spark, rows)).collect() == []  # only one document
    rows += [(5, "\t" + text.upper().replace(" ", "\n"))]
    assert {tuple(r) for r in shared_passages(frame(spark, rows)).collect()} == {(1, 0, 60, 60), (5, 0, 60, 60)}
    assert shared_passages(frame(spark, [])).collect() == []


def test_texts_of_one_id_keep_their_own_word_numbers(spark):
    shared = [f"s{i}" for i in range(120)]
    first = " ".join(shared[:60] + [f"a{i}" for i in range(10)])
    second = " ".join([f"b{i}" for i in range(55)] + shared[60:])
    rows = [(1, first), (1, second), (1, second), (2, " ".join(shared[:60])), (3, " ".join(shared[60:]))]
    found = sorted(tuple(r) for r in shared_passages(frame(spark, rows)).collect())
    assert found == [(1, 0, 60, 60), (1, 55, 115, 60), (2, 0, 60, 60), (3, 0, 60, 60)]
