"""SimHash groups against a brute-force version, and what becomes of odd rows."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from citymart.llm.components import connected_components
from citymart.llm.simhash import _links, drop_duplicates, fingerprint, simhash_duplicates

SCHEMA = "doc_id long, text string, fp long, cell string"


def plain_fingerprint(text, words=3):
    tokens = (text or "").lower().split()
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, bits=2):
    fps = [plain_fingerprint(t) for _, t in rows]
    group = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= bits and group[j] < group[i]:
                    group[i], changed = group[j], True
    return {(rows[i][0], f"{fps[i]:016x}", group[i]) for i in range(len(rows))}


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], SCHEMA)


def near_copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        words = rng.choices(vocabulary, k=rng.choice([4, 60, 400]))
        for copy in range(rng.choice([1, 3, 8])):
            changed = list(words)
            for _ in range(copy % 3):
                changed[rng.randrange(len(changed))] = "other"
            rows.append((base * 100 + copy, " ".join(changed)))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one"), (5004, "ONE"), (5005, "two words")]
    rng.shuffle(rows)
    return rows


def test_groups_equal_brute_force(spark):
    rows = near_copies()
    found = simhash_duplicates(docs(spark, rows)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == plain_groups(rows)
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("bits", [0, 1, 3, 4])
def test_any_distance_is_joined_exactly(spark, bits):
    rows = near_copies(2)
    found = simhash_duplicates(docs(spark, rows), bits=bits).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == plain_groups(rows, bits)


def test_shingles_of_white_space_case_and_long_texts():
    assert fingerprint("A b\x0bC  d", 3) == fingerprint("a B c D", 3)
    assert fingerprint("É a", 3) != fingerprint("é a", 3)  # only A-Z are folded
    assert fingerprint("a b c", 3) == fingerprint("a B c", 3)  # one word with a no-break space
    long = " ".join(f"w{i % 5000}" for i in range(150_000))
    assert fingerprint(long, 3) % 2**64 == plain_fingerprint(long)


def test_one_of_each_group_stays_with_all_columns(spark):
    rows = near_copies(3)
    kept = drop_duplicates(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "cell"]
    assert {r.doc_id for r in kept.collect()} == {g for _, _, g in plain_groups(rows)}


def test_repeated_rows_and_missing_ids(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (2, text), (3, "x y z q"), (3, "p q r s t"), (None, text), (None, text)]
    found = {(r.doc_id, r.component_id) for r in simhash_duplicates(docs(spark, rows)).collect()}
    assert found == {(1, 1), (2, 1), (3, 3)}
    kept = sorted((r.doc_id or 0, r.text) for r in drop_duplicates(docs(spark, rows)).collect())
    assert kept.count((1, text)) == 1 and (2, text) not in kept and kept.count((0, text)) == 2
    assert sum(i == 3 for i, _ in kept) == 2  # two different texts of one id


def test_empty_table(spark):
    assert simhash_duplicates(docs(spark, [])).collect() == []
    assert drop_duplicates(docs(spark, [])).collect() == []


def test_components(spark):
    pairs = [(5, 4), (4, 3), (3, 3), (9, 8), (8, 9), (20, 21), (None, 1)] + [(30 + i, 31 + i) for i in range(40)]
    pairs += [(100, 100 + i) for i in range(1, 200)]
    found = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = {3: 3, 4: 3, 5: 3, 8: 8, 9: 8, 20: 20, 21: 20} | {i: 30 for i in range(30, 71)} | {i: 100 for i in range(100, 300)}
    assert {r.node: r.component for r in found} == want and len(found) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_cells_are_not_broadcast(spark, tmp_path):
    """Each fingerprint goes to many cells: a stored table below the threshold is far above it once exploded."""
    spark.range(2000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("rep")).write.parquet(str(tmp_path / "fps"))
    links = _links(spark.read.parquet(str(tmp_path / "fps")), 2)
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan
