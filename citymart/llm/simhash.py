"""Near-duplicate texts by SimHash: grid range join over popcounts of the fingerprint's segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.llm.components import connected_components
from citymart.llm.names import unused
from citymart.session import stage

SEGMENTS = 16
WIDTH = 64 // SEGMENTS


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """SimHash of the text's shingles as a signed 64-bit number; no words or NULL give zero.

    A-Z count as a-z, words are split at ASCII white space, every repeat of a shingle counts.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        tokens, words = [b" ".join(tokens)], 1
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    total, ones, digest = 0, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), ">u8", len(tokens) - words + 1)
    for start in range(0, len(hashes), 1 << 16):  # 64 bytes a shingle: in parts for long texts
        part = hashes[start : start + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``id_col``, ``fp`` and ``text_hash`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words) for t in batch.column(2)]
            columns = [batch.column(0), pa.array(fps, pa.int64()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "fp", "text_hash"])

    out = df.select(id_col, F.xxhash64(text_col).alias("text_hash"), text_col)
    kind = out.schema[id_col].dataType.simpleString()
    return out.mapInArrow(run, f"`{id_col}` {kind}, fp bigint, text_hash bigint")


def _segment(i: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", WIDTH * i).bitwiseAND(2**WIDTH - 1)).cast("long")


def _cells(bits: int) -> Column:
    """Keys of all cells within ``bits // 2`` (rounded up) steps of the popcount vector.

    A key has four bits per segment. Two vectors at Manhattan distance d have one between them that
    is within ceil(d / 2) of both, so they meet there.
    """
    counts = [_segment(i) for i in range(SEGMENTS)]
    own = counts[0]
    for i in range(1, SEGMENTS):
        own = own.bitwiseOR(F.shiftleft(counts[i], 4 * i))
    keys = F.array(own)
    for _ in range(-(-bits // 2)):
        keys = F.array_distinct(F.flatten(F.transform(keys, _with_neighbours)))
    return keys


def _with_neighbours(key: Column) -> Column:
    """The key and those one step from it, counts staying between 0 and the segment's width."""
    steps = [key]
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned(key, 4 * i).bitwiseAND(F.lit(15).cast("long"))
        one = F.lit(1 << (4 * i)).cast("long")
        steps.append(F.when(count < WIDTH, key + one))
        steps.append(F.when(count > 0, key - one))
    return F.filter(F.array(*steps), lambda k: k.isNotNull())


def _links(distinct: DataFrame, bits: int) -> DataFrame:
    """``a``, ``b``: fingerprints ``fp`` that differ in at most ``bits`` bits, the smaller one first.

    The optimizer's size of exploded rows leaves out that each becomes many, so without the hint it would broadcast
    far more cells than its threshold allows.
    """
    cells = distinct.select("fp", F.explode(_cells(bits)).alias("cell"))
    left, right = cells.alias("l"), cells.hint("merge").alias("r")
    return left.join(
        right,
        (F.col("l.cell") == F.col("r.cell"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= bits),
    ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def _classes(df: DataFrame, id_col: str, text_col: str, words: int, bits: int) -> DataFrame:
    """``id_col``, ``text_hash``, ``fp``, ``group`` and ``component_id`` of every row with an id.

    A group is known by its smallest fingerprint, as one id may stand for unrelated texts."""
    rows = stage(fingerprints(df.filter(F.col(id_col).isNotNull()), id_col, text_col, words), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min(id_col).alias("rep")), "distinct")
    links = _links(distinct, bits)
    groups = connected_components(links)
    classes = distinct.join(groups, F.col("fp") == F.col("node"), "left")
    classes = classes.select(F.col("fp").alias("__fp"), "rep", F.coalesce("component", "fp").alias("group"))
    smallest = classes.groupBy("group").agg(F.min("rep").alias("component_id"))
    classes = stage(classes.join(smallest, "group").drop("rep"), "classes")
    return rows.join(classes, F.col("fp") == F.col("__fp")).drop("__fp")


def simhash_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2
) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``, ``kept``.

    Texts whose fingerprints differ in at most ``bits`` bits are linked; ``component_id`` is the
    smallest id reachable over links, ``kept`` marks that id. NULL and empty texts have fingerprint
    zero and link like any other. Rows without an id are left out. Rows that repeat an id are texts of
    their own under that id. Other columns are ignored. An empty table gives no rows.

    The fingerprint is cut into 16 segments of four bits and mapped to the vector of their popcounts;
    the Manhattan distance of two vectors is never above the number of differing bits. Every distinct
    fingerprint (copies collapse first, combined before the shuffle) goes to the grid cells within
    half the distance, cells join by key, and the bits are compared exactly. A fingerprint has at
    most 2080 others within two bits, however many copies there are, so the links stay linear.
    """
    return _classes(df, id_col, text_col, words, bits).select(
        id_col,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col(id_col) == F.col("component_id")).alias("kept"),
    )


def drop_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2
) -> DataFrame:
    """``df`` with one row of every group of linked texts, the one with the smallest id.

    Rows that repeat both id and text count once. Where one id has several texts in a group, the text
    with the smallest hash stays. Rows without an id stay: they cannot be told apart.
    """
    rows = _classes(df, id_col, text_col, words, bits).groupBy(id_col, "text_hash", "group").count()
    rows = stage(rows, "texts")
    first = rows.groupBy("group").agg(F.min(F.struct(id_col, "text_hash")).alias("first"))
    own_id, own_hash = unused(df, "id"), unused(df, "hash")
    first = first.select(F.col(f"first.{id_col}").alias(own_id), F.col("first.text_hash").alias(own_hash))
    same = (F.col(id_col) == F.col(own_id)) & (F.col("text_hash") == F.col(own_hash))
    known = F.col(id_col).alias(own_id), F.col("text_hash").alias(own_hash)
    gone = rows.join(first, same, "left_anti").select(*known)
    here = (F.col(id_col) == F.col(own_id)) & (F.xxhash64(text_col) == F.col(own_hash))
    kept = df.join(gone, here, "left_anti")
    twice = rows.filter("count > 1").select(*known)
    if twice.isEmpty():
        return kept
    several = kept.join(twice, here, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(twice, here, "left_anti").unionByName(several)
