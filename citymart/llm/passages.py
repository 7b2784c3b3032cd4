"""Passages that documents share: a sparse suffix array over minimiser positions."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from citymart.session import stage

#: Words whose hash makes a position eligible.
GRAM = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z as a-z."""
    return (text or "").encode().lower().split()


def anchors(words: list[bytes], least: int) -> tuple[np.ndarray, ...]:
    """Minimiser positions of a text, the hashes of the ``GRAM`` words there, and the first and the
    last start of the runs of ``least`` words that each position was chosen for.

    Of every ``least - GRAM + 1`` positions in a row the leftmost one with the smallest hash is
    chosen, so that ``least`` words in a row, wherever they stand, have the same position chosen
    inside them. Shorter texts have none.
    """
    n, window = len(words) - GRAM + 1, least - GRAM + 1
    if n < window:
        return (np.zeros(0, np.int64),) * 4
    sums = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    hashes = np.zeros(n, np.uint64)
    for i in range(GRAM):
        hashes = hashes * _MIX + sums[i : i + n] + np.uint64(1)
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(29)
    chosen = np.empty(n - window + 1, np.int64)
    for start in range(0, len(chosen), 1 << 16):  # in parts for long texts
        part = np.lib.stride_tricks.sliding_window_view(hashes[start : start + (1 << 16) + window - 1], window)
        chosen[start : start + len(part)] = part.argmin(axis=1) + np.arange(start, start + len(part))
    at, first, count = np.unique(chosen, return_index=True, return_counts=True)
    return at, hashes[at].view(np.int64), first, first + count - 1


def _anchor_rows(docs: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, positions, grams = [], [], []
            for key, text in zip(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)):
                at, hashes, _, _ = anchors(split_words(text.as_py()), least)
                keys.append(np.full(len(at), key))
                positions.append(at.astype(np.int32))
                grams.append(hashes)
            columns = [pa.array(np.concatenate(c)) for c in (keys, positions, grams)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "pos", "gram"])

    return docs.select("key", "text").mapInArrow(run, "key bigint, pos int, gram bigint")


def _suffix_rows(docs: DataFrame, least: int, id_kind: str) -> DataFrame:
    """``id`` and ``key`` of a text, ``suffix`` (the ``least`` words from a position), ``left`` (as many before, the last
    first), how far before the position the runs that it was chosen for begin, ``near`` to ``far``, and
    ``at``, all positions of the document that have these. Words that repeat over and over, which have
    positions chosen at every step, make few rows."""
    names = ["id", "suffix", "left", "near", "far", "at", "key"]
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, out = batch.column(0), batch.column(3), []

            def table() -> pa.RecordBatch:
                row, *columns = zip(*out)
                columns, row = [pa.array(c, k) for c, k in zip(columns, kinds)], pa.array(row)
                return pa.RecordBatch.from_arrays([ids.take(row), *columns, texts.take(row)], names=names)

            for row, (text, chosen) in enumerate(zip(batch.column(1), batch.column(2))):
                words, wanted = split_words(text.as_py()), set(chosen.as_py())
                at, _, first, last = (c.tolist() for c in anchors(words, least))
                same: dict[tuple, list[int]] = {}
                for p, low, high in zip(at, first, last):
                    if p in wanted:
                        suffix, left = words[p : p + least], words[max(0, p - least) : p]
                        key = b" ".join(suffix), b" ".join(left[::-1]), p - high, p - low
                        same.setdefault(key, []).append(p)
                out += [(row, *key, places) for key, places in same.items()]
                if len(out) > 20_000:
                    yield table()
                    out.clear()
            if out:
                yield table()

    return docs.mapInArrow(run, f"id {id_kind}, suffix binary, left binary, near int, far int, at array<int>, key bigint")


def common_words(a: bytes, b: bytes) -> int:
    """Number of equal words at the beginning."""
    if a == b:
        return len(a.split())
    n = 0
    for x, y in zip(a.split(), b.split()):
        if x != y:
            break
        n += 1
    return n


#: Keys that a task remembers to have told.
RECENT_KEYS = 100_000

Row = tuple  # id, suffix, left, near, far, at, key


def run_keys(row: Row, first: int, last: int, least: int) -> Iterator[tuple[int, bytes]]:
    """For ``first`` to ``last`` words back, the ``least`` words that begin there, as 128 bits."""
    if first <= last:
        left, right = row[2].split()[:last][::-1], row[1].split()
        for back in range(first, last + 1):
            words = left[len(left) - back :] + right[: least - back]
            yield back, xxhash.xxh3_128_digest(b" ".join(words))


def shared_spans(rows: Iterable[Row], least: int) -> Iterator[tuple]:
    """What sorted suffixes share with their neighbours, and what is left to find out.

    * ("span", row, left, right): words before and from the positions on that are shared with the nearest suffix of another document on either
      side, which has the longest common beginning; the match is extended to the left.
    * ("ask" or "tell", row, back, key): a run of ``least`` words, beginning ``back`` words before the
      positions, that some other suffix may share, as its part to the right is no longer than the
      longest common beginning; "ask" if no span covers it, else "tell": it is shared. Once is enough
      for suffixes that are the same on both sides and for runs told lately. The first and the last
      rows, which lack a neighbour on one side, may share any run.
    """
    before: Row | None = None
    run: list[Row] = []
    told: Row | None = None
    recent: set[bytes] = set()

    def looked_at(row: Row, others: list[Row | None]) -> Iterator[tuple]:
        nonlocal told
        spans, right, twin = [], 0, False
        for other in others:
            if other is None:
                right = least
                continue
            common = common_words(row[1], other[1])
            right = max(right, common)
            if common >= GRAM:
                left = common_words(row[2], other[2])
                twin = twin or row[1:3] == other[1:3]
                if left + common >= least:
                    spans.append((left, common))
        yield from (("span", row, *span) for span in spans)
        if twin:
            if told == row[1:5]:
                return
            told = row[1:5]
        if right >= GRAM:
            if len(recent) > RECENT_KEYS:
                recent.clear()
            for back, key in run_keys(row, max(row[3], least - right), row[4], least):
                covered = any(back <= a and least - back <= b for a, b in spans)
                if not covered:
                    yield "ask", row, back, key
                elif key not in recent:
                    recent.add(key)
                    yield "tell", row, back, key

    for row in rows:
        if run and row[0] != run[0][0]:
            for r in run:
                yield from looked_at(r, [before, row])
            before, run = run[-1], []
        run.append(row)
    for r in run:
        yield from looked_at(r, [before, None])


def _compare(rows: DataFrame, least: int, id_kind: str) -> DataFrame:
    """``shared_spans`` over each partition, with the keys of the runs asked and told."""
    kinds = [to_arrow_type(rows.schema["id"].dataType), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    names = ["id", "key", "what", "start", "end", "run_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[Row]:
            wanted = ("id", "suffix", "left", "near", "far", "at", "key")
            for batch in batches:
                yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in wanted))

        def table(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        out = []
        for what, row, *more in shared_spans(read(), least):
            if what == "span":
                out += [(row[0], row[6], what, p - more[0], p + more[1], None) for p in row[5]]
            elif what == "ask":
                out += [(row[0], row[6], what, p - more[0], p - more[0] + least, more[1]) for p in row[5]]
            else:
                out.append((None, None, what, None, None, more[1]))
            if len(out) >= 10_000:
                yield table(out)
                out = []
        if out:
            yield table(out)

    return rows.mapInArrow(run, f"id {id_kind}, key bigint, what string, start int, end int, run_key binary")


def shared_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50) -> DataFrame:
    """One row per passage of at least ``least`` words that a document shares with another.

    ``id_col``, ``start`` and ``end`` (word numbers, end exclusive), ``words``. Words are split at ASCII
    white space, A-Z count as a-z. Overlapping and touching passages of a text are one. Documents
    that share nothing have no rows. NULL, empty and shorter texts share nothing; rows without an id
    are left out; rows that repeat an id are one document, which does not share with itself; its
    different texts have rows of their own, with word numbers of each. Other columns are ignored. An empty
    table gives no rows.

    Positions with the smallest hash of their window are kept; those whose words begin a position in
    another document too (counted with a combined aggregate, joined as a skewed join) become suffixes.
    Suffixes with their words to either side are sorted by ranges, so that the suffixes of a frequent
    passage are split over tasks; each task compares neighbours and extends their matches. A
    neighbour need not be the partner with the longest match on both sides together: runs of ``least``
    words that no match covers but some other suffix may share are looked up by a 128-bit key, which
    also settles the rows at the tasks' ends. So every run that two documents share is found.
    """
    id_kind = df.schema[id_col].dataType.simpleString()
    docs = df.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text")
    )
    found = stage(_anchor_rows(docs, least), "anchors")
    several = found.groupBy("gram").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    several = several.filter("low <> high").select(F.col("gram").alias("__gram"))
    # a table of its own, so that a frequent one's rows are split in the join
    several = stage(several, "several")
    chosen = found.join(several, F.col("gram") == F.col("__gram"), "left_semi")
    chosen = chosen.groupBy(F.col("key").alias("__key")).agg(F.collect_set("pos").alias("at"))
    chosen = stage(chosen, "chosen")
    texts = docs.join(chosen, F.col("key") == F.col("__key")).select("id", "text", "at", "key")
    suffixes = stage(_suffix_rows(texts, least, id_kind), "suffixes")
    order = ["suffix", "left", "id", "key", "at"]
    suffixes = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    compared = stage(_compare(suffixes, least, id_kind), "compared")
    place = ["id", "key", "start", "end"]
    spans = compared.filter("what = 'span'").select(*place)
    # a run asked for is shared if it was told, or asked for by another document; only asks have an id
    runs = compared.filter("run_key is not null")
    known = runs.groupBy("run_key").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.bool_or(F.col("id").isNull()).alias("told")
    )
    known = stage(known.filter("told and low is not null or low <> high").select("run_key"), "runs")
    asked = runs.filter("id is not null").select(*place, "run_key")
    spans = spans.unionAll(asked.join(known, "run_key", "left_semi").select(*place)).distinct()
    # overlapping spans of a text become one
    before = Window.partitionBy("id", "key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("fresh", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
    so_far = Window.partitionBy("id", "key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("passage", F.sum("fresh").over(so_far))
    spans = spans.groupBy("id", "key", "passage").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.select(F.col("id").alias(id_col), "start", "end", (F.col("end") - F.col("start")).alias("words"))
