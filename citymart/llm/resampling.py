"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymart.llm.labelled import TRAIN_ROWS, training_rows
from citymart.session import stage

#: Buckets that n-grams are hashed into: the size of a model.
BITS = 16
BUCKETS = 1 << BITS

_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]+")
# Odd multipliers that mix the tokens' checksums.
_ONE, _LEFT, _RIGHT = (np.uint64(m) for m in (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


def ngrams(text: str | None) -> np.ndarray:
    """Buckets of the text's tokens and pairs of neighbouring tokens, repeats included.

    Tokens are runs of letters and digits or of other signs; A-Z count as a-z. A token that repeats
    the one before is the same pair whatever the token is.
    """
    tokens = _TOKEN.findall((text or "").encode().lower())
    sums = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    pairs = (sums[:-1] * _LEFT + sums[1:] * _RIGHT) >> np.uint64(64 - BITS)
    pairs[sums[:-1] == sums[1:]] = 0
    return np.concatenate([(sums * _ONE) >> np.uint64(64 - BITS), pairs]).astype(np.int64)


def bucket_counts(df: DataFrame, text_col: str) -> DataFrame:
    """``bucket`` and ``n`` over all texts; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(ngrams(text.as_py()), minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    counted = df.select(text_col).mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(target: DataFrame, raw: DataFrame) -> np.ndarray:
    """Log of target over raw probability per bucket, one added to every count."""
    logs = []
    for counts in (target, raw):
        n = np.ones(BUCKETS)
        for r in counts.collect():  # BUCKETS rows at most
            n[r.bucket] += r.n
        logs.append(np.log(n) - np.log(n.sum()))
    return logs[0] - logs[1]


def log_weights(df: DataFrame, ratios: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, ``n_grams`` and ``log_weight``, the sum of the ratios of a text's n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngrams(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([len(f) for f in found], pa.int64()), pa.array([float(ratios[f].sum()) for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "n_grams", "log_weight"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_grams bigint, log_weight double")


def mark_largest(df: DataFrame, key: str, tie: str, k: int, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether a row is among the ``k`` with the largest ``key``, then smallest ``tie``.

    Rows are dealt out by ranges of the key; only the range in which the kth row lies is ranked.
    """
    ranged = df.repartitionByRange(F.desc(key), F.asc(tie)).withColumn("__range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    left, edge = k, -1
    for r in ranged.groupBy("__range").count().orderBy("__range").collect():  # one row per range
        edge = r["__range"]
        if left < r["count"]:
            break
        left, edge = left - r["count"], edge + 1
    inside = ranged.filter(F.col("__range") == edge)
    rank = F.row_number().over(Window.partitionBy("__range").orderBy(F.desc(key), F.asc(tie)))
    inside = inside.withColumn(flag, rank <= left)
    outside = ranged.filter(F.col("__range") != edge).withColumn(flag, F.col("__range") < edge)
    return outside.unionByName(inside).drop("__range")


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    limit: int = TRAIN_ROWS,
    seed: int = 42,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_grams``, ``log_weight``, ``sampling_key``, ``kept``.

    The target model counts n-grams of at most ``limit`` documents labelled 1 outside the held-out
    third, the raw model those of all documents. A document's weight is the ratio of its likelihoods
    under the two; adding Gumbel noise, drawn from the id and ``seed``, and keeping the largest keys
    samples without replacement in proportion to the weights. ``keep`` is the share of rows kept, by
    default the share of label 1 among those labels (all, if there are none).

    NULL and empty texts have weight one (log 0). Rows with a NULL id, and repeated rows, are sampled
    on their own; equal keys go by id. Other columns are ignored; an empty table gives no rows.
    """
    rows = stage(training_rows(docs, labels, id_col, text_col, label_col, limit), "training")
    counts = rows.agg(F.count(F.when(F.col("label"), 1)), F.count("*")).first()
    if keep is None:
        keep = counts[0] / counts[1] if counts[0] else 1.0
    ratios = np.zeros(BUCKETS)
    if counts[0]:
        ratios = log_ratios(bucket_counts(rows.filter("label"), "text"), bucket_counts(docs, text_col))
    weighed = log_weights(docs, ratios, id_col, text_col)
    uniform = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    weighed = weighed.withColumn("sampling_key", F.col("log_weight") - F.log(-F.log(uniform)))
    weighed = stage(weighed, "weights")
    return mark_largest(weighed, "sampling_key", id_col, round(keep * weighed.count()), "kept")
