"""Periodic runs of words: blocks convolved with the windows that follow them, at dyadic scales."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A prime with roots of unity for every power of two up to 2^23, and a generator.
PRIME, GENERATOR = 998_244_353, 3
#: Least length of a run, in words, and of a block.
LEAST_RUN, LEAST_BLOCK = 24, 8
#: A run holds its period at least so many times.
LEAST_TIMES = 3
#: Blocks are transformed together up to so many values.
BATCH_VALUES = 1 << 17


@cache
def _roots(half: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(1, np.uint64)
    while len(powers) < half:
        powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), PRIME)) % np.uint64(PRIME)])
    return powers


def _less(x: np.ndarray) -> np.ndarray:
    """Sums of two residues as residues; the difference wraps around where it would be negative."""
    return np.minimum(x, x - np.uint64(PRIME))


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row, in bit-reversed order."""
    x = x.astype(np.uint64)
    half = x.shape[1] // 2
    while half:
        pairs = x.reshape(len(x), -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        both = _less(low + high)
        pairs[:, :, 1] = (low + np.uint64(PRIME) - high) * _roots(half, False) % np.uint64(PRIME)
        pairs[:, :, 0] = both
        half //= 2
    return x


def inverse_transform(x: np.ndarray) -> np.ndarray:
    """The rows whose transforms are given; inverse of ``transform``."""
    x, half, size = x.copy(), 1, x.shape[1]
    while half < size:
        pairs = x.reshape(len(x), -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * _roots(half, True) % np.uint64(PRIME)
        both = _less(low + high)
        pairs[:, :, 1] = _less(low + np.uint64(PRIME) - high)
        pairs[:, :, 0] = both
        half *= 2
    return x * np.uint64(pow(size, PRIME - 2, PRIME)) % np.uint64(PRIME)


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Squared differences of each block to each place in its window, summed; exact while the sums stay below
    the prime. Row i, column j compares ``blocks[i]`` with ``windows[i, j : j + block length]``."""
    size, width = blocks.shape[1], windows.shape[1]
    full = 1 << (width - 1).bit_length()
    padded = np.zeros((2, len(blocks), full), np.uint64)
    padded[0, :, :size] = blocks[:, ::-1]
    padded[1, :, :width] = windows
    products = transform(padded[0]) * transform(padded[1]) % np.uint64(PRIME)
    products = inverse_transform(products)[:, size - 1 : width].astype(np.int64)
    sums = np.zeros((len(windows), width + 1), np.int64)
    np.cumsum(windows.astype(np.int64) ** 2, axis=1, out=sums[:, 1:])
    own = (blocks.astype(np.int64) ** 2).sum(axis=1, keepdims=True)
    return (own + sums[:, size:] - sums[:, : width - size + 1] - 2 * products) % PRIME


def _symbols(words: np.ndarray, kinds: int, block: int) -> np.ndarray:
    """Words as numbers so small that a block's squared differences add up to less than the prime. Where words
    are more than numbers, some share one: the extension compares the words themselves."""
    limit = int(((PRIME - 1) // block) ** 0.5)
    if kinds <= limit + 1:
        return words
    mixed = words.astype(np.uint64) * np.uint64(2_654_435_761) % np.uint64(1 << 32)
    return (mixed * np.uint64(limit) >> np.uint64(32)).astype(np.int64)


def _gaps(words: np.ndarray) -> np.ndarray:
    """Words from each word to the next one like it; more than all words where there is none."""
    order = np.argsort(words, kind="stable")
    gaps = np.full(len(words), len(words) + 1, np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gaps[order[:-1][same]] = np.diff(order)[same]
    return gaps


def _occurrences(words: np.ndarray, kinds: int, gaps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings of aligned blocks and the distances, of this scale, at which they stand again. A block with a
    word that does not come again within the largest distance has none, so it is not transformed."""
    low, high = (1 if block == LEAST_BLOCK else block), 2 * block - 1
    starts = np.arange(0, len(words) - block - low + 1, block)
    if not len(starts):
        return starts, starts
    widest = np.maximum.reduceat(gaps, starts)[: len(starts)]
    if starts[-1] + block < len(words):  # the last block ends before the text does
        widest[-1] = gaps[starts[-1] : starts[-1] + block].max()
    starts = starts[widest <= high]
    if not len(starts):
        return starts, starts
    width = high - low + block
    values = np.concatenate([_symbols(words, kinds, block), np.zeros(width + high, np.int64)])
    found, at = [], max(1, BATCH_VALUES // (2 * width))
    for first in range(0, len(starts), at):
        some = starts[first : first + at]
        blocks = values[some[:, None] + np.arange(block)]
        windows = values[some[:, None] + low + np.arange(width)]
        row, lag = np.nonzero(mismatches(blocks, windows) == 0)
        begin, distance = some[row], lag + low
        inside = begin + distance + block <= len(words)
        found.append((begin[inside], distance[inside]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _same_from(words: np.ndarray, at: int, distance: int) -> int:
    """End of the places from ``at`` on whose word stands again ``distance`` later."""
    step, end = 64, len(words) - distance
    while at < end:
        stop = min(end, at + step)
        unlike = words[at:stop] != words[at + distance : stop + distance]
        if unlike.any():
            return at + int(unlike.argmax())
        at, step = stop, 2 * step
    return at


def _same_before(words: np.ndarray, at: int, distance: int) -> int:
    """Beginning of the places up to ``at`` whose word stands again ``distance`` later."""
    step = 64
    while at > 0:
        stop = max(0, at - step)
        unlike = words[stop:at] != words[stop + distance : at + distance]
        if unlike.any():
            return at - int(unlike[::-1].argmax())
        at, step = stop, 2 * step
    return 0


def _new_only(begin: np.ndarray, distance: np.ndarray, block: int, runs: dict) -> tuple[np.ndarray, np.ndarray]:
    """Without the distances that cannot begin a run unknown so far.

    A block inside a known run of a third of its length or less stands again at every multiple of that period. A
    run of a longer period leaves the known one on some side, and repeats the place where it does: so its distance
    is that between two known runs' beginnings or ends.
    """
    known = sorted((s, e) for (s, e), p in runs.items() if 3 * p <= block <= e - s)
    if not known or not len(begin):
        return begin, distance
    lefts, rights = np.array(known).T

    def run_of(at: np.ndarray) -> np.ndarray:
        run = np.searchsorted(lefts, at, side="right") - 1
        return np.where((run >= 0) & (rights[run] >= at + block), run, -1)

    here, there = run_of(begin), run_of(begin + distance)
    ends_move = (rights[there] - rights[here] == distance) | (lefts[there] - lefts[here] == distance)
    keep = (here < 0) | ((there >= 0) & (there != here) & ends_move)
    return begin[keep], distance[keep]


def find_runs(words: np.ndarray, kinds: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``words`` are numbers below ``kinds``.

    A run of period p of at least three periods holds, for the largest block size up to p, an aligned block that
    stands again p words later inside the run. Every scale looks at one octave of distances; those found are
    extended on both sides, and of the distances that give the same stretch the smallest is its period.
    """
    n, runs = len(words), {}
    if n < LEAST_RUN:
        return []
    gaps, block = _gaps(words), LEAST_BLOCK
    while block == LEAST_BLOCK or LEAST_TIMES * block <= n:
        begin, distance = _occurrences(words, kinds, gaps, block)
        if 4 * LEAST_BLOCK <= block:
            begin, distance = _new_only(begin, distance, block, runs)
        order = np.lexsort((begin, distance))
        last, reached = 0, 0
        for s, d in zip(begin[order].tolist(), distance[order].tolist()):
            if d == last and s < reached:
                continue
            end = _same_from(words, s, d)
            last, reached = d, max(end, s + 1)
            if end < s + block:  # only the numbers were alike
                continue
            start = _same_before(words, s, d)
            stretch = start, end + d
            if end + d - start >= max(LEAST_RUN, LEAST_TIMES * d):
                runs[stretch] = min(d, runs.get(stretch, d))
        block *= 2
    return sorted((s, e - s, p) for (s, e), p in runs.items())


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` and ``collapsed`` of every row.

    Words are what ASCII white space separates. ``runs`` holds ``start``, ``length`` and ``period``, in words, of every
    stretch that repeats its period (the smallest) three times or more over 24 words or more and that no
    neighbouring word extends, by start, then period. ``collapsed`` is the text with each run cut down to its first
    period, words joined by one space; what overlapping runs cover goes where any run repeats it.

    A NULL or empty text has no words and no runs. Rows with a NULL or repeated id count like any other; other
    columns are ignored; an empty table gives no rows. A text of any length is handled whole by one task; time
    grows little faster than its words, memory with its words, and no rows are shuffled.
    """
    kind = df.schema[id_col].dataType.simpleString()
    struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, texts, size = [], [], [], 0
            first = 0
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                split = (text.as_py() or b"").split()
                numbers = {w: i for i, w in enumerate(dict.fromkeys(split))}
                words = np.fromiter(map(numbers.__getitem__, split), np.int64, len(split))
                runs = find_runs(words, len(numbers))
                if runs:
                    cover = np.zeros(len(split) + 1, np.int64)
                    for start, length, period in runs:
                        cover[start + period] += 1
                        cover[start + length] -= 1
                    split = [w for w, c in zip(split, np.cumsum(cover).tolist()) if not c]
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(b" ".join(split))
                size += len(texts[-1])
                if size > 1 << 24:  # texts of a batch of long rows leave as they come
                    yield pack(batch, first, counts, found, texts)
                    counts, found, texts, size, first = [], [], [], 0, row + 1
            yield pack(batch, first, counts, found, texts)

    def pack(batch: pa.RecordBatch, first: int, counts: list, found: list, texts: list) -> pa.RecordBatch:
        columns = [
            batch.column(0).slice(first, len(counts)),
            pa.array(counts, pa.int64()),
            pa.array(found, pa.list_(struct)),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "runs", "collapsed"])

    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = f"`{id_col}` {kind}, n_words bigint, runs {runs}, collapsed string"
    return df.select(id_col, text_col).mapInArrow(run, schema)
