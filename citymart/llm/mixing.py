"""Mixing sources to target weights: blocks scheduled with Pfair windows, earliest deadline first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citymart.llm.names import unused
from citymart.session import stage

#: Characters of a block, most sources, units ranked by one task, planned blocks handed on at once.
BLOCK_CHARS = 100_000
MAX_SOURCES = 10_000
SLICE_UNITS = 2_000
PLAN_BLOCKS = 50_000


def integer_shares(weights: dict, period: int) -> dict:
    """Slots of each source in a period: the weights scaled to ``period``, largest remainders first.

    Every source with a positive weight gets one slot at least."""
    total = sum(weights.values())
    exact = {s: period * w / total for s, w in weights.items() if w > 0}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (exact[s] - shares[s], str(s)), reverse=True)
    left = period - sum(shares.values())
    for s in order[: max(0, left)]:
        shares[s] += 1
    for s in sorted(shares, key=lambda s: (-shares[s], str(s))) * period:
        if sum(shares.values()) <= period:
            break
        if shares[s] > 1:
            shares[s] -= 1
    return shares


def plan_blocks(weights: list, counts: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Index of the source, block, release, deadline and slot of every block, by slot.

    Block k of a source with the share w of all weights is released at floor(k / w) and due by
    ceil((k + 1) / w), both from the exact weights. Of the released blocks the one due first takes the
    next slot. As the shares add up to one, every block meets its deadline, and after any t slots a
    source that lasts is less than one block away from t w. Slots of sources that ran out stay empty.
    """
    exact = [Fraction(w) for w in weights]
    total = sum(exact)
    steps = [(total / w).as_integer_ratio() for w in exact]  # 1 / w
    waiting = [(0, i, 0) for i, n in enumerate(counts) if n]
    ready: list[tuple[int, int, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * steps[i][0] // steps[i][1]), i, k, release))
        deadline, i, k, release = heapq.heappop(ready)
        yield i, k, release, deadline, slot
        slot += 1
        if k + 1 < counts[i]:
            heapq.heappush(waiting, ((k + 1) * steps[i][0] // steps[i][1], i, k + 1))


def _by_name(source: object) -> tuple[bool, str]:
    return source is None, str(source)


def schedule(shares: dict) -> list[tuple[object, int, int, int, int]]:
    """Source, block, release, deadline and slot of the blocks of one period of whole shares."""
    names = sorted(shares, key=_by_name)
    counts = [shares[s] for s in names]
    return [(names[i], *rest) for i, *rest in plan_blocks(counts, counts)]


def _plan(sizes: DataFrame, weights: dict | None, alpha: float, block_chars: int, period: int | None) -> DataFrame:
    """Every source's blocks with their windows and slots. One task walks through the blocks, holding
    one entry for each source, and hands them on as it goes."""
    kind = sizes.schema["source"].dataType.simpleString()
    names = ["__source", "__block", "release", "deadline", "slot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(s, n) for batch in batches for s, n in zip(batch.column(0), batch.column(1).to_pylist())]
        keys = {s.as_py(): s for s, _ in found}
        lengths = {s.as_py(): n for s, n in found}
        given = weights if weights is not None else {s: n**alpha for s, n in lengths.items()}
        first = {s: given[s] for s in lengths if given.get(s, 0) > 0}
        rest = {s: n for s, n in lengths.items() if s not in first}
        for later, group in enumerate((first, rest)):
            if period is not None and group:
                group = integer_shares(group, max(period, len(group)))
            order = sorted(group, key=_by_name)
            base = later << 61
            plan = plan_blocks([group[s] for s in order], [-(-lengths[s] // block_chars) for s in order])
            while rows := list(islice(plan, PLAN_BLOCKS)):
                i, k, r, d, slot = zip(*rows)
                columns = [pa.array([order[j] for j in i], keys[order[0]].type), pa.array(k, pa.int64())]
                columns += [pa.array([base + x for x in c], pa.int64()) for c in (r, d, slot)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"__source {kind}, __block long, release long, deadline long, slot long"
    return stage(sizes.coalesce(1).mapInArrow(run, schema), "plan")


def _units(df: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    """Equal rows (source, id and text) as one unit of their added length, in hashed order."""
    text_hash = F.xxhash64(text_col).alias("text_hash")
    size = F.coalesce(F.length(text_col), F.lit(0)).cast("long") + 1
    units = df.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), text_hash, size.alias("size"))
    units = units.groupBy("source", "id", "text_hash").agg(F.sum("size").alias("size"))
    return units.withColumn("at", F.xxhash64("id", "text_hash", F.lit(seed)))


def _with_starts(units: DataFrame) -> DataFrame:
    """Adds what precedes each unit in its source. A slice of the hashes is summed in one task, the
    slices' totals in a second step, so that a hot source is spread over all tasks."""
    count = max(1, units.count())
    bits = max(1, (count // SLICE_UNITS).bit_length())
    units = units.withColumn("slice", F.shiftright("at", 64 - bits))
    before = Window.partitionBy("source", "slice").orderBy("at", "id", "text_hash")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    totals = units.groupBy("source", "slice").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("__source"),
        F.col("slice").alias("__slice"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("__before"),
    )
    units = units.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    units = units.join(totals, F.col("source").eqNullSafe(F.col("__source")) & (F.col("slice") == F.col("__slice")))
    return units.withColumn("start", F.col("inside") + F.col("__before")).drop("__source", "__slice", "inside", "slice", "__before")


def mixing_positions(
    df: DataFrame,
    weights: dict | None = None,
    alpha: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    period: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """One row per distinct source, id and text: ``source``, ``id``, ``text_hash``, ``at``, ``block``,
    ``release``, ``deadline``, ``slot``.

    A source's texts, in an order hashed from id and text, are cut into blocks of ``block_chars``
    characters; a text belongs to the block in which it starts, so a very long one fills several.
    ``weights`` give each source's share of the mix in characters; without them a source of n
    characters weighs n to the power ``alpha``. Sources without a positive weight follow after all
    others, by their own sizes. A block's ``slot`` orders the mix: at every point each source is less
    than one block from its exact share of the slots, as long as it lasts; when it runs out its slots
    stay empty, which leaves the others' proportions as they are. No text is dropped or repeated. With
    ``period`` the weights are first rounded to whole slots of such a period.

    A NULL source is a source of its own, NULL texts are empty, NULL ids tell texts apart by their
    hash. An empty table gives no rows. Up to ``MAX_SOURCES`` sources: one task plans all blocks from
    their sizes. Slots are 64-bit numbers: a source's blocks over its share must stay below 2 to the 61.
    """
    units = stage(_units(df, id_col, source_col, text_col, seed), "units")
    sizes = stage(units.groupBy("source").agg(F.sum("size").alias("n")), "sizes")
    if sizes.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    plan = _plan(sizes, weights, alpha, block_chars, period)
    units = _with_starts(units).withColumn("block", F.floor(F.col("start") / block_chars).cast("long"))
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block"))
    return units.join(plan, same).select("source", "id", "text_hash", "at", "block", "release", "deadline", "slot")


def mix_documents(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """All rows of ``df``, columns as they were, in the order of the mix.

    Partitions hold consecutive ranges of the mix and are sorted, so that a table written from them
    reads in mixed order, file by file. Equal rows stay side by side.
    """
    places = mixing_positions(df, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    own = {c: unused(df, c) for c in ("source", "id", "text_hash", "at", "slot")}
    places = stage(places.select(*[F.col(c).alias(name) for c, name in own.items()]), "places")
    keys = (
        F.col(own["id"]).eqNullSafe(F.col(id_col))
        & F.col(own["source"]).eqNullSafe(F.col(source_col))
        & (F.col(own["text_hash"]) == F.xxhash64(text_col))
    )
    order = own["slot"], own["at"]
    return df.join(places, keys).repartitionByRange(*order).sortWithinPartitions(*order).select(*df.columns)
