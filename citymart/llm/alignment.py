"""Two tokenizers' ids aligned: their cumulative ends intersect, and common ends cut both lists into groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymart.llm.byte_level import ByteLevel
from citymart.llm.parts import Parts, cut_all, gathered, groups
from citymart.session import stage

#: Documents form a block until they have so many links; blocks meet the corpus-wide counts as a whole.
BLOCK_LINKS = 1 << 20
#: Texts are cut and looked up together up to so many bytes; new parts are aligned so many at a time.
GROUP_BYTES, TOGETHER = 4_000_000, 20_000
#: A worker knows so many parts at most; one takes about 120 bytes.
KNOWN_PARTS = 700_000


def byte_level_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer: its vocabulary spells each byte as one character, printable
    Latin-1 characters for their own bytes, the characters from 256 on for all other bytes in turn."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in own]
    spelt = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}
    vocabulary = tokenizer.get_vocab()
    found = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        found[i] = bytes(spelt[c] for c in token) if all(c in spelt for c in token) else token.encode()
    return found


def piece_bytes(processor) -> list[bytes]:
    """The bytes of every id of a sentence-piece model; U+2581 is a space, byte pieces are their byte."""
    return [
        bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()
        for i, piece in enumerate(processor.id_to_piece(list(range(processor.get_piece_size()))))
    ]


def common_ends(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets at which tokens of both lists end, and how many tokens of each end up to there. The offsets are looked
    up in a dictionary from ends to places for each list; their common keys, sorted, are the cuts."""
    a_ends = dict(zip(np.cumsum(a_sizes).tolist(), count(1)))
    b_ends = dict(zip(np.cumsum(b_sizes).tolist(), count(1)))
    cuts = sorted(a_ends.keys() & b_ends.keys())
    places = (np.fromiter(map(ends.__getitem__, cuts), np.int64, len(cuts)) for ends in (a_ends, b_ends))
    return np.array(cuts, np.int64), *places


def _listed(values: pa.Array, ends: np.ndarray, separator: str) -> pa.Array:
    """The values between one end and the next as one text each."""
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)
    return pc.binary_join(lists, pa.scalar(separator, values.type))


class Aligner:
    """Texts by both tokenizers, part by part."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece

        self.a = ByteLevel(a_file, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_bytes, self.b_bytes = byte_level_bytes(self.a.tokenizer), piece_bytes(self.b)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.digits = pa.array(list(map(str, range(max(len(self.a_sizes), len(self.b_sizes))))), pa.large_string())
        self.known = Parts(self.align, KNOWN_PARTS)

    def align(self, parts: list[str]) -> list[pa.Array]:
        """For each part whether both tokenizers give its bytes back, the numbers of A's ids, B's ids and groups, the
        groups as text, and the linked pairs as ``a * 2^32 + b``. Many parts are aligned at once: one after the other
        they are one text, and where a part ends, tokens of both end."""
        some = [self._together(parts[k : k + TOGETHER]) for k in range(0, max(1, len(parts)), TOGETHER)]
        return [pa.concat_arrays(column) for column in zip(*some)]

    def _together(self, parts: list[str]) -> list[pa.Array]:
        a = self.a.later_parts(parts)
        b = self.b.encode(parts, num_threads=1)
        n_a, n_b = a.value_lengths().to_numpy().astype(np.int64), np.array(list(map(len, b)), np.int64)
        a_ids = a.flatten().to_numpy().astype(np.int64)
        b_ids = np.fromiter(chain.from_iterable(b), np.int64)
        like = self._like(parts, a_ids, n_a, b_ids, n_b)
        if not like.all():  # the others are aligned without them, and they have no tokens
            a_ids, b_ids = a_ids[np.repeat(like, n_a)], b_ids[np.repeat(like, n_b)]
            n_a, n_b = n_a * like, n_b * like
        a_sizes, b_sizes = self.a_sizes[a_ids], self.b_sizes[b_ids]
        cuts, a_at, b_at = common_ends(a_sizes, b_sizes)
        slices = [_listed(self.digits.take(pa.array(ids)), at, ",") for ids, at in ((a_ids, a_at), (b_ids, b_at))]
        groups = pc.binary_join_element_wise(*slices, pa.scalar("|", pa.large_string()))
        bytes_up_to = np.append(0, np.cumsum(a_sizes))[np.cumsum(n_a)]
        ends = np.searchsorted(cuts, bytes_up_to, side="right")  # groups up to the end of each part
        # the ends of a group's ids differ but for the last of both, so each slice has one link
        links = (a_ids[a_at - 1] << 32) + b_ids[b_at - 1]
        counts = [pa.array(n) for n in (n_a, n_b, np.diff(ends, prepend=0))]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(links))
        return [pa.array(like), *counts, _listed(groups, ends, ";"), lists]

    def _like(self, parts: list[str], a_ids: np.ndarray, n_a: np.ndarray, b_ids: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether both tokenizers give back a space and the part; an empty part has no tokens."""
        raw = [f" {p}".encode() for p in parts]
        sizes = np.array(list(map(len, raw)), np.int64)
        text, like = b"".join(raw), sizes > 1
        for ids, n, table, lengths in ((a_ids, n_a, self.a_bytes, self.a_sizes), (b_ids, n_b, self.b_bytes, self.b_sizes)):
            spelt = list(map(table.__getitem__, ids.tolist()))
            ends = np.cumsum(n)
            of_part = np.diff(np.append(0, np.cumsum(lengths[ids]))[np.append(0, ends)])
            if not (of_part == sizes).all() or b"".join(spelt) != text:
                begins = (ends - n).tolist()
                like &= [b"".join(spelt[x:y]) == r for x, y, r in zip(begins, ends.tolist(), raw)]
        return like

    def texts(self, texts: pa.Array) -> Iterator[tuple[int, int, int, memoryview, np.ndarray]]:
        """``n_a``, ``n_b``, ``n_groups``, groups as text (UTF-8) and links of each text; none for NULL, empty and
        unlike ones."""
        for group in groups(texts, GROUP_BYTES):
            parts = cut_all(group)
            offsets = parts.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            rows, (like, *counts, words, pairs) = self.known.look_up(parts.flatten())
            sums = [np.add.reduceat(c.to_numpy()[rows], offsets[:-1]) for c in counts]
            alike = np.logical_and.reduceat(like.to_numpy(zero_copy_only=False)[rows], offsets[:-1])
            joined = _listed(words.take(pa.array(rows)), offsets[1:], ";")
            ends = np.frombuffer(joined.buffers()[1], np.int64, len(group) + 1).tolist()
            text = memoryview(joined.buffers()[2] or b"")
            links, at = gathered(rows, pairs)
            at = np.append(0, at)[offsets].tolist()
            for row, (good, *found) in enumerate(zip(alike.tolist(), *(s.tolist() for s in sums))):
                if good:
                    yield *found, text[ends[row] : ends[row + 1]], links[at[row] : at[row + 1]]
                else:  # parts may differ where the whole does not
                    _, *found, whole, one = self.align([group[row].as_py()])
                    yield *(n[0].as_py() for n in found), memoryview(whole[0].as_py().encode()), one.flatten().to_numpy()


@cache
def aligner(a_file: str, b_file: str) -> Aligner:
    """One per Python worker, kept between tasks."""
    return Aligner(a_file, b_file)


class Block:
    """Consecutive documents of a task, their links as places in one list of pairs."""

    def __init__(self, number: int, names: list[str], kinds: list[pa.DataType]):
        self.number, self.names, self.kinds = number, names, kinds
        self.rows: list[list] = []
        self.links: list[np.ndarray] = []
        self.size = 0

    def add(self, row: list, links: np.ndarray) -> None:
        self.rows.append(row)
        self.links.append(links)
        self.size += len(links)

    def batch(self) -> pa.RecordBatch:
        """A row for each document, and one with the pairs and how often the block has them."""
        lengths = [len(x) for x in self.links]
        pairs, at = np.unique(np.concatenate(self.links), return_inverse=True)
        keys = np.repeat(np.arange(len(lengths), dtype=np.int64) << 32, lengths) + at
        keys, times = np.unique(keys, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(lengths) + 1, dtype=np.int64) << 32)
        offsets = pa.array(np.append(cuts, cuts[-1]), pa.int32())  # the last row has none
        columns = [pa.array([*c, None], k) for c, k in zip(zip(*self.rows), self.kinds)]
        columns += [
            pa.array([self.number] * (len(lengths) + 1), pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array((keys & 0xFFFFFFFF).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
            pa.array([None] * len(lengths) + [pairs], pa.list_(pa.int64())),
            pa.array([None] * len(lengths) + [np.bincount(at, minlength=len(pairs))], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=self.names)


def _aligned(df: DataFrame, a_file: str, b_file: str, id_col: str, text_col: str, with_groups: bool) -> DataFrame:
    fields = {
        "id": df.schema[id_col].dataType.simpleString(),
        "n_a": "bigint",
        "n_b": "bigint",
        "n_groups": "bigint",
        "n_links": "bigint",
        "groups_sha256": "string",
    }
    if with_groups:
        fields["groups"] = "string"
    kept = len(fields)
    fields |= {"block": "bigint", "at": "array<int>", "times": "array<int>"}
    fields |= {"pairs": "array<bigint>", "pair_links": "array<bigint>"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, block = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            kinds = [batch.schema.field(0).type, *[pa.int64()] * 4, *[pa.string()] * (kept - 5)]
            for document, (*counts, text, links) in zip(batch.column(0), aligner(a_file, b_file).texts(batch.column(1))):
                block = block or Block((part << 32) + n, list(fields), kinds)
                digest = hashlib.sha256(text).hexdigest() if counts[0] else ""
                row = [document.as_py(), *counts, len(links), digest]
                block.add(row + [str(text, "utf-8")] * with_groups, links)
                if block.size >= BLOCK_LINKS or len(block.rows) >= BLOCK_LINKS >> 4:
                    yield block.batch()
                    n, block = n + 1, None
        if block:
            yield block.batch()

    return df.select(id_col, text_col).mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in fields.items()))


def align_documents(
    df: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents aligned, and the corpus-wide table of linked id pairs.

    The first has one row per row of ``df``: ``id_col``, ``n_a``, ``n_b`` (tokens by the byte-level tokenizer ``a_file`` of a
    space and the text, by the sentence-piece model ``b_file`` of the text, which adds the space), ``n_groups``
    (between common ends), ``n_links`` (token pairs that end together), ``n_best`` (links whose pair is no rarer than
    any other of its B id), ``count_sum`` (the pairs' counts over all links), ``groups_sha256`` and, if asked for,
    ``groups`` as ``a1,a2|b1;a3|b2,b3``. The second has ``a``, ``b``, ``links`` and ``best``.

    Texts that are NULL, empty, or whose bytes by either tokenizer are not those of a space and the text have no
    tokens: zeros and empty strings. Rows with a NULL or repeated id are documents like any other, other columns are
    ignored, empty tables give no rows. Ties in ``links`` are all ``best``.

    Words repeat, so each worker aligns a part of a text (up to the next space) once and looks it up afterwards.
    Documents of a task form blocks; a block's distinct pairs, not those of each document, meet the corpus-wide counts
    and go back to its documents. So what is shuffled are pairs of blocks, where a frequent pair counts once, and no
    table of pairs is sent to all executors unless Spark finds it small.
    """
    aligned = stage(_aligned(df, a_file, b_file, id_col, text_col, with_groups), "aligned")
    blocks = aligned.filter(F.col("pairs").isNotNull()).select("block", "pairs", "pair_links")
    totals = blocks.select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("p"))
    totals = totals.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_links").alias("links"))
    totals = stage(totals.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-counts")
    most = totals.groupBy("b").agg(F.max("links").alias("most"))  # a row for each id of B
    links = totals.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))
    links = stage(links, "pairs")
    looked_up = blocks.select("block", F.posexplode("pairs").alias("place", "pair")).join(links, "pair")
    looked_up = looked_up.select(F.col("block").alias("of"), "place", "links", "best")
    docs = aligned.filter(F.col("n_a").isNotNull()).drop("pairs", "pair_links")
    out = [c for c in docs.columns if c not in ("id", "block", "at", "times")]

    def count(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        links, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        place = pairs.column("place").to_numpy()
        links[place] = pairs.column("links").to_numpy()
        best[place] = pairs.column("best").to_numpy()
        at, times = (docs.column(c).combine_chunks() for c in ("at", "times"))
        row = np.repeat(np.arange(len(docs)), at.value_lengths().to_numpy())
        at, times = at.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        sums = []
        for values in (best, links):
            found = np.zeros(len(docs), np.int64)
            np.add.at(found, row, values[at] * times)
            sums.append(pa.array(found))
        return pa.table([docs.column(c) for c in ["id", *out]] + sums, names=["id", *out, "n_best", "count_sum"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema} | {"n_best": "bigint", "count_sum": "bigint"}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["id", *out, "n_best", "count_sum"])
    counted = docs.groupBy("block").cogroup(looked_up.groupBy("of")).applyInArrow(count, schema)
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)
    table = links.select(a.cast("int").alias("a"), b.cast("int").alias("b"), "links", "best")
    return counted.withColumnRenamed("id", id_col), table
