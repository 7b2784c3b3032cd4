"""Packing documents into sequences: shortest-pack-first over the histogram of piece lengths."""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymart.session import stage

#: Texts are tokenised in groups of about so many characters.
GROUP_CHARS = 4_000_000
#: A worker forgets the ids of known words beyond so many; they take about 150 bytes each.
KNOWN_WORDS = 700_000

_PUNCTUATION = string.punctuation.encode()


def _is_letters(core: bytes) -> bool:
    """Letters, of which the last is one after the tokenizer's normalising too. Else, as in U+09DF or
    U+0130, it leaves a mark that the tokenizer joins with punctuation behind it."""
    if core.isalpha():  # ASCII
        return True
    text = core.decode()
    return text.isalpha() and unicodedata.normalize("NFC", text).lower()[-1].isalpha()


class WordIds(dict):
    """Token ids (in ``kind``'s bytes) of space-separated words, learnt as they come.

    The tokenizer never joins across white space, so a text's ids are those of its words in turn. A
    word seen for the first time gets an empty entry that ``learn`` fills for all new words at once.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.new: dict[bytes, bytearray] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def __missing__(self, word: bytes) -> bytearray:
        ids = self.new.get(word)
        if ids is None:
            ids = self.new[word] = bytearray()
        return ids

    def parts(self, text: str) -> list[bytes | bytearray]:
        raw = text.encode()
        if b"<|" not in raw:  # special tokens are known in lower case only
            raw = raw.lower()
        return list(map(self.__getitem__, raw.replace(b"\n", b" ").split(b" ")))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, self.kind) for f in found]

    def learn(self) -> None:
        """Fill all entries that ``parts`` opened. A word of letters and trailing punctuation has the
        ids of the letters and of the punctuation as a whole, so only its parts are encoded; all other
        words are encoded whole."""
        odd, cores, composed, todo = {}, {}, [], self.new
        while todo:
            self.new = {}
            for word, ids in todo.items():
                core = word.rstrip(_PUNCTUATION)
                if not _is_letters(core):
                    odd[word] = ids
                elif len(core) == len(word):
                    cores[word] = ids
                else:
                    composed.append((word, ids, core, word[len(core) :]))
            for _, _, core, tail in composed:  # opens entries for parts not seen yet
                for part in (core, tail):
                    if part not in cores and part not in odd:
                        self[part]
            todo = self.new
        self.new = {}
        if cores:
            words = [w.decode() for w in cores]
            ids = self._encode([" ".join(words)])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(words):  # each word ends once
                raw, at = ids.tobytes(), [0, *(ids.itemsize * cuts).tolist()]
                for entry, start, end in zip(cores.values(), at, at[1:]):
                    entry += raw[start:end]
            else:
                odd.update(cores)
        for entry, ids in zip(odd.values(), self._encode([w.decode() for w in odd])):
            entry += ids.tobytes()
        for learnt in (cores, odd):
            self.update((word, bytes(ids)) for word, ids in learnt.items())
        for word, ids, core, tail in composed:
            ids += self[core] + self[tail]
            self[word] = bytes(ids)

    def trim(self) -> None:
        if len(self) > KNOWN_WORDS:
            self.clear()


@cache
def word_ids(file: str) -> WordIds:
    """One per Python worker, kept between tasks."""
    return WordIds(file)


def token_ids(texts: pa.Array, file: str) -> Iterator[np.ndarray]:
    """The ids of each text; NULL counts as empty."""
    known, chars, parts = word_ids(file), 0, []

    def learnt() -> Iterator[np.ndarray]:
        known.learn()
        for part in parts:
            yield np.frombuffer(b"".join(part), known.kind)
        known.trim()

    for item in texts:
        text = item.as_py() or ""
        chars += len(text) + 1
        parts.append(known.parts(text))
        if chars >= GROUP_CHARS:
            yield from learnt()
            chars, parts = 0, []
    yield from learnt()


def token_pieces(
    df: DataFrame, tokenizer_file: str, id_col: str, text_col: str, size: int, end_id: int, with_ids: bool,
    order: tuple[str, str] | None = None,
) -> DataFrame:
    """The pieces of every document: whole multiples of ``size`` and the rest, with the task that cut
    them and their rank among that task's pieces of equal length. With ``order``, a file and a row in
    it, also these, and ranks are those in a chunk: consecutive rows of a file, known by the first."""
    kind = df.schema[id_col].dataType.simpleString()
    fields = {
        id_col: kind,
        "start": "bigint",
        "length": "bigint",
        "ids_crc32": "bigint",
        "doc_tokens": "bigint",
        "task": "int",
        "rank_in_task": "bigint",
    }
    if order:
        fields |= {"file": "string", "row": "bigint", "chunk": "bigint"}
    if with_ids:
        fields["ids"] = "array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        last, chunk = None, 0
        for batch in batches:
            rows, chunks = batch.column(3).to_pylist() if order else [], []
            files = batch.column(2).to_pylist() if order else []
            taken, starts, lengths, sums, totals, ranks, ids = [], [], [], [], [], [], []
            for row, tokens in enumerate(token_ids(batch.column(1), tokenizer_file)):
                tokens = np.append(tokens.astype("<u4"), np.array([end_id], "<u4"))
                total = len(tokens)
                if order:
                    if last != (files[row], rows[row] - 1):
                        chunk, seen = rows[row], [0] * (size + 1)
                    last = files[row], rows[row]
                for start in range(0, total, size):
                    piece = tokens[start : start + size]
                    length = len(piece)
                    taken.append(row)
                    chunks.append(chunk)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
                    ranks.append(seen[length])
                    seen[length] += 1
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            columns = [batch.column(0).take(pa.array(taken, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            columns += [pa.array([task] * len(taken), pa.int32()), pa.array(ranks, pa.int64())]
            if order:
                columns += [batch.column(c).take(pa.array(taken, pa.int64())) for c in (2, 3)]
                columns.append(pa.array(chunks, pa.int64()))
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=list(fields))

    return df.select(id_col, text_col, *(order or ())).mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in fields.items()))


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns as (number of packs, lengths in a pack), each pack's lengths adding up to ``size`` at most.

    Longest lengths come first; each goes to the packs with most room left, which are the shortest
    ones. Where nothing has room, as many packs are opened as the tokens still to come need beyond
    the room that open packs have. Work follows the number of lengths, not of documents.
    """
    room: dict[int, list[list]] = {}  # room left -> [packs, lengths]
    left = sum(n * c for n, c in counts.items())
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        todo = counts[length]
        while todo:
            most = max(room, default=0)
            if most < length:
                free = sum(r * entry[0] for r, entries in room.items() for entry in entries)
                n = min(todo, max(1, -(-(left - free) // size)))
                lengths = (length,)
                most = size
            else:
                entry = room[most][-1]
                n = min(todo, entry[0])
                lengths = (*entry[1], length)
                entry[0] -= n
                if not entry[0]:
                    room[most].pop()
                    if not room[most]:
                        del room[most]
            room.setdefault(most - length, []).append([n, lengths])
            todo -= n
            left -= n * length
    return [(n, lengths) for entries in room.values() for n, lengths in entries]


def _places(patterns: list[tuple[int, tuple[int, ...]]], shift: int) -> tuple[np.ndarray, ...]:
    """For every slot of every pattern: length and first rank as one key, first sequence, offset."""
    next_rank: dict[int, int] = {}
    rows, base = [], 0
    for n, lengths in patterns:
        offset = 0
        for length in lengths:
            first = next_rank.get(length, 0)
            rows.append(((length << shift) + first, base, offset))
            next_rank[length] = first + n
            offset += length
        base += n
    rows.sort()
    keys, bases, offsets = (np.array(c, np.int64) for c in zip(*rows))
    return keys, bases, offsets


def pack_documents(
    df: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
    order: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and, if asked for, the token ``ids``.

    A document's tokens are those of its text (NULL: empty) and ``end_id``. Pieces are cut at
    multiples of ``size``; each token lies in exactly one piece, each sequence is filled from 0
    without gaps, up to ``size`` tokens. Rows with a NULL or repeated id are documents like any
    other. Other columns are ignored. An empty table gives no rows.

    Only the histogram of lengths (``size`` rows at most) comes to the driver; the patterns made from
    it go back as a table of similar size, and every piece finds its place by its rank among the
    pieces of its length. Ranks are counted per task and summed over tasks, so that no length, however
    frequent, is gathered anywhere.

    ``order`` names two columns, a file's name and a row's number in it, that place the documents. Then
    pieces of equal length are packed in this order, and sequences are numbered by their first piece's
    place. Else their order means nothing.
    """
    pieces = stage(token_pieces(df, tokenizer_file, id_col, text_col, size, end_id, with_ids, order), "pieces")
    cut = ["file", "chunk"] if order else ["task"]
    counts = pieces.groupBy(*cut, "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        *[F.col(c).alias(f"__{c}") for c in cut],
        F.col("length").alias("__length"),
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"),
    )
    before = stage(before, "ranks")
    histogram = {r[0]: r[1] for r in before.groupBy("__length").agg(F.sum("n")).collect()}
    out = pieces.columns[:5] + ["sequence_id", "offset"] + ["ids"] * with_ids
    wanted, out = out, out + (["file", "row"] if order else [])
    ranked = pieces.join(before, [F.col(c) == F.col(f"__{c}") for c in [*cut, "length"]])
    ranked = ranked.select(*pieces.columns[:5], (F.col("rank_in_task") + F.col("__before")).alias("rank"), *out[7:])
    if not histogram:
        return ranked.withColumn("sequence_id", F.col("rank")).withColumn("offset", F.col("rank")).select(*wanted)
    shift = 63 - size.bit_length()
    keys, bases, offsets = _places(pack_histogram(histogram, size), shift)
    starts = keys & ((1 << shift) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << shift) + rank, side="right") - 1
            columns = [batch.column(c) for c in out[:5]]
            columns += [pa.array(bases[at] + rank - starts[at]), pa.array(offsets[at])]
            columns += [batch.column(c) for c in out[7:]]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema} | {"sequence_id": "bigint", "offset": "bigint"}
    packed = ranked.mapInArrow(place, ", ".join(f"`{c}` {kinds[c]}" for c in out))
    return _in_order(stage(packed, "packed")).select(*wanted) if order else packed


def _in_order(packed: DataFrame) -> DataFrame:
    """The sequences numbered by the least place of their pieces: sorted in ranges, counted in each."""
    first = packed.groupBy("sequence_id").agg(F.min(F.struct("file", "row", "start")).alias("at"))
    first = first.select("sequence_id", "at.*").repartitionByRange("file", "row", "start")
    first = first.sortWithinPartitions("file", "row", "start").select("sequence_id")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.num_rows
            columns = [batch.column(0), pa.array([part] * size, pa.int32()), pa.array(range(n, n + size), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["__sequence", "part", "__n"])
            n += size

    numbers = stage(first.mapInArrow(number, "__sequence bigint, part int, __n bigint"), "numbers")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = numbers.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__base"))
    numbers = numbers.join(parts, "part").select("__sequence", (F.col("__n") + F.col("__base")).alias("__number"))
    packed = packed.join(numbers, F.col("sequence_id") == F.col("__sequence"))
    return packed.withColumn("sequence_id", F.col("__number"))
