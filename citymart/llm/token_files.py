"""Token ids in files of directly addressable codes: any token is read by its place, without decoding others."""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citymart.llm.byte_level import byte_level

MAGIC = b"TOKCODE1"
#: Bits of a chunk, bits a rank counts over, tokens of a segment.
CHUNK_BITS, RANK_BITS, SEGMENT_TOKENS = 8, 512, 1 << 20
#: Documents a reader gives out at a time.
BATCH_DOCUMENTS = 4096
#: Places are matched with files by spans of so many tokens.
SPAN_TOKENS = 1 << 24

FILES = "part bigint, path string, tokens bigint, documents bigint"

# A file is a row of segments, a footer, the footer's length (8 bytes) and MAGIC. A segment holds up to
# SEGMENT_TOKENS ids in levels, then the documents that end in it (Arrow stream: id, end in the file). Level k
# holds bits 8k to 8k+7 of all ids that reach level k, one byte each; if there is a level k+1, then a bitmap of the ids
# that go on there, and the number of its ones before every 512th bit (4 bytes each). An id's place in level k+1
# is the rank of its bit. Segments are independent, so writers and readers hold one at a time.


def level_sizes(n: int, last: bool) -> tuple[int, int, int]:
    """Bytes of a level of ``n`` ids: chunks, bitmap, ranks."""
    if last:
        return n, 0, 0
    blocks = -(-n // RANK_BITS)
    return n, blocks * (RANK_BITS // 8), 4 * blocks


def encode_levels(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Number of ids in each level, and the levels' bytes."""
    counts, parts, rest = [], [], ids.astype(np.uint32)
    while True:
        counts.append(len(rest))
        parts.append((rest & 0xFF).astype(np.uint8).tobytes())
        more = rest > 0xFF
        if not more.any():
            return counts, b"".join(parts)
        bitmap = np.zeros(-(-len(rest) // RANK_BITS) * RANK_BITS, bool)
        bitmap[: len(rest)] = more
        ones = bitmap.reshape(-1, RANK_BITS).sum(axis=1)
        parts.append(np.packbits(bitmap, bitorder="little").tobytes())
        parts.append((np.cumsum(ones) - ones).astype("<u4").tobytes())
        rest = rest[more] >> CHUNK_BITS


def decode_levels(counts: list[int], data: bytes) -> np.ndarray:
    """All ids of a segment, from the last level up."""
    at, levels = 0, []
    for k, n in enumerate(counts):
        chunks, bitmap, ranks = level_sizes(n, k == len(counts) - 1)
        levels.append((np.frombuffer(data, np.uint8, chunks, at), np.frombuffer(data, np.uint8, bitmap, at + chunks)))
        at += chunks + bitmap + ranks
    ids = np.zeros(0, np.uint32)
    for chunk, bitmap in reversed(levels):
        above, ids = ids, chunk.astype(np.uint32)
        if len(bitmap):
            ids[np.unpackbits(bitmap, count=len(chunk), bitorder="little").astype(bool)] |= above << CHUNK_BITS
    return ids


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of an address as Spark writes it, and the path in it."""
    if path.startswith("file:") or "://" not in path:
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


class CodeWriter:
    """Writes one file; ``ids`` and documents are added in their order."""

    def __init__(self, path: str, id_type: pa.DataType):
        self.filesystem, self.path = _filesystem(path)
        self.schema = pa.schema([("id", id_type), ("end", pa.int64())])
        self.segments, self.offset, self.tokens, self.written = [], 0, 0, 0
        self.pending: list[np.ndarray] = []
        self.documents: list[tuple[pa.Scalar, int]] = []
        self.out = None

    def add(self, document: pa.Scalar, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.tokens += len(ids)
        self.documents.append((document, self.tokens))
        if self.tokens - self.written >= SEGMENT_TOKENS:
            self._flush(SEGMENT_TOKENS)

    def _flush(self, least: int) -> None:
        if not self.out:
            self.filesystem.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
            self.out = self.filesystem.open_output_stream(self.path)
        ids, at = np.concatenate(self.pending), 0
        while at < len(ids) and len(ids) - at >= least:
            self._segment(ids[at : at + SEGMENT_TOKENS])
            at += SEGMENT_TOKENS
        self.pending = [ids[at:]]

    def _segment(self, ids: np.ndarray) -> None:
        counts, data = encode_levels(ids)
        first, self.written = self.written, self.written + len(ids)
        ended = next((k for k, (_, end) in enumerate(self.documents) if end > self.written), len(self.documents))
        directory = io.BytesIO()
        documents, self.documents = self.documents[:ended], self.documents[ended:]
        columns = [
            pa.array([d.as_py() for d, _ in documents], self.schema.field(0).type),
            pa.array([e for _, e in documents], pa.int64()),
        ]
        with pa.ipc.new_stream(directory, self.schema) as stream:
            stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.out.write(data)
        self.out.write(directory.getvalue())
        self.segments.append([first, self.offset, counts, len(data), directory.tell()])
        self.offset += len(data) + directory.tell()

    def close(self) -> None:
        self._flush(0)
        footer = json.dumps({"tokens": self.tokens, "segments": self.segments}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()


class CodeReader:
    """One file: all its documents in turn, or any token by its place."""

    def __init__(self, path: str):
        filesystem, inner = _filesystem(path)
        self.file = filesystem.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is no file of token codes")
        length = int.from_bytes(tail[:8], "little")
        footer = json.loads(self.file.read_at(length, size - 16 - length))
        self.tokens, self.segments = footer["tokens"], footer["segments"]
        self.firsts = [s[0] for s in self.segments]

    def token(self, place: int) -> int:
        """The id at a place in the file: for each of its levels one byte, one rank and the bits behind it are read."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        segment = int(np.searchsorted(self.firsts, place, side="right")) - 1
        first, at, counts, _, _ = self.segments[segment]
        value, shift, place = 0, 0, place - first
        for k, n in enumerate(counts):
            chunks, bitmap, ranks = level_sizes(n, k == len(counts) - 1)
            value |= self.file.read_at(1, at + place)[0] << shift
            if not bitmap:
                break
            block, bit = divmod(place, RANK_BITS)
            bits = int.from_bytes(self.file.read_at(RANK_BITS // 8, at + chunks + block * (RANK_BITS // 8)), "little")
            if not bits >> bit & 1:
                break
            before = int.from_bytes(self.file.read_at(4, at + chunks + bitmap + 4 * block), "little")
            place = before + (bits & ((1 << bit) - 1)).bit_count()
            at += chunks + bitmap + ranks
            shift += CHUNK_BITS
        return value

    def documents(self) -> Iterator[tuple[pa.Scalar, int, list[np.ndarray]]]:
        """Id, first place in the file and ids, in pieces of one segment each, of every document."""
        begin, held = 0, []
        for first, at, counts, size, directory in self.segments:
            ids = decode_levels(counts, self.file.read_at(size, at))
            table = pa.ipc.open_stream(self.file.read_at(directory, at + size)).read_all()
            for document, end in zip(table.column(0), table.column(1).to_pylist()):
                held.append(ids[max(0, begin - first) : end - first])
                yield document, begin, held
                begin, held = end, []
            held.append(ids[max(0, begin - first) :])


def write_token_files(
    df: DataFrame, folder: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the ids of all documents to files in ``folder``, in ascending order of ``id_col``; one row per file:
    ``part``, ``path``, ``base`` (tokens of all files before it), ``tokens``, ``documents``.

    A document's ids are those of its text (NULL: empty) and ``end_id``. Documents with a NULL id come first; those of
    one id are ordered by a hash of their texts, then by their place in the input. Other columns are ignored. An empty
    table writes no files.

    Documents are dealt in ranges of that order, by place within one id too, so no id fills a task; each task writes
    one file, a segment at a time. A task that is repeated writes a file of its own, and the list of files, itself a table in
    ``folder``/manifest, names those of the attempts that count.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    order = ["id", "hash", "place"]
    docs = df.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    docs = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, documents = TaskContext.get().partitionId(), None, 0
        path = f"{folder}/files/part-{part:08d}-{uuid.uuid4().hex}.codes"
        end = np.array([end_id], "<u4")
        for batch in batches:
            for document, ids in zip(batch.column(0), byte_level(tokenizer_file).ids(batch.column(1))):
                writer = writer or CodeWriter(path, batch.schema.field(0).type)
                writer.add(document, np.append(ids, end))
                documents += 1
        if writer:
            writer.close()
            columns = [pa.array([part], pa.int64()), pa.array([path])]
            columns += [pa.array([n], pa.int64()) for n in (writer.tokens, documents)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "path", "tokens", "documents"])

    docs.mapInArrow(write, FILES).write.parquet(f"{folder}/manifest")
    return token_files(spark, folder)


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files that ``write_token_files`` wrote to ``folder``, with the number of tokens before each."""
    files = spark.read.schema(FILES).parquet(f"{folder}/manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    base = F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    return files.select("part", "path", base, "tokens", "documents")


def read_token_files(files: DataFrame, id_type: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``id_col``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` (of all ids as little-endian
    unsigned 32-bit numbers) and, if asked for, ``ids`` of every document in ``files``. One task reads one file,
    a segment at a time."""
    fields = {id_col: id_type, "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    if with_ids:
        fields["ids"] = "array<bigint>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for document, begin, pieces in CodeReader(path).documents():
                    crc = 0
                    for piece in pieces:
                        crc = zlib.crc32(piece, crc)
                    row = [document, base + begin, sum(map(len, pieces)), crc]
                    rows.append(row + [np.concatenate(pieces)] * with_ids)
                    if len(rows) == BATCH_DOCUMENTS:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array([d.as_py() for d in columns[0]], columns[0][0].type)]
        arrays += [pa.array(c, pa.int64()) for c in columns[1:4]]
        if with_ids:
            arrays.append(pa.array(columns[4], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(arrays, names=list(fields))

    spread = files.select("path", "base").repartition(max(1, files.count()))
    return spread.mapInArrow(read, ", ".join(f"`{n}` {k}" for n, k in fields.items()))


def read_tokens(files: DataFrame, places: DataFrame, place_col: str = "place") -> DataFrame:
    """``places`` and ``token``: the id at each place in the order of all files, read by its address; NULL where the
    place is NULL or beyond the ids. A column ``token`` of ``places`` is replaced. Repeated places are rows of their own."""
    span = lambda c: F.floor(c / SPAN_TOKENS).cast("long")
    last = F.col("base") + F.col("tokens") - 1
    touched = F.explode(F.sequence(span(F.col("base")), span(last))).alias("span")
    spans = files.select("path", "base", last.alias("last"), touched)
    kept = [c for c in places.columns if c.lower() != "token"]
    asked = places.select(F.struct(*[places[c] for c in kept]).alias("row"), places[place_col].cast("long").alias("at"))
    inside = (span(asked.at) == spans.span) & asked.at.between(spans.base, spans.last)
    found = asked.join(spans, inside, "left").select("row", "path", (F.col("at") - F.col("base")).alias("at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            tokens = []
            for path, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if path and path != name:
                    name, reader = path, CodeReader(path)
                tokens.append(reader.token(at) if path else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64())], names=["row", "token"])

    kind = found.schema["row"].dataType.simpleString()
    read_out = found.sortWithinPartitions("path", "at").mapInArrow(read, f"row {kind}, token bigint")
    return read_out.select("row.*", "token")
