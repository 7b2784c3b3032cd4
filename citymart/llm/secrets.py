"""Secrets in texts and in what the texts encode: a worklist of decoded layers, spans mapped back."""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
#: A compressed layer that unpacks to more bytes than this is counted in ``too_large``, not opened.
MAX_LAYER_BYTES = 1 << 28

_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: What every match of the above contains; cheap to look for.
_ASSIGN_HINT = re.compile(r"""[dDtTnNyY]["']?\x20*[:=]""")
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")
_PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})+")
_ONE_ESCAPE = re.compile(r"\\[uUx]\{?([0-9A-Fa-f]+)\}?")
#: Bytes of which some are percent codes, or escapes as in a literal of bytes; other characters stand for themselves.
_PERCENT_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!#$&-;=?-~]+)+")
_PERCENT_BYTE = re.compile(r"%([0-9A-Fa-f]{2})()|.", re.S)
_ESCAPED_BYTES = re.compile(r"(?:\\(?:x[0-9A-Fa-f]{2}|u00[0-9A-Fa-f]{2}|[abfnrtv0\\'\"])|[\x20-\x5b\x5d-\x7e]+)+")
_ESCAPED_BYTE = re.compile(r"\\x(..)|\\u00(..)|\\.|.", re.S)
#: What compressed data begins with, of which some is encoded.
_ENCODED_MAGIC = re.compile(r"(?i:(?:%|\\x|\\u00)(?:8b|01|5e|9c|da|fd|b5|42))|x\^|BZh[1-9]1AY")
_SHORT_ESCAPES = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "0": "\0"}
_BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of a value that goes on in the next line.
_WRAPPED = re.compile("(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+\r?\n)+[A-Za-z0-9+/_-]+={0,2}")
_MAGIC = re.compile(rb"\x1f\x8b|x|BZh|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: With other bytes before it; the first bytes of zlib that are in use.
_INNER_MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: The shortest secret, or token that is decoded, has so many ASCII characters.
_ROOM = re.compile(rb"[\x20-\x7e]{16,}")
_BAD_BYTE = re.compile("[\udc80-\udcff]")
_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f\x80-\x9f]")

#: Input is unpacked so many bytes at a time, at first few: most of what looks like a beginning is none.
FIRST_CHUNK, CHUNK, ZSTD_CHUNK = 1 << 12, 1 << 16, 1 << 10
#: A decoder's own memory, which the data asks for.
LZMA_BYTES = 1 << 28
_PADDING, _ZSTD = re.compile(rb"\0*"), b"\x28\xb5\x2f\xfd"

#: A text with the beginning and the end, in the whole text, of what each character was decoded from. Both are
#: arrays, two numbers where all characters stand for one token, or None in the whole text itself.
Layer = tuple[str, "np.ndarray | int | None", "np.ndarray | int | None"]


def _place(layer: Layer, start: int, end: int) -> tuple[int, int]:
    """Where a part of a layer stands in the whole text."""
    _, starts, ends = layer
    if starts is None:
        return start, end
    if isinstance(starts, int):
        return starts, ends
    return int(starts[start]), int(ends[end - 1])


def scan(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the secrets visible in ``text``, leftmost first within each kind."""
    found = []
    if _ASSIGN_HINT.search(text):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _replaced(layer: Layer, pieces: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
    """The layer with parts replaced; a piece is start, end, new text and each new character's source."""
    text, starts, ends = layer
    if isinstance(starts, int):
        texts, at = [], 0
        for start, end, new, _ in pieces:
            texts += [text[at:start], new]
            at = end
        return "".join([*texts, text[at:]]), starts, ends
    if starts is None:
        starts = np.arange(len(text))
        ends = starts + 1
    texts, new_starts, new_ends, at = [], [], [], 0
    for start, end, new, sources in pieces:
        texts += [text[at:start], new]
        new_starts += [starts[at:start], np.array([starts[a] for a, _ in sources], np.int64)]
        new_ends += [ends[at:start], np.array([ends[b - 1] for _, b in sources], np.int64)]
        at = end
    texts.append(text[at:])
    return "".join(texts), np.concatenate([*new_starts, starts[at:]]), np.concatenate([*new_ends, ends[at:]])


def _text(data: bytes) -> str:
    """``data`` as text, U+FFFD for every byte that is not UTF-8."""
    return _BAD_BYTE.sub("\ufffd", data.decode(errors="surrogateescape"))


def _percent(layer: Layer, too_large: list[tuple[int, int]]) -> list[Layer]:
    if "%" not in layer[0]:
        return []
    pieces, out = [], []
    for m in _PERCENT.finditer(layer[0]):
        at, sources = m.start(), []
        for char in bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape"):
            sources.append((at, at + 3 * len(char.encode(errors="surrogateescape"))))
            at = sources[-1][1]
        pieces.append((m.start(), m.end(), _text(bytes.fromhex(m[0].replace("%", ""))), sources))
    for m in _PERCENT_BYTES.finditer(layer[0]) if _ENCODED_MAGIC.search(layer[0]) else ():
        if "%" in m[0] and _ENCODED_MAGIC.search(m[0]):
            out += _packed_parts(layer, m.start(), _PERCENT_BYTE.finditer(m[0]), too_large)
    return ([_replaced(layer, pieces)] if pieces else []) + out


def _escapes(layer: Layer, too_large: list[tuple[int, int]]) -> list[Layer]:
    if "\\" not in layer[0]:
        return []
    pieces, out = [], []
    for m in _ESCAPE.finditer(layer[0]):
        chars, sources, high = [], [], None
        for one in _ONE_ESCAPE.finditer(m[0]):
            code, span = int(one[1], 16), (m.start() + one.start(), m.start() + one.end())
            if high and 0xDC00 <= code < 0xE000:
                chars[-1] = chr(0x10000 + ((high - 0xD800) << 10) + code - 0xDC00)
                sources[-1] = (sources[-1][0], span[1])
                high = None
                continue
            high = code if 0xD800 <= code < 0xDC00 else None
            chars.append(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd")
            sources.append(span)
        pieces.append((m.start(), m.end(), "".join(chars), sources))
    for m in _ESCAPED_BYTES.finditer(layer[0]) if _ENCODED_MAGIC.search(layer[0]) else ():
        if "\\" in m[0] and _ENCODED_MAGIC.search(m[0]):
            out += _packed_parts(layer, m.start(), _ESCAPED_BYTE.finditer(m[0]), too_large)
    return ([_replaced(layer, pieces)] if pieces else []) + out


def _unpacker(data: memoryview):
    """What unpacks data that begins like this; None if nothing does. Looks at the first bytes only."""
    head = bytes(data[:8])
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31) if head[2:3] in (b"", b"\x08") and not (head[3:4] or b"\0")[0] & 0xE0 else None
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj() if _is_deflate(head[2:]) else None
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=LZMA_BYTES)
    if head[:4] == _ZSTD:
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _is_deflate(head: bytes) -> bool:
    """Whether a first block can begin with these bytes: a stored one repeats its length, negated; one with codes of
    its own has at most 286 symbols and 30 distances."""
    kind = head[0] >> 1 & 3
    if kind == 0 and len(head) >= 5:
        return int.from_bytes(head[1:3], "little") ^ int.from_bytes(head[3:5], "little") == 0xFFFF
    if kind == 2 and len(head) >= 2:
        return head[0] >> 3 <= 29 and head[1] & 31 <= 29
    return kind != 3


def _member(unpacker, data: memoryview, most: int) -> tuple[bytes, int]:
    """One member unpacked, and how many bytes it takes. Stops beyond ``most`` bytes of output."""
    out, size, at = [], 0, 0
    zstd = data[:4] == _ZSTD
    while at < len(data) and not unpacker.eof and size <= most:
        chunk = data[at : at + (ZSTD_CHUNK if zstd else CHUNK if at else FIRST_CHUNK)]
        # a block of zstd is 128 KB at most
        out.append(unpacker.decompress(chunk) if zstd else unpacker.decompress(chunk, most + 1 - size))
        size, at = size + len(out[-1]), at + len(chunk)
    return b"".join(out), at - (len(unpacker.unused_data) if unpacker.eof else 0)


def _unpack(data: memoryview) -> tuple[bytes, int] | None:
    """``data`` unpacked once, all its members and frames, and how many bytes they take; None if it is
    not compressed. What follows the last whole member is left. Raises ValueError if too large."""
    out, size, at = [], 0, 0
    while at < len(data):
        at = _PADDING.match(data, at).end() if out else at
        if (unpacker := _unpacker(data[at:])) is None:
            break
        try:
            part, taken = _member(unpacker, data[at:], MAX_LAYER_BYTES - size)
        except (zlib.error, OSError, EOFError, MemoryError, lzma.LZMAError, zstandard.ZstdError):
            break
        size += len(part)
        if size > MAX_LAYER_BYTES:
            raise ValueError("layer too large")
        out.append(part)
        at += taken
    return (out[0] if len(out) == 1 else b"".join(out), at) if out else None


def _packed(data: bytes, too_large: list[tuple[int, int]], place) -> list[tuple[str, int, int]]:
    """The texts of compressed data in ``data`` and where it stands there.

    Compressed layers inside each other are unwrapped until nothing is compressed or the same bytes
    come again. ``place`` gives the span in the text of those that are too large. What only looks like a beginning is
    told by its first bytes, without a copy of what follows."""
    out, at, whole = [], 0, memoryview(data)
    while m := (_MAGIC.match(data, at) if at == 0 else None) or _INNER_MAGIC.search(data, at):
        start, at, seen = m.start(), m.start() + 1, set()
        inner, used = whole[start:], None
        try:
            while (found := _unpack(inner)) is not None:
                used = used or found[1]
                if found[0] in seen:
                    break
                seen.add(found[0])
                inner = memoryview(found[0])
        except ValueError:
            too_large.append(place(start, start + used if used else len(data)))
            at = start + used if used else len(data)
            continue
        if used:
            at = start + used
            if found is None and len(inner):
                out.append((_text(bytes(inner)), start, at))
    return out


def _packed_parts(layer: Layer, base: int, parts: Iterable[re.Match], too_large: list[tuple[int, int]]) -> list[Layer]:
    """Compressed data among bytes that stand one by one in the text, from ``base`` on: codes in the matches' groups,
    short escapes and characters that stand for themselves."""
    data, ends = bytearray(), array("q", [base])
    for p in parts:
        code = p[1] or p[2]
        data.append(int(code, 16) if code else ord(_SHORT_ESCAPES.get(p[0][1:], p[0][-1])))
        ends.append(base + p.end())

    def place(a: int, b: int) -> tuple[int, int]:
        return _place(layer, ends[a], ends[b])

    return [(new, *place(a, b)) for new, a, b in _packed(bytes(data), too_large, place)]


def _base64(layer: Layer, too_large: list[tuple[int, int]]) -> list[Layer]:
    """What every token decodes to, as text or as compressed text, as layers of their own.

    All characters of a layer stand for the whole token. A token may begin with something else, such as
    a path, so it is decoded from each of its first four characters on; lines of one value are joined.
    Text in which bytes are not text is kept if it has room for a secret or another layer."""
    text, out = layer[0], []
    for m in chain(_BASE64.finditer(text), _WRAPPED.finditer(text)):
        a, b = _place(layer, *m.span())
        whole = m[0].replace("\r", "").replace("\n", "").rstrip("=").replace("-", "+").replace("_", "/")
        closed: list[tuple[int, int]] = []
        for skip in range(4):
            token = whole[skip:]
            token = token[:-1] if len(token) % 4 == 1 else token
            data = base64.b64decode(token + "=" * (-len(token) % 4))
            news = [new for new, _, _ in _packed(data, closed, lambda *_: (a, b))]
            if _ROOM.search(data) or skip == 0 and _plain(data):
                news.append(_text(data))
            out += [(new, a, b) for new in news]
        too_large += closed[:1]
    return out


def _plain(data: bytes) -> bool:
    try:
        return not _CONTROL.search(data.decode())
    except UnicodeDecodeError:
        return False


def _search(text: str) -> tuple[list[tuple[str, int, int, bool]], list[tuple[int, int]]]:
    """As ``find``, with the spans of the layers left closed."""
    base = scan(text)
    spans = dict.fromkeys(base, True)
    too_large, todo, seen = [], [(text, None, None)], set()
    while todo:
        layer = todo.pop()
        for new in _percent(layer, too_large) + _escapes(layer, too_large) + _base64(layer, too_large):
            mark = (hash(new[0]), len(new[0]), *_place(new, 0, len(new[0]))) if new[0] else None
            if mark is None or mark in seen:
                continue
            seen.add(mark)
            todo.append(new)
            for kind, start, end in scan(new[0]):
                spans.setdefault((kind, *_place(new, start, end)), False)
    return sorted(
        ((kind, start, end, of_base) for (kind, start, end), of_base in spans.items()),
        key=lambda s: (s[1], KINDS.index(s[0]), s[2]),
    ), sorted(set(too_large))


def find(text: str) -> tuple[list[tuple[str, int, int, bool]], int]:
    """Kind, start, end and base of all secrets by start, kind and end, and the layers left closed.

    ``base`` secrets stand in the text itself; the others were found in a layer decoded from it and
    carry the span of what they were decoded from. Layers are decoded until nothing new comes; a
    layer equal to an earlier one of the same place is not opened again.
    """
    spans, closed = _search(text)
    return spans, len(closed)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``secrets`` (array of kind, start, end, base), ``too_large``.

    Offsets count code points, ends are exclusive. NULL texts have no secrets. NULL and repeated ids
    are kept as they are, other columns are ignored, an empty table gives no rows. Rows are scanned
    one by one in their task, without a shuffle.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = [id_col, "secrets", "too_large"]
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t.as_py() or "") for t in batch.column(1)]
            rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans] for spans, _ in found]
            columns = [batch.column(0), pa.array(rows, pa.list_(struct)), pa.array([n for _, n in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {kind}, secrets array<struct<kind:string,start:bigint,end:bigint,base:boolean>>, too_large bigint"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def _joined(secrets: Column) -> Column:
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda k: k == kind


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base secrets by kind, the checksum of their spans, and all spans, as text."""
    base = F.filter("secrets", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        id_col, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"), "too_large"
    )


def mask(text: str, spans: list[tuple[str, int, int, bool]], mark: str) -> str:
    """``text`` with every span, or run of overlapping ones, replaced by ``mark``."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, start, end, _ in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def _to_mask(text: str) -> list[tuple[str, int, int, bool]]:
    spans, closed = _search(text)
    return sorted([*spans, *(("closed", a, b, False) for a, b in closed)], key=lambda s: s[1:3]) if closed else spans


def mask_secrets(df: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with all secrets in ``text_col`` replaced by ``mark``; all rows and columns stay.

    Layers too large to be opened are replaced too, since nobody knows what they hold. NULL texts stay
    NULL. A text in which nothing is found is returned as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t.as_py() for t in batch.column(at)]
            found = [_to_mask(t) if t else [] for t in texts]
            texts = [mask(t, spans, mark) if spans else t for t, spans in zip(texts, found)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return df.mapInArrow(run, df.schema)
