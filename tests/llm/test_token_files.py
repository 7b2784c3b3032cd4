"""Token files: every id read back in order, and any single one by its address."""

import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citymart.llm import byte_level, token_files
from citymart.llm.byte_level import ByteLevel
from citymart.llm.parts import cut, cut_all
from citymart.llm.queries import BYTE_TOKENIZER, op12_token_files
from citymart.llm.token_files import (
    CodeReader,
    CodeWriter,
    decode_levels,
    encode_levels,
    read_token_files,
    read_tokens,
    write_token_files,
)

ODD = [
    "",
    None,
    "a",
    " a",
    "a ",
    "  a  b  ",
    "it's\n can't\n\nwe\t re  x 　 y  z\x85 w",
    "see <|endoftext|> and  <|endoftext|>x  <|endoftext|>  y",
    "\x1c a \x1f b",
    "中文 字, é́ \U0001f642\U0001f642 ½ ٣",
    "word " * 3000,
]


WHOLE = Tokenizer.from_file(BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return WHOLE


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_of_odd_texts_equal_the_tokenizers(tokenizer):
    for text, found in zip(ODD, ByteLevel(BYTE_TOKENIZER).ids(pa.array(ODD))):
        assert found.tolist() == ids_of(tokenizer, text), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t 　\x1c\x85​᠎'ab1.é字") | st.characters(codec="utf-8"), max_size=30)))
def test_ids_of_any_text_equal_the_tokenizers(texts):
    found = [f.tolist() for f in byte_level.byte_level(BYTE_TOKENIZER).ids(pa.array(texts, pa.string()))]
    assert found == [ids_of(WHOLE, t) for t in texts]


def test_every_character_beside_a_cut(tokenizer):
    texts = [f"a{c} b {c}c {c} d" for c in map(chr, range(sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff"][::17]
    texts += [f"a{c} b {c}c {c} d" for c in map(chr, range(0x3100))]
    whole = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    found = ByteLevel(BYTE_TOKENIZER).ids(pa.array(texts))
    assert all(f.tolist() == w.ids for f, w in zip(found, whole))


def test_cut_gives_the_text_back():
    for text in ODD:
        assert " ".join(cut(text or "")) == (text or "")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\x0b 　\x1c\x85ab"), max_size=12), max_size=9))
def test_all_cuts_equal_the_single_ones(texts):
    assert cut_all(pa.array(texts, pa.string())).to_pylist() == [cut(t) for t in texts]


def test_forgotten_parts_are_learnt_again(monkeypatch, tokenizer):
    monkeypatch.setattr(byte_level, "KNOWN_PARTS", 3)
    monkeypatch.setattr(byte_level, "GROUP_BYTES", 10)
    texts = ["one two three four.", "four. three two", "five six, seven", "one two three four."]
    assert [f.tolist() for f in ByteLevel(BYTE_TOKENIZER).ids(pa.array(texts))] == [ids_of(tokenizer, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 70_000) | st.integers(0, 2**32 - 1), min_size=1, max_size=1500))
def test_levels_round_trip(ids):
    counts, data = encode_levels(np.array(ids, np.uint32))
    assert counts[0] == len(ids) and decode_levels(counts, data).tolist() == ids


@pytest.mark.parametrize("segment", [7, 700, 1 << 20])
def test_any_token_of_a_file_by_its_place(tmp_path, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", segment)
    rng = np.random.default_rng(segment)
    documents = [rng.integers(0, 2 ** rng.choice([7, 9, 17, 32]), n, np.uint32) for n in (1, 5, 0, 1200, 1, 600)]
    writer = CodeWriter(f"file:{tmp_path}/a/x.codes", pa.int64())
    for k, ids in enumerate(documents):
        writer.add(pa.scalar(None if k == 4 else k, pa.int64()), ids)
    writer.close()
    every = np.concatenate(documents).tolist()
    reader = CodeReader(f"{tmp_path}/a/x.codes")
    assert [reader.token(i) for i in range(reader.tokens)] == every
    found = [(d.as_py(), begin, np.concatenate(ids).tolist()) for d, begin, ids in reader.documents()]
    begins = np.cumsum([0, *map(len, documents)]).tolist()
    assert found == [(None if k == 4 else k, begins[k], d.tolist()) for k, d in enumerate(documents)]
    with pytest.raises(IndexError):
        reader.token(reader.tokens)


def test_other_files_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"0" * 40)
    with pytest.raises(ValueError, match="token codes"):
        CodeReader(str(tmp_path / "x"))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    made = [" ".join(rng.choices(["the", "Token.", "naïve", "x1", "(y)\n"], k=rng.choice([3, 50, 900]))) for _ in range(120)]
    rows = list(enumerate(ODD + made, 7)) + [(3, "b"), (3, "a"), (3, "a"), (None, "no id"), (None, None)]
    rng.shuffle(rows)
    return rows


def test_files_hold_all_documents_in_order(spark, rows, tmp_path, tokenizer):
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, hash int, place string").repartition(5)
    files = write_token_files(df, str(tmp_path / "codes"), BYTE_TOKENIZER, end_id=2)
    found = sorted(read_token_files(files, "bigint", with_ids=True).collect(), key=lambda r: r.start)
    at = 0
    for r in found:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    want = sorted(((i, [*ids_of(tokenizer, t), 2]) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in found), key=str) == want

    every = [x for r in found for x in r.ids]
    asked = [(p, "k") for p in [0, at - 1, at, -1, None, 5, 5, *range(0, at, 97)]]
    places = spark.createDataFrame(asked, "place long, token string").withColumn("note", places_note())
    got = read_tokens(files, places).collect()
    assert len(got) == len(asked)
    for r in got:
        assert r.note == "n" and r.token == (every[r.place] if r.place is not None and 0 <= r.place < at else None)


def places_note():
    from pyspark.sql import functions as F

    return F.lit("n")


def test_query(spark, rows, tmp_path, tokenizer):
    numbered = [(i, t) for i, (_, t) in enumerate(rows)]
    spark.createDataFrame(numbered[::-1], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    at, want = 0, []
    for i, t in numbered:
        ids = np.array([*ids_of(tokenizer, t), 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, op12_token_files(spark, str(tmp_path)).collect())) == want


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id string, text string")
    files = write_token_files(empty, str(tmp_path / "codes"), BYTE_TOKENIZER, end_id=2)
    assert files.collect() == [] and read_token_files(files, "string").collect() == []
    places = spark.createDataFrame([(0,)], "place long")
    assert [tuple(r) for r in read_tokens(files, places).collect()] == [(0, None)]


def test_a_repeated_attempt_leaves_no_second_documents(spark, tmp_path):
    """Files that the list does not name are not read."""
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    files = write_token_files(df, str(tmp_path / "codes"), BYTE_TOKENIZER, end_id=2)
    before = sorted(map(tuple, read_token_files(files, "bigint").collect()))
    lost = CodeWriter(str(tmp_path / "codes/files/part-00000000-lost.codes"), pa.int64())
    lost.add(pa.scalar(1), np.array([1, 2], "<u4"))
    lost.close()
    assert sorted(map(tuple, read_token_files(files, "bigint").collect())) == before
