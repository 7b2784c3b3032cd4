"""Packing: every token in one piece, sequences gapless, ids as the tokenizer gives them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citymart.llm import packing
from citymart.llm.packing import pack_documents, pack_histogram, token_ids
from citymart.llm.queries import TOKENIZER

ODD = [
    "",
    None,
    "a",
    "Hello, World!! it's ÉTÉ. 'twas <|endoftext|> x<|STARTOFTEXT|>y İstanbul ΣΑΣ. été  foo\tbar\x1cbaz",
    ".. ... a.b. 12,5 ½ ﬁ ｆ   x don't. can't, we're! ''s s' '' 's. é . , ́ 中文字 🙂🙂 🙂.",
    "word " * 5000,
]


def tokens(text):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["the", "of", "Token.", "packing,", "naïve", "x1", "(y)", "--"]
    made = [" ".join(rng.choices(words, k=rng.choice([3, 50, 400, 3000]))) for _ in range(150)]
    return list(enumerate(ODD + made)) + [(1, "a"), (None, "no id"), (None, "no id")]


def test_pieces_cover_every_token_once(spark, rows):
    size = 256
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, length string, task int")
    found = pack_documents(df.repartition(3), TOKENIZER, size=size, with_ids=True).collect()
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append([*tokens(t), 1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length <= size
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, want in texts.items():
        got = sorted(pieces[i])
        assert sorted(x for _, ids, _ in got for x in ids) == sorted(x for w in want for x in w)
        if len(want) == 1:
            assert [x for _, ids, _ in got for x in ids] == want[0] and {n for _, _, n in got} == {len(want[0])}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in found)
    assert len(sequences) * size < 1.03 * total + size


def test_ids_of_odd_texts_equal_the_tokenizers():
    for text, found in zip(ODD, token_ids(pa.array(ODD), TOKENIZER)):
        assert found.tolist() == tokens(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_ids_of_any_text_equal_the_tokenizers(texts):
    found = [f.tolist() for f in token_ids(pa.array(texts, pa.string()), TOKENIZER)]
    assert found == [tokens(t) for t in texts]


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    monkeypatch.setattr(packing, "GROUP_CHARS", 10)
    texts = ["one two three four.", "four. three two", "five six, seven", "one two three four."]
    assert [f.tolist() for f in token_ids(pa.array(texts), TOKENIZER)] == [tokens(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), max_size=20))
def test_histogram_is_packed_whole(counts):
    patterns = pack_histogram(counts, 64)
    used = defaultdict(int)
    for n, lengths in patterns:
        assert n > 0 and sum(lengths) <= 64
        for length in lengths:
            used[length] += n
    assert used == counts


def test_little_padding_on_a_wide_histogram():
    rng = random.Random(1)
    counts = defaultdict(int)
    for _ in range(20_000):
        counts[min(2048, int(rng.lognormvariate(6, 1)) + 1)] += 1
    packs = sum(n for n, _ in pack_histogram(counts, 2048))
    assert packs * 2048 < 1.01 * sum(n * c for n, c in counts.items()) + 2048


def test_empty_table_has_the_same_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    full = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert pack_documents(empty, TOKENIZER).collect() == []
    assert pack_documents(empty, TOKENIZER).dtypes == pack_documents(full, TOKENIZER).dtypes
    assert [tuple(r) for r in pack_documents(full, TOKENIZER).collect()] == [(1, 0, 1, zlib.crc32(b"\x01\0\0\0"), 1, 0, 0)]


MARKED = ["হয়, হয়! হয়", "पढ़, पढ़.", "\ufb2a, \ufb2a", "ANKARALİ, ANKARALİ. İ; ANKARALİ", "য়ক, naïve, ÉTÉ!"]


def test_words_that_normalise_to_a_mark_before_punctuation():
    texts = MARKED + ["\u0958, b\u0f43; \u095c\u095c?! x\u0130..."]
    for text, found in zip(texts, token_ids(pa.array(texts), TOKENIZER)):
        assert found.tolist() == tokens(text)


def test_every_letter_before_punctuation():
    words = [f"b{chr(c)}," for c in range(128, 0x11000) if chr(c).isalpha()]
    whole = Tokenizer.from_file(TOKENIZER).encode_batch_fast(words, add_special_tokens=False)
    assert [f.tolist() for f in token_ids(pa.array(words), TOKENIZER)] == [w.ids for w in whole]
