"""Alignment against whole texts, encoded and compared offset by offset."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citymart.llm import alignment
from citymart.llm.alignment import Aligner, align_documents, common_ends
from citymart.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, op13_alignment

A = Tokenizer.from_file(BYTE_TOKENIZER)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)


def _spelt():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


SPELT = _spelt()


def whole(text):
    """Ids of both, their groups and their links; None without tokens."""
    raw = f" {text}".encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(SPELT[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = []
    for i in b:
        byte = re.fullmatch("<0x(..)>", piece := B.id_to_piece(i))
        b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return None
    cuts, links, i, j, x, y = [], [], 0, 0, 0, 0
    first = 0, 0
    while i < len(a):
        if x <= y:
            x += len(a_bytes[i])
            i += 1
        while y < x:
            y += len(b_bytes[j])
            j += 1
        if x == y:
            cuts.append((a[first[0] : i], b[first[1] : j]))
            links.append((a[i - 1], b[j - 1]))
            first = i, j
    return a, b, cuts, links


def as_text(cuts):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in cuts)


def expected(rows):
    found = [(i, whole(t or "")) for i, t in rows]
    counts = Counter(link for _, w in found if w for link in w[3])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for i, w in found:
        if not w:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(counts[link] == top[link[1]] for link in w[3])
        total = sum(counts[link] for link in w[3])
        digest = hashlib.sha256(as_text(w[2]).encode()).hexdigest()
        out.append((i, len(w[0]), len(w[1]), len(w[2]), len(w[3]), best, total, digest))
    return sorted(out, key=str), counts, top


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None,
    "",
    " ",
    "a",
    " a",
    "  a  b ",
    "x\n y\n\nz\t w 　 v",
    "<|endoftext|> <s> </s> <unk> <0x0A>",
    "has▁one of theirs",
    "ﬁ ½ é \U0001f642\U0001f642 中文字 \x00 end",
    "unbelievable tokenization, tokenization; tokenization",
    "word " * 2000,
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [" ".join(rng.choices(["the", "Token.", "naïve", "x1", "(y)", "qzx"], k=rng.choice([1, 30, 400]))) for _ in range(80)]
    return list(enumerate(ODD + made)) + [(1, "the same"), (1, "the same"), (None, "no id")]


def test_common_ends_of_plain_lists():
    def cut(a, b):
        return [x.tolist() for x in common_ends(np.array(a, np.int64), np.array(b, np.int64))]

    assert cut([2, 1, 3], [3, 3]) == [[3, 6], [2, 3], [1, 2]]
    assert cut([4], [1, 3]) == [[4], [1], [2]]
    assert cut([2, 2], [1, 2]) == [[], [], []]
    assert cut([], []) == [[], [], []]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(" \n\t 　▁'ab1.é字\x1c") | st.characters(codec="utf-8"), max_size=40))
def test_any_text_equals_the_whole(text):
    aligner = alignment.aligner(BYTE_TOKENIZER, PIECE_TOKENIZER)
    [(n_a, _, n_groups, groups, links)] = aligner.texts(pa.array([text]))
    want = whole(text)
    assert str(groups, "utf-8") == (as_text(want[2]) if want else "")
    assert (n_a, n_groups, len(links)) == ((len(want[0]), len(want[2]), len(want[2])) if want else (0, 0, 0))


def test_query_equals_the_plain_version(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 500)
    columns = "doc_id long, text string, block string, pairs int, at int, id string, n_a string"
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y", "z") for r in rows], columns)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_alignment(spark, str(tmp_path)).select(*NAMES).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)[0]


def test_groups_and_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "name long, body string")
    found, pairs = align_documents(docs, BYTE_TOKENIZER, PIECE_TOKENIZER, "name", "body", with_groups=True)
    _, counts, top = expected(rows)
    assert {(r.a, r.b): (r.links, r.best) for r in pairs.collect()} == {k: (n, n == top[k[1]]) for k, n in counts.items()}
    texts = Counter((i, as_text(w[2]) if (w := whole(t or "")) else "") for i, t in rows)
    assert Counter((r.name, r.groups) for r in found.collect()) == texts


def test_shuffled_joins_give_the_same(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = align_documents(docs, BYTE_TOKENIZER, PIECE_TOKENIZER)[0].select(*NAMES).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted(map(tuple, found), key=str) == expected(rows)[0]


def test_forgotten_parts_are_aligned_again(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_PARTS", 2)
    monkeypatch.setattr(alignment, "TOGETHER", 2)
    monkeypatch.setattr(alignment, "GROUP_BYTES", 5)
    texts = ["one two three", "three two one.", "one two three"]
    found = Aligner(BYTE_TOKENIZER, PIECE_TOKENIZER).texts(pa.array(texts))
    assert [str(f[3], "utf-8") for f in found] == [as_text(whole(t)[2]) for t in texts]


def test_empty_table_and_no_tokens(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    found, pairs = align_documents(empty, BYTE_TOKENIZER, PIECE_TOKENIZER)
    assert found.collect() == [] and pairs.collect() == []
    found, pairs = align_documents(nothing, BYTE_TOKENIZER, PIECE_TOKENIZER)
    zeros = [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert sorted(map(tuple, found.select(*NAMES).collect())) == zeros and pairs.collect() == []
