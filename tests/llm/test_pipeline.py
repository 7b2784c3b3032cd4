"""The pipeline's stages, each against a plain version of its operator, and the registered queries."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from citymart.llm import queries
from citymart.llm.labelled import held_out
from citymart.llm.mixing import mix_documents
from citymart.llm.secrets import find, mask
from citymart.llm.simhash import fingerprint
from citymart.llm.toxicity import Scorer, fit
from citymart.session import stage
from tools.compare import compare

SF_DIR = Path(E.SMOKE_DIR)
MIDDLE = SF_DIR.parent / "sf0.01"

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables are not here")


def test_every_operator_is_registered_once():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= set(E.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash near-dedup", "secret scans", "mixing sources", "packing"
    ]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, name, str(SF_DIR)) == []


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_do_what_their_operators_say(spark):
    sf_dir = str(MIDDLE)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    scorer = Scorer(fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), label_col="toxic"))
    before, docs = docs, stage(stages["toxicity"](spark, docs, sf_dir), "one")
    assert rows(docs) == Counter(r for r in rows(before).elements() if scorer.score(r[1]) < 0.7)
    assert 0 < docs.count() < before.count()

    before, docs = docs, stage(stages["simhash near-dedup"](spark, docs, sf_dir), "two")
    fps = {r.doc_id: fingerprint(r.text, 3) % 2**64 for r in before.collect()}
    group = {}
    for i in sorted(fps):  # a component's smallest id comes first
        near = {group[j] for j in group if (fps[i] ^ fps[j]).bit_count() <= 2}
        group[i] = min(near, default=i)
        group = {j: group[i] if g in near else g for j, g in group.items()}
    assert {r.doc_id for r in docs.collect()} == set(group.values()) and docs.count() < before.count()

    before, docs = docs, stage(stages["secret scans"](spark, docs, sf_dir), "three")
    want = []
    for r in before.collect():
        text = mask(r.text, find(r.text)[0], "[secret]")
        want.append((r.doc_id, text, r.lang, r.source, len(text)))
    assert rows(docs) == Counter(want) and rows(docs) != rows(before)

    before, docs = docs, stage(stages["mixing sources"](spark, docs, sf_dir), "four")
    assert rows(docs) == rows(before)
    assert docs.columns == columns and docs.dtypes == before.dtypes

    pieces = stages["packing"](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
    total = Counter()
    for r in pieces:
        total[r.doc_id] += r.length
        assert r.offset + r.length <= 2048
    assert all(total[r.doc_id] == r.doc_tokens for r in pieces)


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, str(SF_DIR))
    assert found.columns[:2] == ["doc_id", "start"] and found.count() > 0


def test_toxic_documents_of_the_held_out_third_are_found(spark):
    scored = queries.op4_toxicity(spark, str(MIDDLE)).filter("held_out")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").filter(held_out("doc_id"))
    counts = {(r.toxic, r.predicted): r["count"] for r in scored.join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert counts.get((0, 1), 0) == 0 and counts[1, 1] > 2 * counts.get((1, 0), 0)


ODD = [
    (None, None, None, None, None),
    (1, "", "en", None, 0),
    (1, "", "en", None, 0),
    (2, "some words " * 30_000, None, "a", None),
    (3, "see password=abcdefghijklmnop here", "en", "a", 34),
    (3, "see password=abcdefghijklmnop here", "en", "a", 34),
]


@pytest.mark.parametrize("some", [ODD, []])
def test_stages_take_odd_and_empty_tables(spark, tmp_path, some):
    docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == ({None, 1, 2, 3} if some else set())
    names = ("op2_secrets", "op3_mixing", "op4_toxicity", "op5_resampling", "op6_simhash", "op9_passages")
    for name in (*names, "op11_periodic_runs", "op12_token_files", "op13_alignment"):
        assert queries.QUERIES[name](spark, str(tmp_path)).collect() is not None


def test_sequences_keep_the_order_of_the_mix(spark):
    sources = ["hot"] * 300 + ["a"] * 60 + ["b"] * 60
    texts = [(i, "word " * (100 + 37 * i % 3900), s) for i, s in enumerate(sources)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    mixed = stage(mix_documents(docs, weights={"hot": 1, "a": 1, "b": 1}, block_chars=20_000), "mixed")
    found = dict(corpus_pipeline.STAGES)["packing"](spark, mixed, "").collect()
    ids = {r.sequence_id for r in found}
    assert ids == set(range(len(ids)))
    for n in (45, 90):  # before a source runs out
        shares = Counter()
        for r in found:
            shares[sources[r.doc_id]] += r.length * (r.sequence_id < n)
        assert all(abs(shares[s] / sum(shares.values()) - 1 / 3) < 0.12 for s in set(sources)), (n, shares)


CLASHING = """__id __hash __slot __source __text_hash __at __score __file __row ___id __key __fp __block _metadata __metadata hash at
    slot score key fp group label low high task start length release deadline block count file row id text_hash first size
    n chunk rank masked layers too_large sequence_id offset ids component_id""".split()


def test_columns_named_as_our_own_change_nothing(spark, tmp_path):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(40)]
    texts = [(i, f"some text number {i} " * (i % 7 + 1) + ("you numbskull" if i % 5 == 0 else ""), "en", "ab"[i % 2]) for i in range(60)]
    texts += [(70, texts[3][1], "en", "a"), (3, texts[3][1], "en", "b"), (3, texts[3][1], "en", "b")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    plain = spark.createDataFrame([(*t, len(t[1])) for t in texts], schema)
    found = []
    for name, docs in (("plain", plain), ("more", plain.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)]))):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs.write.parquet(f"{folder}/documents.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for stage_name, function in corpus_pipeline.STAGES[:-1]:
            before, kept = kept, stage(function(spark, kept, folder), stage_name.replace(" ", "-"))
            assert kept.columns == before.columns, stage_name
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
        found.append((rows(kept.select(*plain.columns)), Counter((r.doc_id, r.length, r.ids_crc32) for r in packed)))
        if name == "more":
            assert kept.select(*CLASHING).distinct().collect() == [tuple(range(len(CLASHING)))]
    assert found[0] == found[1]
