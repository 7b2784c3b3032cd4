"""The toxicity grammar: its transducers, and what it learns from labels."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from citymart.llm.labelled import held_out, training_rows
from citymart.llm.toxicity import (
    NEGATED,
    PLAIN,
    PRIOR,
    REPORTED,
    TARGETED,
    THREAT,
    THREAT_NEGATED,
    THREAT_REPORTED,
    Model,
    Scorer,
    cascade,
    fit,
    marked,
    reject_toxic,
    score_documents,
)

MODEL = Model({"fool": 6.0}, {"gruf": 5.0}, dict(PRIOR), -2.0)
DOCS = "doc_id long, text string, lang string, score double, label boolean"


def corpus(seed=3, n=900):
    """Documents of made-up words; toxic ones hold an insult or a word of a bad stem."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeo", k=rng.randint(2, 7))) for _ in range(3000)]
    docs, labels = [], []
    for i in range(n):
        text, toxic = rng.choices(words, k=rng.choice([8, 60, 300])), rng.random() < 0.2
        if toxic:
            bad = rng.choice(["numbskull", "twit", "snork" + rng.choice(words)])
            text[rng.randrange(len(text))] = bad
        for j in range(7, len(text), 9):
            text[j] += rng.choice([".", ",", "!\n"])
        docs.append((i, " ".join(text), "xx", 5.0, True))
        if rng.random() < 0.8:
            labels.append((i, int(toxic), 0))
    return docs, labels


def tables(spark, docs, labels):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int, text int")


@pytest.mark.parametrize(
    "symbols, want",
    [
        ("oIo", PLAIN),
        ("YoI", TARGETED),
        ("IoY", TARGETED),
        ("NooI", NEGATED),
        ("NoooI", PLAIN),
        ("RoI", REPORTED),
        ('o"I"o', REPORTED),
        ('"o"I', PLAIN),
        ("MoVoY", THREAT),
        ("VoYM", None),
        ("NIY", NEGATED),
    ],
)
def test_transducers(symbols, want):
    found = [s for s in cascade(list(symbols)) if s in PRIOR]
    assert found == ([want] if want else [])


def test_clauses_not_words_are_weighed():
    score = Scorer(MODEL).score
    assert score("") == score("nothing at all") < 0.2
    assert score("you fool") > score("a fool") > score("she said a fool") > score("not a fool") > score("")
    assert score("A Fool. Grufling!") > score("a fool")  # two clauses
    assert score("fool fool fool") == pytest.approx(score("fool"))  # one clause
    assert score("foolish outfool regruf") == score("")  # words whole, stems at the beginning
    assert score("I will kill you") > 0.7 > score("kill the lights")
    assert score("not bad. a fool") == score("a fool")  # negation ends with its clause


def test_fitted_on_labels_outside_the_held_out_third(spark):
    docs, labels = corpus()
    df, marks = tables(spark, docs, labels)
    model = fit(df, marks)
    assert {"numbskull", "twit"} <= set(model.words) and any(p.startswith("snor") for p in model.prefixes)
    truth = {i: t for i, t, _ in labels}
    rows = score_documents(df, model).withColumn("held", held_out("doc_id")).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    held = [(r.score >= 0.7, truth[r.doc_id]) for r in rows if r.held and r.doc_id in truth]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(a == bool(b) for a, b in held) / len(held) > 0.97


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = corpus()
    df, marks = tables(spark, docs, labels)
    other = marks.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert fit(df, marks) == fit(df.withColumn("lang", F.lit("yy")).repartition(5), other.repartition(3))


def test_training_rows_are_bounded_and_copies_count_once(spark):
    docs, labels = corpus()
    df, marks = tables(spark, docs, labels)
    assert training_rows(df, marks, "doc_id", "text", "toxic", 50).count() == 50
    copies = [(10_000 + i, "odd words that only copies have, many times over", "xx", 0.0, False) for i in range(60)]
    df, marks = tables(spark, docs + copies, labels + [(i, 1, 0) for i, *_ in copies])
    assert "copies" not in fit(df, marks).words


def test_odd_tables(spark):
    docs, labels = corpus(n=200)
    odd = [(None, None, None, None, None), (1, "", "", 1.0, None), (1, "", "", 1.0, None), (2, "fool " * 100_000, "", 1.0, None)]
    df, marks = tables(spark, odd, [(1, None, None), (None, 1, 1), (7, 1, 1), (1, 0, 0), (1, 1, 0)])
    model = fit(df, marks)
    assert model.words == {} and score_documents(df, model).filter("score < 0.7").count() == 4
    scored = score_documents(df, MODEL)
    assert scored.columns == ["doc_id", "text", "lang", "label", "score"]
    kept = reject_toxic(df, MODEL)
    assert kept.columns == df.columns and kept.count() == 3 and kept.schema == df.schema
    empty, none = tables(spark, [], [])
    assert fit(empty, none).prefixes == {} and score_documents(empty, MODEL).collect() == []
    assert reject_toxic(empty, MODEL).collect() == []
    assert fit(tables(spark, docs, labels)[0], none).words == {}


def plain_marks(roles, insults):
    """What the grammar says, word by word: threats, then negation, reports before and after, targets."""
    n = len(roles)
    threats, at = [""] * n, 0
    for i, role in enumerate(roles):
        if at == 0 and role == "M":
            at = 1
        elif at == 1 and role == "V":
            at = 2
        elif at == 2 and role in "Y,":
            threats[i], at = (THREAT if role == "Y" else ""), 0
    out = []
    for tape, classes in ((insults, "Inr"), (threats, "Tmq")):
        tape = list(tape)
        for i in range(n):
            if tape[i] != classes[0]:
                continue
            words = [r for r in roles[:i] if r != ","]
            quotes = 0
            for r in roles[:i]:
                if r == "R" and not quotes % 2:
                    quotes = -1
                    break
                quotes += r == '"'
            commas = [j for j in range(i + 1, n) if roles[j] == ","]
            if "N" in words[-3:]:
                tape[i] = classes[1]
            elif quotes == -1 or quotes % 2:
                tape[i] = classes[2]
            elif any("R" in roles[j:] for j in commas):
                tape[i] = classes[2]
        out.append(tape)
    out[0] = ["t" if m == "I" and "Y" in roles[:i] + roles[i + 1 :] else m for i, m in enumerate(out[0])]
    return out


def test_the_composed_transducers_equal_the_plain_grammar():
    rng = random.Random(8)
    for _ in range(4000):
        n = rng.randrange(0, 12)
        roles = rng.choices("ooNRYMV\",", k=n)
        insults = [rng.choice(["", "", "I"]) for _ in range(n)]
        found = [list(tape) for tape in marked(roles, insults)]
        assert found == plain_marks(roles, insults), (roles, insults)


@pytest.mark.parametrize(
    "symbols, want",
    [("NMVY", THREAT_NEGATED), ("MNVY", THREAT_NEGATED), ("RoMVY", THREAT_REPORTED), ('"MVY"', THREAT_REPORTED)]
    + [("MVY,YR", THREAT_REPORTED), ("MVo,YR", None), ("I,R", REPORTED), ("IR", PLAIN), ("NooooMVY", THREAT)],
)
def test_threats_are_negated_and_reported(symbols, want):
    assert [s for s in cascade(list(symbols)) if s in PRIOR] == ([want] if want else [])


@pytest.mark.parametrize("words", [{"fool": 6.0}, {"fool": 6.0, "kill": 5.0, "you": 2.5, "not": 2.5, "said": 2.5}])
def test_sentences_about_violence_score_apart(words):
    """Words of the lexicon keep their part in the grammar."""
    score = Scorer(Model(words, {}, dict(PRIOR), -2.0)).score
    threat = score("I will kill you")
    assert threat > 0.7
    assert threat > score("he will not kill you") and threat > score("she said I will kill you")
    assert threat > score("you must shoot the film, they say") and threat > score("kill the lights")
    assert threat > score("I will kill you, he said") < threat
    assert score('"I will kill you" is a line') < threat
