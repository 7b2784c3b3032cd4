"""Toxicity by a weighted finite-state grammar over clauses; lexicon and weights are learnt from labels."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymart.llm.labelled import TRAIN_ROWS, training_rows
from citymart.llm.names import unused
from citymart.session import stage

#: Terms a lexicon has at most: the most frequent ones of the surest.
MAX_TERMS = 5_000
#: A term needs this much evidence: its log likelihood ratio, and the G statistic of its counts. Among
#: millions of candidate terms chance alone gives less than one beyond the latter.
MIN_RATIO = 2.0
MIN_G = 30.0
PREFIXES = (4, 5, 6, 7)

# The closed word classes of the grammar, in the languages at hand.
NEGATORS = frozenset("not never no without hardly nicht kein keine nie ohne pas jamais sans nunca jamás sin".split())
REPORTERS = frozenset(
    "said says say called calls wrote quoted reported sagte sagt nannte dit disait appelle dijo dice llamó".split()
)
TARGETS = frozenset(
    "you your yours u ur he him she her they them du dich dir ihr euch sie tu toi vous ils tú usted ustedes".split()
)
MODALS = frozenset("will shall should must gonna going hope werde wirst sollst vais doit voy debes".split())
VIOLENCE = frozenset("kill hurt beat shoot stab burn hang murder destroy töten tuer matar sterben mourir morir".split())

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»,]")
_BREAK = re.compile(r"[.!?;\n]+")

# Roles of words and marks: negator, reporting verb, target, modal verb, violent verb, quotation mark, comma, any other.
ROLES = {"N": NEGATORS, "R": REPORTERS, "Y": TARGETS, "M": MODALS, "V": VIOLENCE}
INSULT = "I"

# What the cascade makes of an insult: plain, with a target, negated, reported; and of a threat.
PLAIN, TARGETED, NEGATED, REPORTED = INSULT, "t", "n", "r"
THREAT, THREAT_NEGATED, THREAT_REPORTED = "T", "m", "q"
#: Log likelihood ratios assumed for them before any label is seen, worth PRIOR_ROWS rows.
PRIOR = {
    PLAIN: 4.0,
    TARGETED: 5.0,
    NEGATED: 1.0,
    REPORTED: 1.5,
    THREAT: 4.0,
    THREAT_NEGATED: 1.0,
    THREAT_REPORTED: 1.5,
}
PRIOR_ROWS = 5


class Transducer:
    """Reads the words of a clause, each by its mark or else its role, and writes their marks anew.

    ``writes`` gives the mark that a state makes of a symbol, others stay; ``moves`` the next state by role, what it
    leaves out goes by ``default``.
    """

    def __init__(
        self,
        moves: dict[tuple[int, str], int],
        writes: dict[tuple[int, str], str],
        default: dict[int, int] | None = None,
    ):
        self.moves, self.writes, self.default = moves, writes, default or {}

    def __call__(self, roles: Sequence[str], marks: Sequence[str]) -> list[str]:
        state, out = 0, []
        for role, mark in zip(roles, marks):
            out.append(self.writes.get((state, mark or role), mark))
            state = self.moves.get((state, role), self.default.get(state, state))
        return out

    def backwards(self, roles: Sequence[str], marks: Sequence[str]) -> list[str]:
        return self(roles[::-1], marks[::-1])[::-1]


def _covering(states: Iterable[int], insult: str, threat: str) -> dict[tuple[int, str], str]:
    return {(s, m): w for s in states for m, w in ((INSULT, insult), (THREAT, threat))}


#: A modal verb, a violent verb and a target before the next comma, in this order, are a threat.
THREATS = Transducer({(0, "M"): 1, (1, "V"): 2, (2, "Y"): 0, (2, ","): 0}, {(2, "Y"): THREAT})
#: A negator covers the next three words.
NEGATION = Transducer(
    {(s, "N"): 3 for s in range(4)} | {(s, ","): s for s in (1, 2, 3)},
    _covering((1, 2, 3), NEGATED, THREAT_NEGATED),
    {3: 2, 2: 1, 1: 0},
)
#: A reporting verb covers the rest of the clause, quotation marks what is between them.
REPORT = Transducer({(0, "R"): 1, (0, '"'): 2, (2, '"'): 0}, _covering((1, 2), REPORTED, THREAT_REPORTED))
#: Run backwards: a reporting verb behind a comma covers what is before the comma.
REPORT_AFTER = Transducer({(0, "R"): 1, (1, ","): 2}, _covering((2,), REPORTED, THREAT_REPORTED))
#: A target covers the insults after it; run backwards too, also those before.
TARGET = Transducer({(0, "Y"): 1}, {(1, INSULT): TARGETED})


def marked(roles: Sequence[str], insults: Sequence[str]) -> tuple[list[str], list[str]]:
    """What becomes of the insults and of the threats in a clause: every transducer reads what the one before wrote.

    Threats are found first, by the words' roles; then negation and reports act on both, a target on insults. A
    word of the lexicon keeps its role, so it may be an insult and part of a threat.
    """
    tapes = [list(insults), THREATS(roles, [""] * len(roles))]
    for k, tape in enumerate(tapes):
        tape = REPORT(roles, NEGATION(roles, tape))
        tapes[k] = REPORT_AFTER.backwards(roles, tape)
    return TARGET.backwards(roles, TARGET(roles, tapes[0])), tapes[1]


def cascade(symbols: Sequence[str]) -> list[str]:
    """One symbol for each word: what it is as an insult, else as a threat, else its role. ``symbols`` are roles, or
    INSULT for an insult without a role."""
    insults, threats = marked(symbols, [s if s == INSULT else "" for s in symbols])
    return [i or t or s for i, t, s in zip(insults, threats, symbols)]


@dataclass(frozen=True)
class Model:
    """A lexicon of words and word beginnings with their weights, and the weights of the grammar."""

    words: dict[str, float]
    prefixes: dict[str, float]
    classes: dict[str, float]
    base: float


class Scorer:
    """Finds the clauses in which a model's lexicon or a threat occurs, and weighs them."""

    def __init__(self, model: Model):
        self.model = model
        self.finder = ahocorasick.Automaton()
        for term in {*model.words, *model.prefixes, *VIOLENCE}:
            self.finder.add_word(term, len(term))
        self.finder.make_automaton()

    def weight(self, word: str) -> float:
        """Of the word itself or its longest beginning in the lexicon, 0 if there is none."""
        if word in self.model.words:
            return self.model.words[word]
        for n in sorted(PREFIXES, reverse=True):
            if word[:n] in self.model.prefixes:
                return self.model.prefixes[word[:n]]
        return 0.0

    @staticmethod
    def role(word: str) -> str:
        """The class of a word, whether or not it is in the lexicon."""
        if not word[0].isalpha():
            return "," if word == "," else '"'
        return next((role for role, words in ROLES.items() if word in words), "o")

    def clauses(self, text: str) -> Iterator[list[tuple[str, str, str]]]:
        """Every clause in which something was found: its words, what they are as insults and as threats."""
        text = text.lower()
        done = -1
        for last, length in self.finder.iter(text):
            first = last - length + 1
            if first < done or (first and text[first - 1].isalpha()):
                continue
            start = max(text.rfind(c, max(done, 0), first) for c in ".!?;\n") + 1
            start = max(start, done, 0)
            end = _BREAK.search(text, last)
            done = end.end() if end else len(text)
            words = _TOKEN.findall(text, start, done)
            insults = [INSULT if self.weight(w) else "" for w in words]
            yield list(zip(words, *marked([self.role(w) for w in words], insults)))

    def classes(self, text: str) -> set[str]:
        return {mark for clause in self.clauses(text) for _, *marks in clause for mark in marks if mark}

    def score(self, text: str) -> float:
        """Probability that the label is 1: each clause adds the weight of its strongest insult and strongest threat."""
        total, classes = self.model.base, self.model.classes
        for clause in self.clauses(text):
            insults = (self.weight(w) * classes[i] / classes[PLAIN] for w, i, _ in clause if i)
            total += max(insults, default=0.0) + max((classes[t] for _, _, t in clause if t), default=0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def _ratio(ones: float, of_ones: float, zeros: float, of_zeros: float) -> float:
    return math.log((ones + 0.5) / (of_ones + 1)) - math.log((zeros + 0.5) / (of_zeros + 1))


def _g(count: str, of: int, rows: int) -> Column:
    """One cell's share of the G statistic of a term's counts."""
    expected = (F.col("ones") + F.col("zeros")) * of / rows
    return F.when(F.col(count) > 0, 2 * F.col(count) * F.log(F.col(count) / expected)).otherwise(0.0)


def _terms(text: str) -> set[str]:
    """Words (``=word``) and word beginnings of a text."""
    words = set(_WORD.findall(text.lower()))
    terms = {w[:n] for w in words for n in PREFIXES if len(w) > n}
    return terms | {f"={w}" for w in words if len(w) > 2}


def _count(rows: DataFrame, what, name: str) -> DataFrame:
    """Rows with label 1 and 0 that have each of the things ``what(text)`` yields, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(ones: Counter, zeros: Counter) -> pa.RecordBatch:
            things = list({*ones, *zeros})
            counts = [pa.array([c[t] for t in things], pa.int64()) for c in (ones, zeros)]
            return pa.RecordBatch.from_arrays([pa.array(things, pa.string()), *counts], names=[name, "ones", "zeros"])

        counters = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                counters[0 if label.as_py() else 1].update(what(text.as_py() or ""))
                if len(counters[0]) + len(counters[1]) > 400_000:
                    yield table(*counters)
                    counters = Counter(), Counter()
        yield table(*counters)

    counted = rows.select("text", "label").mapInArrow(run, f"{name} string, ones bigint, zeros bigint")
    return counted.groupBy(name).agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def _without_copies(rows: DataFrame) -> DataFrame:
    """One row of every group that shares its smallest shingle hash, then of those that share the largest.

    Copies of one document are one piece of evidence; near copies mostly share these hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for text in batch.column(0):
                words = (text.as_py() or "").encode().split()
                hashes = [zlib.crc32(b" ".join(s)) for s in zip(words, words[1:], words[2:])]
                hashes = hashes or [zlib.crc32(b" ".join(words))]
                low.append(min(hashes))
                high.append(max(hashes))
            batch = batch.append_column("low", pa.array(low, pa.int64()))
            yield batch.append_column("high", pa.array(high, pa.int64()))

    rows = rows.mapInArrow(run, "text string, label boolean, low bigint, high bigint")
    for key in ("low", "high"):
        first = F.min(F.struct("low", "high", "text", "label")).alias("first")
        rows = rows.groupBy(F.col(key).alias("__key")).agg(first).select("first.*")
    return rows.select("text", "label")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    limit: int = TRAIN_ROWS,
) -> Model:
    """A model of ``label_col`` from labelled documents outside the held-out third.

    Words and word beginnings whose log likelihood ratio is surely high make the lexicon; then the
    classes that the grammar gives their occurrences are weighed in the same way, towards PRIOR where
    there are few. Without labels of both kinds the lexicon is empty.
    """
    rows = training_rows(docs, labels, id_col, text_col, label_col, limit)
    rows = stage(_without_copies(rows), "training")
    n = rows.agg(F.count(F.when(F.col("label"), 1)), F.count(F.when(~F.col("label"), 1))).first()
    ones, zeros = n[0], n[1]
    if not ones or not zeros:
        return Model({}, {}, dict(PRIOR), -1.0)
    ratio = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("zeros") + 0.5) / (zeros + 1))
    terms = _count(rows, _terms, "term").withColumn("weight", ratio).filter(F.col("weight") >= MIN_RATIO)
    terms = terms.filter(_g("ones", ones, ones + zeros) + _g("zeros", zeros, ones + zeros) >= MIN_G)
    lexicon = terms.orderBy(F.desc("ones"), F.desc("weight"), "term").limit(MAX_TERMS).collect()
    words = {r.term[1:]: r.weight for r in lexicon if r.term[0] == "="}
    # a beginning counts if it says more than any single word with it
    most: dict[str, int] = {}
    for r in lexicon:
        if r.term[0] == "=":
            for n in PREFIXES:
                most[r.term[1 : n + 1]] = max(most.get(r.term[1 : n + 1], 0), r.ones)
    prefixes = {r.term: r.weight for r in lexicon if r.term[0] != "=" and r.ones > 1.2 * most.get(r.term, 0)}
    base = min(0.0, math.log((ones + 0.5) / (zeros + 0.5)))
    model = Model(words, prefixes, dict(PRIOR), base)
    seen = {r["class"]: r for r in _count(rows, Scorer(model).classes, "class").collect()}
    classes = {}
    for name, prior in PRIOR.items():
        a, b = (seen[name].ones, seen[name].zeros) if name in seen else (0, 0)
        share = 0.05
        a = (a + PRIOR_ROWS * share) / (ones + PRIOR_ROWS)
        b = (b + PRIOR_ROWS * share * math.exp(-prior)) / (zeros + PRIOR_ROWS)
        classes[name] = max(0.1, math.log(a / b))
    # a target adds up to half as much again; negation and reports take away down to a tenth
    classes[TARGETED] = min(1.5 * classes[PLAIN], max(classes[PLAIN], classes[TARGETED]))
    for whole, parts in ((PLAIN, (NEGATED, REPORTED)), (THREAT, (THREAT_NEGATED, THREAT_REPORTED))):
        classes |= {c: min(classes[whole], max(0.1 * classes[whole], classes[c])) for c in parts}
    return Model(words, prefixes, classes, base)


def score_documents(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` and ``score_col``, between 0 and 1; only the text counts.

    Every text is read whole. NULL and empty texts get the base rate. All rows and columns stay,
    repeated ones too; ``score_col`` replaces a column of that name.
    """
    df = df.drop(score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = pa.array([scorer.score(t.as_py() or "") for t in texts], pa.float64())
            yield batch.append_column(score_col, scores)

    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())])
    return df.mapInArrow(run, schema)


def reject_toxic(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``df`` whose text scores below ``threshold``, all columns as they were."""
    score = unused(df, "score")
    return score_documents(df, model, text_col, score).filter(F.col(score) < threshold).drop(score)
