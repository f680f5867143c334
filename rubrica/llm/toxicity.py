"""Toxicity by a learned lexicon, misspellings included, weighed by their context."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHE_ENTRIES, batches_of, materialise, remainder, texts

#: Labelled rows of each class that the lexicon is learned from.
SAMPLE = 10_000
#: Terms of the lexicon, and known innocent neighbours of terms, at most.
TERMS, INNOCENT = 2_000, 20_000
#: Evidence, in nats, that a term's share of toxic contexts is no chance.
EVIDENCE = 15.0
PRECISION = 0.9
#: Lengths of stems, and the different words that a stem needs.
STEMS, WORDS_OF_STEM, STEM_PRECISION = (5, 6), 3, 0.985
#: Letters on both sides of a term that are searched for signs of quotation.
WINDOW = 80

WORD = re.compile(r"[^\W_]+")
_OPEN, _CLOSE = "\"“„«‘‹「", "\"”“»’›」"
_REPORT = re.compile(
    r"\b(said|says|saying|wrote|writes|quoted?|called|term|word|phrase|sagte?|schrieb|wort|zitat|dijo|dice|palabra"
    r"|cita|dit|écrit|mot|citation)\b", re.IGNORECASE)


def edits(length: int) -> int:
    """Misspellings that a term of this length tolerates."""
    return 0 if length < 5 else 1 if length < 10 else 2


class Automaton:
    """Levenshtein automata of all terms, intersected with the trie of the terms.

    A state is a set of (trie node, edits spent); states and steps are made when first
    met, so a word is read letter by letter through a table, and most words reach the
    empty state after a few letters.
    """

    def __init__(self, terms):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most = [0]
        for term in terms:
            node, allowed = 0, edits(len(term))
            self.most[0] = max(self.most[0], allowed)
            for letter in term:
                after = self.children[node].setdefault(letter, len(self.children))
                if after == len(self.children):
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = after
                self.most[node] = max(self.most[node], allowed)
            self.term[node] = term
        self.start = self._closed({0: 0})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.ends: dict[frozenset, tuple[int, str] | None] = {}

    def _closed(self, reached: dict[int, int]) -> frozenset:
        """Nodes with the fewest edits; a letter of a term may be left out."""
        todo = [*reached.items()]
        while todo:
            node, spent = todo.pop()
            if reached[node] < spent:
                continue
            for after in self.children[node].values():
                if spent + 1 <= self.most[after] and spent + 1 < reached.get(after, 9):
                    reached[after] = spent + 1
                    todo.append((after, spent + 1))
        return frozenset(reached.items())

    def _step(self, state: frozenset, letter: str) -> frozenset:
        reached: dict[int, int] = {}

        def reach(node, spent):
            if spent <= self.most[node] and spent < reached.get(node, 9):
                reached[node] = spent

        for node, spent in state:
            reach(node, spent + 1)  # a letter too many
            for own, after in self.children[node].items():
                reach(after, spent + (own != letter))
        return self._closed(reached)

    def nearest(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term within its tolerance; ties by the term."""
        state = self.start
        for letter in word:
            after = self.steps.get((state, letter))
            if after is None:
                if len(self.steps) > CACHE_ENTRIES:
                    self.steps.clear()
                    self.ends.clear()
                after = self.steps[state, letter] = self._step(state, letter)
            state = after
            if not state:
                return None
        if state not in self.ends:
            self.ends[state] = min(
                ((spent, term) for node, spent in state
                 if (term := self.term[node]) is not None and spent <= edits(len(term))), default=None)
        return self.ends[state]


@dataclass
class Model:
    """What is learned: terms with their precision, words near them that are innocent."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    innocent: list[str] = field(default_factory=list)
    misspelt: list[float] = field(default_factory=lambda: [1.0, 0.8, 0.6])
    quoted: float = 0.3
    base: float = 0.01


class Scorer:
    """Scores texts under a model, with what it has found for words before."""

    def __init__(self, model: Model):
        self.model, self.automaton = model, Automaton(sorted(model.terms))
        self.innocent = frozenset(model.innocent)
        self.weights: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.weights.get(word)
        if found is None:
            if len(self.weights) > CACHE_ENTRIES:
                self.weights.clear()
            near = None if word in self.innocent else self.automaton.nearest(word)
            found = self.model.terms[near[1]] * self.model.misspelt[near[0]] if near else 0.0
            for size in STEMS if self.model.stems else ():
                found = max(found, self.model.stems.get(word[:size], 0.0))
            self.weights[word] = found
        return found

    def hits(self, text: str):
        """(weight, quoted) of each term in a text, misspelt ones included."""
        low = text.lower()
        if not any(map(self.weight, set(WORD.findall(low)))):
            return
        for match in WORD.finditer(low):
            if w := self.weight(match[0]):
                yield w, quoted(low, match.start(), match.end())

    def score(self, text: str) -> float:
        """Probability that one of the hits is abuse, hits taken as independent."""
        clean = 1.0 - self.model.base
        for w, in_quotes in self.hits(text):
            clean *= 1.0 - w * (self.model.quoted if in_quotes else 1.0)
        return 1.0 - clean


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a term's window shows it reported: between quotation marks, or after a word of saying."""
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    opened = any(before.count(o) % 2 == 1 if o == c else before.rfind(o) > before.rfind(c) for o, c in zip(_OPEN, _CLOSE))
    closed = any(c in after for c in _CLOSE)
    return (opened and closed) or bool(_REPORT.search(before[-WINDOW // 2:]))


@lru_cache(maxsize=1)
def _scorer(model: str) -> Scorer:
    """One scorer for all tasks of a worker."""
    return Scorer(Model(**json.loads(model)))


def _contexts(batches):
    """Distinct (word, word before, label) of a batch: copies of a text add no contexts."""
    for batch in batches:
        seen = set()
        for text, label in zip(texts(batch.column("t")), batch.column("toxic").to_pylist()):
            words = WORD.findall(text.decode("utf-8", "replace").lower())
            seen.update(zip(words, ["", *words], [label] * len(words)))
        rows = [r for r in seen if len(r[0]) <= 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1][:64] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int32())], ["word", "before", "toxic"])


def learn(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """Learn from labelled rows (id, toxic) whose CRC-32 remainder is not 0.

    The sample is the `sample` rows of each class whose ids hash lowest.  A word's
    contexts are the distinct words before it.  A term is a word whose toxic contexts
    exceed their share by EVIDENCE and reach PRECISION; at most TERMS of them.  A word
    near a term that has clean contexts of its own is innocent.  Stems are judged like
    words, by all words that begin with them: they stand for a term's endings.  The driver receives
    terms and innocent words, both bounded, and no texts.  NULL labels are not used.
    """
    spark = docs.sparkSession
    own = labels.select(F.col(id_col).alias("i"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("i").isNotNull() & (remainder(F.col("i")) != 0))
    picked = [own.where(F.col("toxic") == y).orderBy(F.xxhash64("i"), "i").limit(sample) for y in (0, 1)]
    picked = materialise(picked[0].unionByName(picked[1]), "sample")
    batches_of(spark)
    words = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
             .join(F.broadcast(picked), "i").select("t", "toxic")
             .mapInArrow(_contexts, "word string, before string, toxic int"))
    counts = materialise(
        words.distinct().groupBy("word").agg(
            F.count(F.when(F.col("toxic") == 1, 1)).alias("bad"), F.count(F.when(F.col("toxic") == 0, 1)).alias("good")),
        "contexts")
    total = counts.agg(F.sum("bad"), F.sum("good")).first()
    if not total[0] or not total[1]:
        return Model()
    share = total[0] / (total[0] + total[1])
    precise = (F.col("bad") + 0.5) / (F.col("bad") + F.col("good") + 1)

    def telling(table: DataFrame) -> DataFrame:
        """Rows whose toxic contexts are no chance."""
        p = F.col("bad") / (F.col("bad") + F.col("good"))
        nats = F.col("bad") * F.log(p / share) + F.when(
            F.col("good") > 0, F.col("good") * F.log((1 - p) / (1 - share))).otherwise(F.lit(0.0))
        return table.where((F.col("bad") > 0) & (p > share)).where((nats >= EVIDENCE) & (precise >= PRECISION))

    def listed(table: DataFrame) -> dict[str, float]:
        rows = telling(table).orderBy(F.desc("bad"), "word").limit(TERMS).select("word", precise.alias("p"))
        return {r["word"]: r["p"] for r in rows.collect()}

    cuts = F.explode(F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in STEMS]))
    stems = (counts.select(cuts.alias("word"), "bad", "good").where("word is not null").groupBy("word")
             .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("words"))
             .where((F.col("words") >= WORDS_OF_STEM) & (precise >= STEM_PRECISION)))
    model = Model(listed(counts.where(F.length("word") > 1)), listed(stems))
    if not model.terms:
        return model
    automaton = Automaton(sorted(model.terms))

    def near(batches):
        for pdf in batches:
            found = [automaton.nearest(w) for w in pdf["word"]]
            pdf["edits"] = [f[0] if f else -1 for f in found]
            yield pdf[pdf["edits"] > 0]

    variants = counts.mapInPandas(near, "word string, bad long, good long, edits int")
    by = {r["edits"]: r for r in variants.where("good = 0 or bad > 0").groupBy("edits").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()}
    model.misspelt = [1.0, *(
        min(0.9, (by[k]["bad"] + 4 * 0.8 ** k) / (by[k]["bad"] + by[k]["good"] + 4)) if k in by else 0.8 ** k for k in (1, 2))]
    model.innocent = [
        r["word"] for r in variants.where("good > 0").orderBy(F.desc("good"), "word").limit(INNOCENT).collect()]
    return model


def score_column(model: Model, text: Column) -> Column:
    """The score of a text under a model: 0 to 1, higher is more likely toxic."""

    written = json.dumps(asdict(model))

    @F.pandas_udf("double")
    def score(batches: pd.Series) -> pd.Series:
        own = _scorer(written)
        return batches.map(lambda t: own.score(t or "")).astype("float64")

    return score(text)


def toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, held_out, score, predicted) of each row; predicted is 1 from a score of 0.5.

    NULL and empty texts get the base score; NULL ids are not held out; repeated rows and
    ids are scored row by row; without labels of both classes every text gets the base
    score; an empty table gives no rows; other columns are not read.
    """
    model = learn(docs, labels, sample, id_col, text_col)
    batches_of(docs.sparkSession)
    scored = docs.select(F.col(id_col), (remainder(F.col(id_col)) == 0).alias("held_out"),
                         score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs whose text scores below 0.5, with their columns as they are.

    NULL texts count as empty and stay.  Each row is judged by itself, so repeated rows and
    NULL ids make no difference.  An empty table gives no rows.
    """
    model = learn(docs, labels, **options)
    batches_of(docs.sparkSession)
    return docs.where(score_column(model, F.col(options.get("text_col", "text"))) < 0.5)
