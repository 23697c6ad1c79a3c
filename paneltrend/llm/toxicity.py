"""Toxicity by a fuzzy lexicon and the context of its hits.

The lexicon is learned: words whose share among toxic documents is far above
that among the others, counted by the different contexts (the word before and
the word after) in which they occur, so copies of one toxic text don't make
its words terms.  A term may also be a stem, which stands for all words that
begin with it, if it is as telling with at least ``STEM_WORDS`` of them; the
words keep their own automata beside it.  The terms form a trie; the Levenshtein automaton of
each term (one edit from 4 letters on, two from 8) is intersected with the
trie by carrying sets of (trie node, edits spent) and made deterministic as
words are read, so a word is judged in one step a character and mostly
dismissed after two or three.  A hit is scored by its term and edits (what hits
of that kind meant among the labelled documents), and by the words around it: what surrounds terms in documents that are not toxic (reports,
quotations) speaks against abuse, and so do quotation marks on both sides.
A logistic model joins these into the score.

Size bound: the lexicon, the context words and the model are fitted on at most
``MAX_LABELLED`` labelled documents, taken by the hash of their ids; whatever
words of theirs are telling enough are in the lexicon or the context, however
many.  Every word of every document is scored.

Defined results: null text is empty; texts without a hit, empty ones too, get
the score of no hit; without labels of both kinds the score is 0; a document
with several labels counts once for each; null labels and ids are not learned
from; repeated rows are scored each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import fold_of, settled, table, whole_text

#: Labelled documents that the classifier is fitted on.
MAX_LABELLED = 20_000
#: A term is in at least so many toxic documents.
LEAST_DOCUMENTS = 4
#: Standard errors that a term's or context word's log odds lie from zero, and a term's least log odds.
CERTAIN, LEAST_ODDS = 3.5, 2.0
#: Words on either side of a hit that are its context.
WINDOW = 4
#: Lengths of stems, and the words that a stem must be found with.
STEMS, STEM_WORDS = (4, 5, 6), 3
#: Edits allowed by the length of a term; for a stem, in what a word begins with.
ONE_EDIT, TWO_EDITS = 4, 8
#: Words that a task remembers, and entries of automaton states: some tens of MB for either.
REMEMBERED, STATE_ENTRIES = 100_000, 300_000
SLICE = 1_000_000
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W_]+")
_OTHER = re.compile(r"[\W_]")
_QUOTES = frozenset("\"'«»“”„‘’‹›`")


def slices_of(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            other = _OTHER.search(text, end)
            end = other.start() if other else len(text)
        yield text[at:end]
        at = end


# --- the automaton ------------------------------------------------------------------------


class FuzzyLexicon:
    """Levenshtein automata of all terms at once, over the trie of the terms; stems end in ``*``."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[int] = [-1]
        self.stem_at: list[int] = [-1]
        self.budget: list[int] = [0]
        self.letters = {c for t in terms for c in t.rstrip("*")}
        for i, term in enumerate(terms):
            edits, node = self.edits_of(term), 0
            self.budget[0] = max(self.budget[0], edits)
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term_at.append(-1)
                    self.stem_at.append(-1)
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], edits)
            (self.stem_at if term.endswith("*") else self.term_at)[node] = i
        self._reset()

    @staticmethod
    def edits_of(term: str) -> int:
        letters = len(term.rstrip("*"))
        return (letters >= ONE_EDIT) + (letters >= TWO_EDITS)

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.items: list[dict[int, int]] = [{}]
        self.steps: list[dict[str, int]] = [{}]
        self.accepted: list[tuple[int, int] | None] = [None]
        #: the best stem that is read: edits, and its length negated, before its number
        self.stem: list[tuple[int, int, int] | None] = [None]
        self.entries = 0
        self.start = self._state({0: 0})

    def _state(self, items: dict[int, int]) -> int:
        """The state of these nodes and edits, after skipping letters of the terms."""
        todo = list(items)
        while todo:
            node = todo.pop()
            spent = items[node] + 1
            for child in self.children[node].values():
                if spent <= self.budget[child] and spent < items.get(child, 9):
                    items[child] = spent
                    todo.append(child)
        key = frozenset(items.items())
        if key not in self.states:
            self.states[key] = len(self.items)
            self.items.append(items)
            self.steps.append({})
            self.entries += len(items)
            words, stems = (
                [(e, -len(self.terms[t]), t) for n, e in items.items() if (t := at[n]) >= 0 and e <= self.edits_of(self.terms[t])]
                for at in (self.term_at, self.stem_at)
            )
            self.accepted.append((min(words)[2], min(words)[0]) if words else None)
            self.stem.append(min(stems, default=None))
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        items: dict[int, int] = {}

        def reach(node: int, spent: int) -> None:
            if spent <= self.budget[node] and spent < items.get(node, 9):
                items[node] = spent

        for node, spent in self.items[state].items():
            reach(node, spent + 1)
            for letter, child in self.children[node].items():
                reach(child, spent + (letter != c))
        return self._state(items)

    def match(self, word: str) -> tuple[int, int] | None:
        """The nearest term within its edits, and the edits; the longer term first.

        A stem counts if the word begins with it and is none of the terms, or
        if the word is near no term and what it begins with is near the stem.
        """
        if self.entries > STATE_ENTRIES:
            self._reset()
        state, steps, stem = self.start, self.steps, None
        for c in word:
            if c not in self.letters:
                c = ""
            following = steps[state].get(c)
            if following is None:
                following = steps[state][c] = self._step(state, c)
            if not following:
                state = 0
                break
            state = following
            best = self.stem[state]
            # a word shorter than the stem is none of its words
            if best and len(word) > -best[1] - 2 and (stem is None or best < stem):
                stem = best
        found = self.accepted[state]
        if stem and (found is None or found[1] and not stem[0]):
            return stem[2], stem[0]
        return found


# --- features -----------------------------------------------------------------------------


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    #: weights of a term by edits
    weights: list[tuple[float, ...]] = field(default_factory=list)
    context: dict[str, float] = field(default_factory=dict)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    coefficients: np.ndarray | None = None


FEATURES = 7


class Scorer:
    def __init__(self, model: Model):
        self.model, self.lexicon = model, FuzzyLexicon(model.terms)
        self.known: dict[str, tuple[int, int] | None] = {}

    def hit(self, word: str) -> tuple[int, int] | None:
        if word not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[word] = self.lexicon.match(word)
        return self.known[word]

    def hits(self, text: str) -> Iterator[tuple[int, int, list[str], bool]]:
        """Term, edits, context words and whether it is quoted, of each hit."""
        for part in slices_of(text):
            lower = part.lower()
            found = _WORD.findall(lower)
            if not any(self.hit(w) for w in set(found)):
                continue
            spans = list(_WORD.finditer(lower))
            for i, m in enumerate(spans):
                if got := self.hit(m.group()):
                    near = [s.group() for s in spans[max(0, i - WINDOW) : i] + spans[i + 1 : i + 1 + WINDOW]]
                    before = lower[spans[max(0, i - WINDOW)].start() : m.start()]
                    after = lower[m.end() : spans[min(len(spans) - 1, i + WINDOW)].end()]
                    yield *got, near, bool(_QUOTES & set(before)) and bool(_QUOTES & set(after))

    def features(self, text: str) -> list[float]:
        exact = fuzzy = quoted = context = best = 0.0
        hits = 0
        for term, edits, near, in_quotes in self.hits(text):
            weight = self.model.weights[term][edits]
            if weight <= 0:  # misspellings of this kind were no worse than other words
                continue
            hits += 1
            if in_quotes:
                quoted += weight
            elif edits:
                fuzzy += weight
            else:
                exact += weight
            best = max(best, weight)
            context += sum(self.model.context.get(w, 0.0) for w in near) / max(1, len(near))
        log = np.log1p
        return [log(exact), log(fuzzy), log(quoted), best, context / max(1, hits), log(hits), float(hits > 0)]


_SCORERS: dict[int, Scorer] = {}


def _scorer_of(model: Model) -> Scorer:
    """One scorer a task for its model."""
    if id(model) not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[id(model)] = Scorer(model)
    return _SCORERS[id(model)]


# --- learning -----------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column) -> DataFrame:
    """``text, label`` of at most MAX_LABELLED labelled documents, by the hash of their ids."""
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & label.isNotNull())
        .select(F.col("doc_id").alias("_id"), label.cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(MAX_LABELLED)
    )
    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "label")


def _tally(batches: Iterator[pa.RecordBatch], keys_of) -> Iterator[pa.RecordBatch]:
    """Documents of either label that have each key."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[label > 0].update(keys_of(text.as_py()))
    keys = sorted(set(counts[0]) | set(counts[1]))
    yield pa.record_batch(
        {
            "word": pa.array(keys, pa.string()),
            "clean": pa.array([counts[0][k] for k in keys], pa.int64()),
            "toxic": pa.array([counts[1][k] for k in keys], pa.int64()),
        }
    )


def tallied(sample: DataFrame, keys_of) -> DataFrame:
    """``word, clean, toxic``: documents by label, for the distinct keys that ``keys_of`` gives of a text."""
    parts = sample.mapInArrow(lambda batches: _tally(batches, keys_of), "word string, clean long, toxic long")
    return parts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _words(text: str) -> set[str]:
    words = {w for part in slices_of(text) for w in _WORD.findall(part.lower()) if len(w) >= 3}
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


def _contexts(text: str, words: frozenset[str]) -> set[str]:
    """Occurrences of words and stems: which, the word itself, and the words before and after."""
    out = set()
    for part in slices_of(text):
        found = ["", *_WORD.findall(part.lower()), ""]
        for a, w, b in zip(found, found[1:], found[2:]):
            for term in (w, *(f"{w[:k]}*" for k in STEMS if len(w) > k)):
                if term in words:
                    out.add(f"{term} {w} {a} {b}")
    return out


def _log_odds(clean: int, toxic: int) -> Column:
    """Log odds of a word in toxic against other documents, and its certainty."""
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (F.greatest(F.lit(toxic) - F.col("toxic"), F.lit(0)) + 0.5)) - F.log(
        b / (F.greatest(F.lit(clean) - F.col("clean"), F.lit(0)) + 0.5)
    )
    return F.struct(odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))


def _telling(counts: DataFrame, clean: int, toxic: int) -> DataFrame:
    """The words that speak for toxicity, the surest first; words of the sample, so no more than it has."""
    return (
        counts.filter(F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("o", _log_odds(clean, toxic))
        .filter((F.col("o.z") >= CERTAIN) & (F.col("o.odds") >= LEAST_ODDS))
        .orderBy(F.desc("o.z"), "word")
    )


def learn(docs: DataFrame, labels: DataFrame, label: Column) -> Model:
    """Fit lexicon, context words and score on a bounded sample of the labelled documents."""
    sample = settled(labelled_sample(docs, labels, label))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy((F.col("label") > 0).alias("toxic")).count().collect()}
    clean, toxic = sizes.get(False, 0), sizes.get(True, 0)
    if not clean or not toxic:
        return Model()
    single = settled(sample.dropDuplicates())
    candidates = frozenset(r["word"] for r in _telling(tallied(single, _words), clean, toxic).collect())
    # a word in one context counts once, whatever the number of copies
    contexts = tallied(single, lambda text: _contexts(text, candidates)).select(
        F.substring_index("word", " ", 1).alias("word"),
        F.substring_index(F.substring_index("word", " ", 2), " ", -1).alias("itself"),
        (F.col("clean") > 0).cast("long").alias("clean"),
        ((F.col("toxic") > 0) & (F.col("clean") == 0)).cast("long").alias("toxic"),
    )
    kinds = (
        contexts.groupBy("word")
        .agg(
            F.sum("clean").alias("clean"),
            F.sum("toxic").alias("toxic"),
            F.count_distinct(F.when(F.col("toxic") > 0, F.col("itself"))).alias("words"),
        )
        .filter(~F.col("word").endswith("*") | (F.col("words") >= STEM_WORDS))
    )
    found = []
    for r in _telling(kinds, clean, toxic).select("word", "o.odds").collect():
        # the surest first; of nested stems one is enough, words keep their own automata beside it
        nested = r["word"].endswith("*") and any(r["word"].startswith(w[:-1]) for w, _ in found if w.endswith("*"))
        if not nested:
            found.append((r["word"], r["odds"]))
    model = Model([w for w, _ in found], [(odds,) * 3 for _, odds in found])

    def around(text: str) -> set[str]:
        scorer = _scorer_of(model)
        out = set()
        for term, edits, near, _ in scorer.hits(text):
            out.add(f"{term} {edits}")
            out.update(near)
            out.add("")
        return out

    near = settled(tallied(single, around))
    kinds_of_hits = {r["word"]: (r["clean"], r["toxic"]) for r in near.filter("word like '% %'").collect()}  # 3 a term
    for i, (_, odds) in enumerate(found):
        weights = [odds]
        for edits in (1, 2):
            c, t = kinds_of_hits.get(f"{i} {edits}", (0, 0))
            meant = np.log((t + 1) / (toxic + 2)) - np.log((c + 0.25) / (clean + 0.5))
            weights.append(float(np.clip(meant, 0, odds * 0.8**edits)))
        model.weights[i] = tuple(weights)
    total = near.filter("word = ''").first()
    if total is not None and total["clean"] and total["toxic"]:
        context = (
            near.filter("word <> '' and word not like '% %'")
            .withColumn("o", _log_odds(total["clean"], total["toxic"]))
            .filter(F.abs("o.z") >= CERTAIN)
            .select("word", "o.odds")
            .collect()
        )
        terms = set(model.terms)
        model.context = {r["word"]: r["odds"] for r in context if r["word"] not in terms}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer_of(model)
        for batch in batches:
            rows = [scorer.features(t.as_py()) for t in batch.column(0)]
            yield pa.record_batch({"x": pa.array(rows, pa.list_(pa.float64())), "label": batch.column(1)})

    rows = sample.mapInArrow(featured, "x array<double>, label int").toPandas()  # MAX_LABELLED rows at most
    _fit(model, np.array(rows["x"].to_list(), float).reshape(-1, FEATURES), (rows["label"] > 0).to_numpy(float))
    return model


def _fit(model: Model, x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> None:
    """Penalised logistic regression by Newton steps."""
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[0, 0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.coefficients = w


def score(docs: DataFrame, model: Model, more: list[Column] | None = None) -> DataFrame:
    """``doc_id, score`` (and ``more``) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: words of MAX_LABELLED documents
    rows = docs.select(F.col("doc_id"), *(more or []), whole_text().alias("_text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        fitted = shared.value
        for batch in batches:
            if fitted.coefficients is None:
                scores = np.zeros(batch.num_rows)
            else:
                x = np.array([scorer.features(t.as_py()) for t in batch.columns[-1]]).reshape(-1, FEATURES)
                line = fitted.coefficients[0] + (x - fitted.mean) / fitted.scale @ fitted.coefficients[1:]
                scores = 1 / (1 + np.exp(-np.clip(line, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "score"]
            )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(scored, shape + ", score double")


FOLDS, HELD_OUT = 4, 2


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(fold_of("doc_id", FOLDS) != HELD_OUT)
    model = learn(docs, labels, F.col("toxic"))
    held_out = (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return score(docs, model, [held_out]).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
