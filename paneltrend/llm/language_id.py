"""Language identification with interpolated Kneser-Ney character models.

Each language has a model of order 4 over the letters of words: ``^^^word$``,
every letter and the end predicted from the three characters before it.  The
4-gram counts of all training documents are summed by Spark; the counts of
lower orders are continuation counts, the discounts are n1 / (n1 + 2 n2) of
each order, and probabilities are interpolated down to a uniform one.  A model
is kept as arrays of hashes in ascending order beside log probabilities and
back-off weights, and read by binary search.

The language of least cross-entropy per predicted character is chosen.  A
document is rejected if it has no letter, or if that entropy exceeds what
documents of the language have: their median and ``REJECT`` spreads more, the
spread being widened for short texts.

Every counted 4-gram is in its model, whatever its count; a model takes 16
bytes a gram of each order and grows with the different 4-grams of its
language, not with the texts.  Median and spread are taken from all training
documents of a language; one with fewer than ``FEW`` long documents has the
spread of all languages together, and the larger of both medians.

Defined results: null, empty and letterless texts are ``und`` with score 0 and
rejected; without any training document all are; ties between languages go to
the first by name; repeated rows are predicted each; an empty table gives an
empty result; other columns are ignored or, in ``keep_identified``, passed
through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import fold_of, lean, settled, table, whole_text

ORDER = 4
#: Letters of a long document, and long documents of a language that give a spread of their own.
LONG, FEW = 200, 10
#: Relative error of percentiles is one in so many.
PERCENTILE_ACCURACY = 10_000
#: Spreads above the median from which a document is rejected.
REJECT = 8.0
#: Least spread of a language, in nats a character.
LEAST_SPREAD = 0.1
#: Variance of one character's log probability (nats squared) that widens the spread of short texts.
CHARACTER_VARIANCE = 6.0
#: Characters beyond which more text does not raise the score.
SCORE_CHARACTERS = 60
#: Characters of text handled at a time.
SLICE = 500_000
#: Distinct words of a language that a task counts before it turns them into 4-grams.
FOLD_WORDS = 60_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_OTHER = re.compile(r"[\W\d_]")
#: Multiplier of the (bijective) gram hash; odd.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_START, _END = 1, 2


def words_of(text: str) -> Iterator[list[str]]:
    """The lower-case words of a text, a slice at a time; slices end between words."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            other = _OTHER.search(text, end)
            end = other.start() if other else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All 4-grams of the padded words, and the number of the word each is of."""
    head, tail = chr(_START) * (ORDER - 1), chr(_END)
    text = tail + head + (tail + head).join(words) + tail if words else ""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    # characters beyond the basic plane share its codes
    codes = (codes ^ (codes >> np.uint64(16) << np.uint64(5))) & np.uint64(0xFFFF)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = codes[3:] | codes[2:-1] << np.uint64(16) | codes[1:-2] << np.uint64(32) | codes[:-3] << np.uint64(48)
    word = np.cumsum(codes == _END)[3:]
    real = codes[3:] != _START
    ends = codes[3:] == _END
    return grams[real], (word - ends - 1)[real]


def hashed(grams: np.ndarray) -> np.ndarray:
    return grams * _MIX


# --- training -----------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """4-gram counts of a task's texts by language."""
    words: dict[str, dict[str, int]] = {}
    grams: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def fold(lang: str) -> None:
        gram, word = grams_of(list(words[lang]))
        times = np.fromiter(words[lang].values(), np.int64, len(words[lang]))[word]
        parts = [*grams.get(lang, []), (gram, times)]
        keys, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)
        grams[lang], words[lang] = [(keys, counts)], {}

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = words.setdefault(lang, {})
            for found in words_of(text.as_py()):
                for w in found:
                    own[w] = own.get(w, 0) + 1
            if len(own) > FOLD_WORDS:
                fold(lang)
    for lang in list(words):
        fold(lang)
        ((keys, counts),) = grams.pop(lang)
        yield pa.record_batch(
            {
                "lang": pa.array([lang]).take(pa.array(np.zeros(len(keys), np.int32))),
                "gram": pa.array(keys.view(np.int64)),
                "n": pa.array(counts),
            }
        )


def gram_counts(labelled: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """``lang, gram, n`` over all labelled documents."""
    rows = labelled.filter(F.col(lang_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), whole_text(text_column).alias("text")
    )
    return rows.mapInArrow(lean(_count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class KneserNey:
    """Per order: hashes in ascending order, log probabilities; and for contexts log back-off weights."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    base: float

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Natural log probabilities of the last characters of 4-grams."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            gram = _last(grams[left], k)
            at, found = _find(self.grams[k - 1], hashed(gram))
            out[left[found]] += self.logs[k - 1][at[found]]
            left, gram = left[~found], gram[~found]
            at, found = _find(self.contexts[k - 1], hashed(gram >> np.uint64(16)))
            out[left[found]] += self.backoffs[k - 1][at[found]]
        out[left] += self.base
        return out


def _last(grams: np.ndarray, k: int) -> np.ndarray:
    return grams & np.uint64((1 << 16 * k) - 1)


def _find(array: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(array):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(array, keys), len(array) - 1)
    return at, array[at] == keys


def kneser_ney(grams: np.ndarray, counts: np.ndarray, characters: int) -> KneserNey:
    """The model of 4-gram counts; ``characters`` is the size of the uniform base."""
    levels = [(grams, counts.astype(np.float64))]
    for k in range(ORDER - 1, 0, -1):
        # a lower order counts the different characters before each gram
        keys, n = np.unique(_last(levels[0][0], k), return_counts=True)
        levels.insert(0, (keys, n.astype(np.float64)))
    out = KneserNey([], [], [], [], -float(np.log(characters)))
    lower = np.array([]), np.array([])
    for k, (keys, n) in enumerate(levels, 1):
        once, twice = (n == 1).sum(), (n == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        context, of = np.unique(keys >> np.uint64(16), return_inverse=True)
        total = np.bincount(of, n)
        weight = discount * np.bincount(of) / total
        if k == 1:
            below = np.full(len(keys), 1.0 / characters)
        else:
            below = lower[1][np.searchsorted(lower[0], _last(keys, k - 1))]
        p = np.maximum(n - discount, 0) / total[of] + weight[of] * below
        lower = keys, p
        for held, value, names in ((keys, p, (out.grams, out.logs)), (context, weight, (out.contexts, out.backoffs))):
            h = hashed(held)
            order = np.argsort(h)
            names[0].append(h[order])
            names[1].append(np.log(value[order]))
    return out


@dataclass
class Languages:
    names: list[str]
    models: list[KneserNey]
    #: median and spread of the entropies of each language's documents
    usual: dict[str, tuple[float, float]]


def train(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> Languages:
    """Models of all languages of ``docs``, with their usual entropies."""
    counts = settled(gram_counts(docs, lang_column, text_column))
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    characters = counts.select(F.col("gram").bitwiseAND(0xFFFF)).distinct().count() + 100
    models = []
    for name in names:  # one language at a time: its different 4-grams, 16 bytes each
        own = counts.filter(F.col("lang") == name).select("gram", "n").toArrow()
        grams = own["gram"].to_numpy().view(np.uint64)
        order = np.argsort(grams)
        models.append(kneser_ney(grams[order], own["n"].to_numpy()[order], characters))
    found = Languages(names, models, {})
    found.usual = _usual(docs.filter(F.col(lang_column).isNotNull()), found, lang_column, text_column)
    return found


def _usual(labelled: DataFrame, found: Languages, lang_column: str, text_column: str) -> dict[str, tuple[float, float]]:
    """Median and spread of the entropies of all labelled documents, by language."""
    of = F.col(lang_column).cast("string").alias("of")
    quartiles = F.percentile_approx("entropy", F.array(*map(F.lit, (0.25, 0.5, 0.75))), PERCENTILE_ACCURACY)
    # a row for each language, for long texts and for all of them, and the same over all languages
    told = (
        identify(labelled, found, None, text_column, [of])
        .filter("lang_pred = of and entropy is not null")
        .cube("of", (F.col("n_letters") >= LONG).alias("long"))
        .agg(F.count("*").alias("n"), quartiles.alias("q"))
        .collect()
    )
    at = {(r["of"], r["long"]): r for r in told}
    pool = at.get((None, True)) or at.get((None, None))
    usual = {}
    for name in found.names:
        own, middle = at.get((name, True)), 0.0
        if pool and (own is None or own["n"] < FEW):
            # models know their few documents too well to tell what others will have
            own, middle = pool, at[name, None]["q"][1] if (name, None) in at else 0.0
        if own:
            low, mid, high = own["q"]
            usual[name] = max(mid, middle), max((high - low) / 1.349, LEAST_SPREAD)
    return usual


# --- prediction ---------------------------------------------------------------------------

PREDICTED = "lang_pred string, score double, entropy double, n_letters long, accepted boolean"


def _predict(batches: Iterator[pa.RecordBatch], found: Languages) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        begin, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text.as_py())
            if size > SLICE or i == len(texts) - 1:
                part = batch.slice(begin, i + 1 - begin)
                columns = part.columns[:-1] + _predict_slice([t.as_py() for t in part.columns[-1]], found)
                names = batch.schema.names[:-1] + ["lang_pred", "score", "entropy", "n_letters", "accepted"]
                yield pa.RecordBatch.from_arrays(columns, names)
                begin, size = i + 1, 0


def _predict_slice(texts: list[str], found: Languages) -> list[pa.Array]:
    words: dict[str, int] = {}
    numbers, lettered = [], []
    for text in texts:
        own, letters = [], False
        for part in words_of(text):
            own.append(np.fromiter((words.setdefault(w, len(words)) for w in part), np.int64, len(part)))
            letters = letters or any(c.isalpha() for w in part for c in w)
        numbers.append(np.concatenate(own) if own else np.empty(0, np.int64))
        lettered.append(letters)
    gram, word = grams_of(list(words))
    distinct, where = np.unique(gram, return_inverse=True)
    predicted = np.bincount(word, minlength=len(words))
    scores = [np.bincount(word, m.score(distinct)[where], len(words)) for m in found.models]
    out = []
    for at, letters in zip(numbers, lettered):
        n = int(predicted[at].sum()) if len(at) else 0
        if not (letters and n and found.names):
            out.append((UNKNOWN, 0.0, None, n, False))
            continue
        entropy = np.array([-s[at].sum() / n for s in scores])
        best = int(np.argmin(entropy))
        score = 1 / np.exp((entropy[best] - entropy) * min(n, SCORE_CHARACTERS)).sum()
        middle, spread = found.usual.get(found.names[best], (np.inf, 0.0))
        limit = middle + REJECT * np.sqrt(spread**2 + CHARACTER_VARIANCE / n)
        out.append((found.names[best], float(score), float(entropy[best]), n, bool(entropy[best] <= limit)))
    kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())
    return [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]


def identify(
    docs: DataFrame,
    found: Languages,
    id_column: str | None = "doc_id",
    text_column: str = "text",
    more: list | None = None,
) -> DataFrame:
    """``id, lang_pred, score, entropy, n_letters, accepted`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(found)  # grows with the different 4-grams of the languages
    kept = [*([F.col(id_column)] if id_column else []), *(more or [])]
    rows = docs.select(*kept, whole_text(text_column).alias("_text"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(lean(lambda batches: _predict(batches, shared.value)), ", ".join(x for x in (shape, PREDICTED) if x))


HELD_OUT_FOLDS = 5


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold_of("doc_id", HELD_OUT_FOLDS) != 0)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = train(training_rows(docs))
    held_out = (fold_of("doc_id", HELD_OUT_FOLDS) == 0).alias("held_out")
    return identify(docs, found, "doc_id", "text", [held_out]).select(
        "doc_id", "held_out", "lang_pred", "score", "entropy", "accepted"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that are accepted, with all columns; a null ``lang`` is filled in."""
    found = train(training_rows(docs))
    names = docs.columns
    judged = identify(docs, found, None, "text", [F.struct(*names).alias("_row")])
    lang = F.coalesce("_row.lang", "lang_pred")
    return judged.filter("accepted").select(*((lang if n == "lang" else F.col(f"_row.{n}")).alias(n) for n in names))
