"""Operators on documents: odd rows, empty tables, clashing names, and brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.brute import components, fingerprint, near
from pyspark.sql import functions as F

from paneltrend.llm import byte_bpe, exact_dedup, html_main, language_id, mixing, simhash_golay, toxicity
from paneltrend.llm.components import connected

#: The last columns have names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, rest long, _digest string, key int"
RNG = random.Random(7)


def prose(n, syllables, rng=RNG):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


SYLLABLES = {"aa": ["the", "ing", "er", "th", "on"], "bb": ["schö", "keit", "ung", "ver", "zu"]}


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(60):
        lang = "aa" if i % 3 else "bb"
        rows.append((i, prose(40 + i, SYLLABLES[lang]), lang, f"s{i % 4}" if i % 5 else "s0", 1))
    rows += [
        (100, None, None, None, None),
        (101, "", "aa", "s1", 0),
        (102, "12 34 !!", "aa", "s1", 0),
        (103, rows[4][1], "aa", "s2", 1),
        (103, rows[4][1], "aa", "s2", 1),
        (104, rows[4][1] + " ", "aa", "s2", 1),
        (105, " \t\n", None, "s1", 3),
        (106, prose(30_000, SYLLABLES["aa"]), "aa", "s3", 1),
        (None, rows[5][1], "aa", "s1", 1),
        (107, "x" * 50_000, None, "s1", 1),
        (108, rows[10][1].replace("the", "THE", 1), "aa", "s1", 1),
    ]
    return spark.createDataFrame([(*r, "r", 1, "d", 0) for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# --- exact dedup


def test_exact_dedup_by_brute_force(docs):
    groups = defaultdict(list)
    for i, text in texts_of(docs):
        groups[text or ""].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        want.update((i, keep, len(ids), i == keep, digest) for i in ids)
    assert Counter(map(tuple, exact_dedup.exact_dedup(docs).collect())) == want
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter(groups.keys())


def test_equal_digests_of_unequal_texts_are_told_apart(spark):
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "bbb")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    dedup = exact_dedup.StreamingDedup(spark, digest=lambda text: F.length(text).cast("string"))
    found = dedup.add(df).groups(df).select("doc_id", "_keep", "_size")
    assert sorted(map(tuple, found.collect())) == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1), (5, 5, 1)]
    assert sorted(r["doc_id"] for r in dedup.kept(df).collect()) == [2, 3, 4, 5]


def test_state_outlives_a_run(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string")
    dedup = exact_dedup.StreamingDedup(spark).add(first)
    later = exact_dedup.StreamingDedup(spark, dedup.folder).add(second)
    state = {r["keep_id"]: r["group_size"] for r in later.state().collect()}
    assert state == {3: 2, 2: 1, 4: 1}
    assert all(r["locator"].endswith(f"#{r['keep_id']}") for r in later.state().collect())


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.keep_one(nothing).columns == nothing.columns


# --- SimHash


def test_simhash_by_brute_force(docs):
    rows = texts_of(docs)
    prints = {i: fingerprint(t) for i, t in rows if i is not None}
    want = components(list(prints), near(prints, 3))
    got = simhash_golay.simhash_components(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] == want[5]
        else:
            assert (r["fp"] & (1 << 64) - 1, r["component_id"]) == (prints[r["doc_id"]], want[r["doc_id"]])


@pytest.mark.parametrize("split", [50_000, 40])
def test_links_within_three_bits_are_never_missed(spark, split):
    """Also where buckets are dealt in blocks."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12)
    prints = set()
    for c in centres.tolist():
        for _ in range(70):
            flips = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
            prints.add(c ^ flips)
    prints = sorted(p - (1 << 64) if p >= 1 << 63 else p for p in prints)
    nodes = spark.createDataFrame([(p, p) for p in prints], "node long, fp long")
    want = components(prints, near({p: p & (1 << 64) - 1 for p in prints}, 3))
    old = simhash_golay.COUNTED
    simhash_golay.COUNTED = 1
    try:
        got = {r["node"]: r["root"] for r in simhash_golay.linked_components(nodes, 3, 3, split).collect()}
    finally:
        simhash_golay.COUNTED = old
    assert {p: got.get(p, p) for p in prints} == want


@given(st.integers(0, (1 << 23) - 1), st.lists(st.integers(0, 22), max_size=2))
@settings(max_examples=300, deadline=None)
def test_words_two_bits_apart_share_a_golay_index(word, bits):
    other = word
    for b in set(bits):
        other ^= 1 << b
    indices, has = simhash_golay.golay_indices(np.array([word, other]))
    assert set(indices[0][has[0]]) & set(indices[1][has[1]])


def test_one_document_of_each_group_stays(spark):
    """Against a brute-force version: near copies with one, two or more changed words, null and repeated texts."""
    rng = random.Random(5)
    rows = []
    for i in range(25):
        base = prose(900, SYLLABLES["aa"] + SYLLABLES["bb"], rng).split()
        rows.append((10 * i + 9, " ".join(base)))
        for k, changes in enumerate((1, 1, 2, 5, 60)):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(900)] = "changed"
            rows.append((10 * i + k, " ".join(copy)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "lone"), (None, rows[0][1]), (None, "words that nobody else has")]
    want = components(range(len(rows)), near({n: fingerprint(t) for n, (_, t) in enumerate(rows)}, 3))
    groups = defaultdict(list)
    for n, root in want.items():
        groups[root].append(rows[n][0])
    left = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=lambda i: (i is None, i or 0))
    assert 30 < len(left) < len(rows) - 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [r["doc_id"] for r in simhash_golay.keep_one(df).collect()]
    assert sorted(kept, key=lambda i: (i is None, i or 0)) == left


def test_a_repeated_id_loses_only_the_text_that_has_a_near_copy(spark):
    rng = random.Random(6)
    a, b, c = (prose(200, SYLLABLES["aa"] + SYLLABLES["bb"], rng) for _ in range(3))
    # white space and capitals are not part of a fingerprint
    rows = [(1, a), (5, a + " "), (5, b), (7, b.upper().lower() + "\n"), (8, c), (8, c), (9, c + " "), (9, " " + c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, simhash_golay.keep_one(df).collect()))
    assert kept == sorted([rows[0], rows[2], rows[4], rows[5]])


def test_simhash_of_nothing(nothing):
    assert simhash_golay.simhash_components(nothing).count() == 0
    assert simhash_golay.keep_one(nothing).columns == nothing.columns


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(200, 201), (201, 202), (202, 200)]
    links += [(300 + rng.randrange(80), 300 + rng.randrange(80)) for _ in range(60)] + [(5, 5), (400, 401), (400, 401)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["root"] for r in connected(df).collect()}
    nodes = {n for link in links for n in link}
    assert {n: got.get(n, n) for n in nodes} == components(sorted(nodes), links)


# --- BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(docs, ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK_TOKENS", 500)
    got = byte_bpe.decode(byte_bpe.encode(docs, ranks), ranks, keep_ids=True).collect()
    want = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in texts_of(docs))
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    both = byte_bpe.encode(docs, ranks, decoded=True).collect()
    digests = Counter((r["doc_id"], tuple(r["ids"]), hashlib.sha256(bytes(r["decoded"])).hexdigest()) for r in got)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in both) == digests


@given(st.text(max_size=200))
@settings(max_examples=200, deadline=None)
def test_pre_tokens_and_merges_of_any_text(text):
    ranks, library = _LIBRARY
    words = byte_bpe.regex.findall(public_tokenizers.PATTERN, text)
    ids = [i for w in words for i in byte_bpe.merge(w.encode(), ranks)]
    assert ids == library.encode_ordinary(text)
    assert byte_bpe.TokenBytes(ranks).join(np.array(ids, np.int64)) == text.encode()


_RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
_LIBRARY = _RANKS, tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_RANKS, special_tokens={}
)


def test_an_unknown_id_fails(ranks):
    with pytest.raises(ValueError, match="token-byte table"):
        byte_bpe.TokenBytes(ranks).join(np.array([60_000]))


def test_bpe_of_nothing(nothing, ranks):
    assert byte_bpe.decode(byte_bpe.encode(nothing, ranks), ranks, digest=True).count() == 0


# --- language


def test_languages_are_told_and_odd_texts_rejected(docs):
    found = language_id.train(language_id.training_rows(docs))
    got = {r["doc_id"]: r for r in language_id.identify(docs, found).collect()}
    assert all(got[i]["lang_pred"] == ("aa" if i % 3 else "bb") and got[i]["accepted"] for i in range(60))
    assert all(got[i]["lang_pred"] == "und" and not got[i]["accepted"] for i in (100, 101, 102, 105))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert not got[107]["accepted"]
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    gone = {100, 101, 102, 105, 107}
    assert Counter(map(tuple, kept.collect())) == Counter(tuple(r) for r in docs.collect() if r["doc_id"] not in gone)


def test_language_without_labels_or_rows(spark, nothing, docs):
    assert language_id.keep_identified(nothing).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    found = language_id.train(unlabelled)
    assert {r["lang_pred"] for r in language_id.identify(unlabelled, found).collect()} == {"und"}


def test_every_counted_gram_is_in_the_model(spark):
    rng = random.Random(12)
    letters = [chr(c) for c in range(0x4E00, 0x9000)]
    rows = [(i, " ".join("".join(rng.choices(letters, k=3)) for _ in range(2000)), "zz") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    grams = np.unique(language_id.grams_of(sorted({w for r in rows for w in r[1].split()}))[0])
    assert len(grams) > 300_000
    (model,) = language_id.train(df).models
    assert np.array_equal(np.sort(language_id.hashed(grams)), model.grams[3])


def test_usual_entropies_are_of_all_documents_and_languages(spark):
    """Also in a table ordered by language."""
    rng = random.Random(13)
    rows = [(i, prose(8, SYLLABLES["aa"], rng), "aa") for i in range(4100)]
    rows += [(5000 + i, prose(150, SYLLABLES["bb"], rng), "bb") for i in range(40)]
    rows += [(6000 + i, prose(150, ["qua", "zix", "pyn", "kli"], rng), "cc") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    found = language_id.train(df)
    assert set(found.usual) == {"aa", "bb", "cc"}
    again = language_id.train(df.orderBy(F.desc("doc_id")))
    assert all(again.usual[lang] == pytest.approx(own) for lang, own in found.usual.items())
    junk = [(1, "ü" * 400), (2, "q" * 400), (3, rows[-1][1]), (4, rows[4100][1])]
    judged = language_id.identify(spark.createDataFrame(junk, "doc_id long, text string"), found).collect()
    assert {r["doc_id"]: r["accepted"] for r in judged} == {1: False, 2: False, 3: True, 4: True}


def test_kneser_ney_probabilities_sum_to_one():
    grams, _ = language_id.grams_of(["abba", "abc", "cab", "baa"])
    keys, counts = np.unique(grams, return_counts=True)
    model = language_id.kneser_ney(keys, counts, 4)
    letters = np.array([ord("a"), ord("b"), ord("c"), 2], np.uint64)
    for context in ("\1\1\1", "\1ab", "abb", "zzz"):
        high = sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context))
        assert np.exp(model.score(letters | np.uint64(high))).sum() == pytest.approx(1)


# --- mixing


def test_mixing_weights_budget_and_whole_sources(docs):
    mixed = mixing.mix(docs, max_repeats=2.0).collect()
    tokens = defaultdict(int)
    for r in docs.collect():
        tokens[r["source"]] += -(-len((r["text"] or "").encode()) // 4)
    spent, weight = defaultdict(int), {}
    for r in mixed:
        spent[r["source"]] += r["n_tokens"]
        weight[r["source"]] = r["mix_weight"]
    assert sum(weight.values()) == pytest.approx(1)
    longest = max(r["n_tokens"] for r in mixed)
    total = max(tokens[s] / w for s, w in weight.items() if w)
    for s, w in weight.items():
        if w:
            assert total * w - longest <= spent[s] <= total * w + 1
            assert tokens[s] <= spent[s] <= 2.001 * tokens[s]
    rows = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert Counter((r["doc_id"], r["text"]) for r in mixed if r["epoch"] == 0) == rows
    assert {c: 1 for c in docs.columns}.keys() <= mixed[0].asDict().keys()


def test_mixing_meets_entropy_and_smaller_budgets(docs):
    mixed = mixing.mix(docs, max_repeats=None, target_entropy=1.2, budget=3000).collect()
    weight = {r["source"]: r["mix_weight"] for r in mixed if r["mix_weight"]}
    assert sum(-w * np.log(w) for w in weight.values()) >= 1.2 - 1e-3
    spent = sum(r["n_tokens"] for r in mixed)
    assert spent <= 3000


def test_mixing_is_the_same_each_time_and_of_nothing(docs, nothing):
    def rows(df):
        return Counter((r["doc_id"], r["epoch"], r["block"]) for r in df.collect())

    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs.repartition(7)))
    assert mixing.mix(nothing).count() == 0


# --- toxicity


def test_fuzzy_lexicon_equals_edit_distance():
    terms = ["cat", "idiot", "worthless", "disgusting", "idiom"]
    lexicon = toxicity.FuzzyLexicon(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(1)
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            rng.choice([lambda: word.insert(at, rng.choice("abdiotx1")), lambda: word.pop(at - 1) if word else 0])()
        word = "".join(word)
        within = [(d, -len(t)) for t in terms if (d := distance(word, t)) <= toxicity.FuzzyLexicon.edits_of(t)]
        got = lexicon.match(word)
        assert (got is None) == (not within)
        if got:
            assert (got[1], -len(terms[got[0]])) == min(within)


def test_toxic_terms_misspellings_and_odd_rows(spark, nothing):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(200):
        words = prose(60, SYLLABLES["aa"], rng).split()
        if i % 4 == 0:
            words[rng.randrange(60)] = rng.choice(["blockhead", "nitwit"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(300, "you bl0ckhead there"), (301, "you nitwitt"), (302, None), (303, ""), (304, rows[1][1]), (305, "the " * 50_000)]
    labels += [(302, None), (None, 1), (999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("toxic"))
    assert set(model.terms) == {"blockhead", "nitwit"}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(200))
    assert min(got[300], got[301]) >= 0.3 > max(got[302], got[303], got[304], got[305])
    assert got[302] == got[303]
    empty = toxicity.learn(nothing, spark.createDataFrame([], "doc_id long, toxic int"), F.col("toxic"))
    assert {r["score"] for r in toxicity.score(docs, empty).collect()} == {0.0}
    assert toxicity.score(nothing, model).count() == 0


def test_misspellings_of_inflected_terms_hit_beside_their_stem(spark):
    lexicon = toxicity.FuzzyLexicon(["idio*", "idiot", "idiots", "idiotic"])
    assert [lexicon.match(w) for w in ("idiot", "idiocy", "1diot", "idixts")] == [(1, 0), (0, 0), (1, 1), (2, 1)]
    assert all(lexicon.match(w) for w in ("idoit", "iidiot", "1diocy"))
    assert not any(lexicon.match(w) for w in ("ido", "radio", "the", "patriot"))
    rng = random.Random(19)
    rows = []
    for i in range(300):
        words = prose(60, SYLLABLES["aa"], rng).split()
        if i % 4 == 0:
            words[rng.randrange(60)] = rng.choice(["idiot", "idiots", "idiotic"])
        rows.append((i, " ".join(words)))
    odd = ["1diot", "idoit", "iidiot", "1diotic"]
    docs = spark.createDataFrame(rows + [(1000 + i, f"you {w} there") for i, w in enumerate(odd)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, F.col("toxic"))
    assert {"idiot", "idiots", "idiotic"} <= set(model.terms)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert min(got[1000 + i] for i in range(len(odd))) >= 0.3
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in range(300))


def test_quotation_lowers_a_hit():
    model = toxicity.Model(["nitwit"], [(3.0, 2.0, 1.0)], {})
    scorer = toxicity.Scorer(model)
    plain, quoted = scorer.features("he is a nitwit of a man"), scorer.features('she said "he is a nitwit" to us')
    assert plain[0] > 0 == plain[2] and quoted[2] > 0 == quoted[0]


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><div>{0}</div></body>",
        "<body><div class='content no-sidebar'>{0}</div><div class='sidebar'>aside</div></body>",
        "<body><article id='social-history'>{0}</article></body>",
        "<body><article><h2 id='related-work'>{0}</h2></article></body>",
    ],
)
def test_names_alone_make_no_aside_of_the_article(page):
    assert html_main.main_text(page.format("The whole text of the article. " * 5)) == ("The whole text of the article. " * 5).strip()
