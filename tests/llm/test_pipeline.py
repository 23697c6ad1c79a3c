"""The pipeline against a brute-force version on planted documents."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from llm.brute import components, fingerprint, mixed, near

import corpus_pipeline
from paneltrend.llm.byte_bpe import read_ranks

LANGUAGES = {"aa": ["the", "ing", "er", "th", "on"], "bb": ["schö", "keit", "ung", "ver", "zu"]}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted():
    """Rows, and the ids that are left before mixing."""
    rng = random.Random(21)

    def prose(lang, n):
        return " ".join("".join(rng.choices(LANGUAGES[lang], k=rng.randint(1, 4))) for _ in range(n))

    rows, left = [], set()
    for i in range(80):
        lang = "aa" if i % 4 else "bb"
        rows.append([i, prose(lang, 80 + i), lang, "hot" if i % 2 else f"s{i % 3}"])
        left.add(i)
    texts = {r[0]: r[1] for r in rows}
    for k in range(10):  # exact copies: the largest id stays
        rows.append([100 + k, texts[5], "aa", "hot"])
    left -= {5}
    left.add(109)
    for k in range(8):  # near copies, of which some are within three bits: the smallest id stays
        words = texts[70].split()
        if k:
            words[rng.randrange(len(words))] += "er"
        rows.append([200 + k, " \t".join(words), "aa", "s1"])
        left.add(200 + k)
    texts = {r[0]: r[1] for r in rows if r[0] in left}
    roots = components(sorted(texts), near({i: fingerprint(t) for i, t in texts.items()}, 3))
    assert roots[200] == 70
    left = set(roots.values())
    rows += [[300, None, None, None], [301, "", "aa", "s1"], [302, "1 2 3 !!", "aa", "s1"], [303, "@@@", None, "s2"]]
    rows.append([304, "κόσμε " * 200, None, "s2"])
    rng.shuffle(rows)
    return [(*r, len(r[1] or "")) for r in rows], left


def test_pipeline_by_brute_force(spark, planted, tmp_path):
    rows, left = planted
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ranks = read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r[0]: r[1] for r in rows}
    kept = [(r[0], r[3], r[1]) for r in rows if r[0] in left]
    want = Counter(
        (i, tuple(library.encode_ordinary(text[i])), hashlib.sha256(text[i].encode()).hexdigest())
        for i in mixed(kept, 2.0)
    )
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in got) == want


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, "")
        assert out.columns == empty.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe"
    ]
