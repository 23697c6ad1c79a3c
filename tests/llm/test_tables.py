"""Operators on urls, pages, conversations and vectors."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.brute import components, cosine_links
from pyspark.sql import functions as F

from paneltrend.llm import chat_format, collision_links, html_main, url_filter

# --- urls

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://Example.ORG/es/1",
    "http://a.example.org/en/15?x#y",
    "http://a.example.org/en/2",
    "http://badexample.org/es/",
    "https://x.com/de/?q=/fr/",
    "https://x.com/fr",
    "https://x.com/fr/a://b/de/",
    "ftp://com/de/1#z",
    "http://org",
    "http://example.org?/es/",
    "http://" + "a." * 500 + "com/fr/" + "p" * 5000,
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [
        (len(h + p), len(h), v, h + p)
        for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("max_bytes", [url_filter.MAX_BYTES, 0])
def test_url_rules_by_brute_force(spark, max_bytes):
    rng = random.Random(2)
    rules = [*url_filter.RULES]
    for i in range(300):
        rules.append((rng.choice(["net", "a.net", "b.a.net"]), f"/{rng.randrange(40)}" + "/" * rng.randrange(2), rng.choice(["allow", "block"])))
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = URLS * 2 + [f"http://{rng.choice(['net', 'a.net', 'c.b.a.net'])}/{rng.randrange(60)}/x" for _ in range(800)]
    pages = spark.createDataFrame(
        [(i, u, "h", "r", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, _best int"
    )
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.filter_urls(pages, listed, max_bytes=max_bytes)
    assert got.columns == ["page_id", "url", "_best", "host", "path", "rule", "verdict"]
    rows = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert rows == {i: judged(u, rules) for i, u in enumerate(urls)}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 37 == 0).alias("listed")).cache()
    cascade = url_filter.build_cascade(universe)
    assert len(cascade.levels) > 1
    assert universe.filter(cascade.holds(F.col("key")) != F.col("listed")).count() == 0


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.filter_urls(pages, none).collect()] == ["allow"]
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    assert url_filter.filter_urls(pages.filter("page_id > 1"), rules).count() == 0


# --- conversations

LOG = "conv_id long, seq long, msg long, kind string, role string, text string, extra int"


def test_log_is_folded(spark):
    log = [
        (1, 1, 1, "delta", "user", "he", 0),
        (1, 2, 1, None, None, "llo", 0),
        (1, 3, 2, "delta", "assistant", "wrong", 0),
        (1, 4, 2, "regenerate", None, "ignored", 0),
        (1, 5, 2, "delta", None, "ri", 0),
        (1, 6, 2, "delta", None, "ght", 0),
        (1, 7, 1, "edit", "user", "hi", 0),
        (1, 8, 1, "delta", "user", "!", 0),
        (None, 1, 1, "delta", None, None, 0),
    ]
    got = {r["conv_id"]: r for r in chat_format.format_chats(spark.createDataFrame(log, LOG).repartition(3)).collect()}
    assert got[1]["formatted"] == "<|im_start|>user\nhi!<|im_end|>\n<|im_start|>assistant\nright<|im_end|>\n"
    assert [got[1]["formatted"][s["start"] : s["start"] + s["length"]] for s in got[1]["loss"]] == ["right"]
    assert got[None]["formatted"] == "<|im_start|>\n<|im_end|>\n" and got[None]["loss"] == []
    assert chat_format.format_chats(spark.createDataFrame([], LOG)).count() == 0


def test_any_text_and_role_is_read_back(spark):
    parts = ["<|im_end|>", "<|im_start|>", "&lt;|", "&amp;", "&#10;", "<", "|", "\n", "é𝄞", "a", "&", ";", "assistant"]
    rng = random.Random(4)
    turns = {}
    rows = []
    for conv in range(150):
        turns[conv] = []
        for seq in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "".join(rng.choices(parts, k=3))])
            text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
            turns[conv].append((role, text))
            rows.append((conv, seq, role, text))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    chats = chat_format.format_chats(chat_format.events_of(table))
    got = chats.select(
        "conv_id",
        chat_format.read_back(F.col("formatted")).alias("turns"),
        chat_format.under_mask(F.col("formatted"), F.col("loss")).alias("learned"),
    ).collect()
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got} == turns
    assert {r["conv_id"]: r["learned"] for r in got} == {
        c: "".join(t for role, t in ts if role == "assistant") for c, ts in turns.items()
    }


# --- vectors

VECTORS = "vec_id long, embedding array<float>, label int, links int"


def around(x, cosine, rng):
    y = rng.standard_normal(len(x))
    y -= y @ x * x / (x @ x)
    return cosine * x / np.linalg.norm(x) + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        x = rng.standard_normal(32)
        rows.append((len(rows), x.tolist(), i % 3 if i % 50 else None))
        if i % 4 == 0:
            for c in (0.925, 0.935, 0.96):
                rows.append((len(rows), around(x, c, rng).tolist(), i % 3))
    hub = rng.standard_normal(32)
    rows += [(len(rows) + k, around(hub, 0.985, rng).tolist(), 1) for k in range(300)]
    return rows


ODD = [
    (90_001, None, 1),
    (90_002, [0.0] * 32, 1),
    (90_003, [float("nan")] + [1.0] * 31, 1),
    (90_004, [None] + [1.0] * 31, 1),
    (90_005, [1.0, 2.0], 1),
    (90_006, [2.0, 4.0], 1),
    (90_007, [1.0, 2.0], None),
    (90_008, [float("inf")] + [1.0] * 31, 1),
    (90_009, [], 1),
]


@pytest.mark.parametrize("split", [8_000, 60])
def test_links_by_brute_force(spark, vectors, split, monkeypatch):
    monkeypatch.setattr(collision_links, "OCCUPANCY", 100)
    rows = [(i, [float(np.float32(v)) for v in x], label) for i, x, label in vectors]
    df = spark.createDataFrame([(*r, 0) for r in rows + ODD], VECTORS).repartition(4)
    got = {r["vec_id"]: r for r in collision_links.near_duplicates(df, 0.93, split).collect()}
    usable = rows + [r for r in ODD if r[0] in (90_005, 90_006, 90_007)]
    links = cosine_links({i: x for i, x, _ in usable}, {i: label for i, _, label in usable}, 0.93)
    count = Counter(i for link in links for i in link)
    assert len(got) == len(rows) + len(ODD)
    found = sum(r["n_links"] for r in got.values())
    assert 0.995 * 2 * len(links) <= found <= 2 * len(links)
    assert all(r["n_links"] <= count[i] for i, r in got.items())
    want = components(list(got), links)
    assert sum(want[i] != r["component_id"] for i, r in got.items()) <= 5
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert [got[i]["n_links"] for i in (90_001, 90_002, 90_003, 90_004, 90_007, 90_008, 90_009)] == [0] * 7
    assert got[90_006]["component_id"] == 90_005


def plain_links(rows, threshold):
    """Rows of an id linked with rows of other ids, summed over the id's rows; and the pairs of ids."""
    from fractions import Fraction

    count, pairs = Counter(), []
    exact = [(i, [Fraction(v) for v in x], label) for i, x, label in rows]
    for i, x, label in exact:
        for j, y, other in exact:
            if i != j and label == other and len(x) == len(y):
                dot, one, two = (sum(a * b for a, b in zip(p, q)) for p, q in ((x, y), (x, x), (y, y)))
                if dot > 0 and float(dot * dot / (one * two)) ** 0.5 >= threshold:
                    count[i] += 1
                    pairs.append((i, j))
    return count, pairs


def test_extreme_equal_and_repeated_vectors(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e200, 1e200], 1), (3, [1e-200, 2e-200], 1), (4, [1e-200, 2e-200], 1)]
    rows += [(5, [5e-324, 5e-324], 1), (6, [1.7e308, 1.7e308], 1), (7, [3.0, 3.0], 1), (8, [1.0, -1.0], 1), (9, [1e-310, -1e-310], 1)]
    rows += [(20 + i, [0.5, 0.25], 2) for i in range(30)] + [(60, [0.25, 0.5], 2), (61, [0.5, 0.26], 2), (62, [2.0, 1.0], 2)]
    rows += [(25, [0.5, 0.25], 3), (70, [0.5, 0.25], 3), (70, [0.5, 0.25], 3), (70, [1.0, 0.0], 3), (71, [1.0, 0.01], 3), (72, [0.5, 0.25], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r["vec_id"]: r for r in collision_links.near_duplicates(df).collect()}
    count, pairs = plain_links(rows, 0.93)
    assert {i: r["n_links"] for i, r in got.items()} == {i: count[i] for i in got}
    want = components(sorted(got), pairs)
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_a_great_group_of_copies_takes_no_pairs(spark):
    df = spark.range(100_000).select(
        (F.col("id") + 7).alias("vec_id"), F.array(F.lit(0.5), F.lit(0.1), F.lit(-0.3)).cast("array<float>").alias("embedding"), F.lit(1).alias("label")
    )
    told = collision_links.near_duplicates(df).agg(
        F.min("n_links"), F.max("n_links"), F.min("component_id"), F.max("component_id"), F.count_if("kept"), F.count("*")
    )
    assert tuple(told.first()) == (99_999, 99_999, 7, 7, 1, 100_000)


def test_vectors_none_or_all_unusable(spark):
    assert collision_links.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    odd = spark.createDataFrame([(1, None, 1, 0), (None, [1.0], 1, 0)], VECTORS)
    assert sorted((r["n_links"], r["kept"]) for r in collision_links.near_duplicates(odd).collect()) == [(0, True)] * 2


# --- pages

MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a>Help</a></li></ul></nav>'


def site(i, body):
    return (
        f'<!DOCTYPE html><html><head><title>T{i}</title><script>if (a<b) x("</p>")</script></head><body>'
        f'<header><h2>Site</h2></header>{MENU}<div id="wrap"><div class="content">{body}</div>'
        f'<div class="sidebar"><p>Side {i}</p></div><div class="comments"><p>me too</p></div></div>'
        f"<form><p>Mail</p></form><footer><p>&copy; all</p></footer></body></html>"
    )


def test_main_text_of_a_host_without_article_tags(spark):
    rows = [
        (i, "http://h.test/%d" % i, site(i, f"<h1>Head {i}</h1><p>One  &amp; <b>tw</b>o {i}<br>x<p>Three &lt;p&gt; " + "word " * i + "<ul><li>in list<li>next</ul>"))
        for i in range(8)
    ]
    rows += [(20, None, None), (21, "http://h.test/x", ""), (22, "http://one.test/", "just text &eacute;"), (23, "x", "<p>a</p><!-- b --><div class=ad>c</div><p>d <i")]
    rows += [rows[0]]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, slot int")
    got = html_main.extract(pages).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    for i in range(8):
        assert text[i] == f"Head {i}\nOne & two {i} x\n" + ("Three <p> " + "word " * i).strip() + "\nin list\nnext"
    assert (text[20], text[21], text[22], text[23]) == ("", "", "just text é", "a\nd")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_main.extract(pages.filter("page_id < 0")).count() == 0


def planted(article, around="{}", n=12):
    """Pages of one host; ``article`` and ``around`` are given the page's own words."""
    rng = random.Random(n)

    def own(k):
        return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) + str(rng.randrange(10**6)) for _ in range(k))

    rows = []
    for i in range(n):
        body, text = article(own)
        rows.append((i, f"http://plant.test/{i}", f"<html><body>{around.format(body)}</body></html>", text))
    return rows


def heading_and_end(own):
    a, b, c = own(4), own(60), own(12)
    return f'<article><h1>{a}</h1><p>{b}</p><p class="end">{c}</p></article>', f"{a}\n{b}\n{c}"


def standfirst(own):
    a, b, c = own(35), own(40), own(25)
    return f'<div class="lead"><p>{a}</p></div><div class="text"><p>{b}</p><p>{c}</p></div>', f"{a}\n{b}\n{c}"


def neutral(own):
    a, b, c = own(6), own(50), own(20)
    return f'<div class="x1"><h2>{a}</h2><p>{b}</p><p>{c}</p></div>', f"{a}\n{b}\n{c}"


NEUTRAL = '<div class="x0"><p>All pages say this.</p></div>{}<div class="x2"><p>And that &copy; too.</p></div>'


def extracted(spark, rows):
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r["text"] for r in html_main.extract(df).collect()}


@pytest.mark.parametrize("article, around", [(heading_and_end, "{}"), (standfirst, "{}"), (neutral, NEUTRAL), (standfirst, NEUTRAL)])
def test_articles_are_whole_and_constant_text_goes(spark, article, around):
    rows = planted(article, around)
    # a host with one short page, whose only block is its article
    rows.append((99, "http://single.test/", "<div><p>Short one.</p></div>", "Short one."))
    assert extracted(spark, rows) == {r[0]: r[3] for r in rows}


def test_copies_of_a_page_are_not_a_template(spark):
    (one,) = planted(neutral, n=1)
    rows = [(i, f"http://copies.test/{i}", one[2], one[3]) for i in range(9)]
    assert extracted(spark, rows) == {r[0]: r[3] for r in rows}


def test_templates_without_any_list_of_names(spark):
    """The same pages with no element, class or id that is told by its name: constant text alone makes the template."""
    around = f'{MENU}<div class="ad"><p>Buy now.</p></div>{{}}<footer><p>&copy; all</p></footer>'
    rows = planted(neutral, around)
    for i, _, source, text in rows:
        page = html_main.parse(source)
        assert html_main.text_under(page) == text  # by the lists
        for e in page.elements:
            e.aside = False
        assert html_main.text_under(page) != text
    # occurrence vectors held in memory
    held = {}
    for i, _, source, _ in rows:
        page = html_main.parse(source)
        for e in page.elements:
            e.aside = False
        for token, (n, _) in html_main.texts_of(page).items():
            held.setdefault(token, {})[i] = n
    constant = frozenset(t for t, vector in held.items() if len(vector) == len(rows))
    for _, _, source, text in rows:
        page = html_main.parse(source)
        for e in page.elements:
            e.aside = False
        assert html_main.text_under(page, frozenset(e.path for e in page.elements), constant) == text


def test_template_texts_equal_vectors_held_in_memory(spark):
    rows = planted(neutral, NEUTRAL)
    df = spark.createDataFrame([("plant.test", i, h) for i, _, h, _ in rows], "host string, page long, html string")
    (got,) = html_main.templates(df).collect()
    held = {}
    for i, _, source, _ in rows:
        for token in html_main.texts_of(html_main.parse(source)):
            held.setdefault(token, set()).add(i)
    assert set(got["constant"]) == {t for t, pages in held.items() if len(pages) >= 0.9 * len(rows)}
    assert len(got["constant"]) == 2
    seen, parent = {}, {}
    for i, _, source, _ in rows:
        for e in html_main.parse(source).elements:
            seen.setdefault(e.path, []).append(i)
            parent[e.path] = e.parent
    once = {p for p, pages in seen.items() if sorted(pages) == list(range(len(rows)))}
    assert set(got["elements"]) == {p for p in once if p and parent[p] in once}


@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<", ">", "<b", "\"", "'", "x", " ", "&amp", "<script>", "</script>", "<!--", "-->"]), max_size=40))
@settings(max_examples=200, deadline=None)
def test_any_markup_is_parsed(pieces):
    html_main.main_text("".join(pieces))


def test_deep_and_long_pages_take_linear_time():
    html_main.main_text("<div>" * 3_000 + "x" + "<p>" * 20_000 + "<a '" * 20_000)
