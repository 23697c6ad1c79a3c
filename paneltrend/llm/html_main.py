"""Main text of web pages by templates deduced from same-host pages.

The tokens of a page are its block elements, told apart by their path (names,
classes and ids of the elements around them), and its text blocks, told apart
by path and words.  Over all pages of a host, tokens with the same occurrence
vector (how often each page has them) form an equivalence class; the vectors
are compared by sums of hashes, so a host of any size is aggregated before the
shuffle and never gathered.  Classes of elements that most pages have exactly
once, and whose parents are in such a class too, nest into the host's template.
Text blocks that nearly all pages have belong to the template as well, whatever
their elements are called, unless such blocks are most of a host's text: then
its pages are copies of each other.

What the template leaves open are its slots.  A page's main slot is the
smallest template element around all its text that may be article text and is
no template text; never a block itself.  All of the slot is extracted but for
parts that hold template text alone, and for elements that by their kind are
no article text (fixed lists below, of which the class and id words count
least: they make no aside of an article, nor of what holds most of a page's
text).  Pages of hosts with few pages are taken whole, without such elements.

Defined results: null html is empty and gives empty text; html without markup
is one block; unclosed and stray tags are tolerated, a tag cut off at the end
is markup; a null url is the host ''; repeated rows are pages of their own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import lean, settled, table, whole_text
from paneltrend.llm.url_filter import host_and_path

# Element names of HTML by their role, and words in classes and ids.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp".split())
ASIDE = frozenset(
    "script style title head noscript template nav footer aside form button select option textarea svg iframe dialog "
    "menu object canvas input".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead banner cookie cookies consent notice notices alert popup modal "
    "overlay newsletter subscribe subscription share sharing social related recommended comment comments commentlist respond reply replies "
    "disqus widget toolbar pagination pager login signup search".split()
)
#: Elements that are no aside by what they are called.
NEVER_NAMED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
#: Elements that are part of running text; others are parts of a page, and go if they hold template text alone.
FLOW = frozenset("p ul ol li dl dt dd pre blockquote h1 h2 h3 h4 h5 h6 figure figcaption hr address".split())
#: Elements that end where one of the same kind begins.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

#: A template element is once in this share of the pages, a template text in that one.
SUPPORT, TEXT_SUPPORT = 0.6, 0.9
#: Tokens of a class, and pages of a host, that are enough for a template, and for template texts.
CLASS_SIZE, HOST_PAGES, TEXT_PAGES = 2, 3, 4
#: Template texts are at most this share of a host's text.
TEXT_SHARE = 0.5
#: Template tables of at most so many hosts and tokens together are broadcast (some 100 bytes each).
BROADCAST_TOKENS = 100_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*)"
    r"(?P<attrs>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+[^<>]*)(?:>|\Z|(?=<))",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    name: str
    path: str
    parent: str
    depth: int
    aside: bool
    mass: int = 0
    #: aside by its class, id or role alone
    named: bool = False


@dataclass
class Page:
    """Block elements in order, and text blocks: the elements around each, its text and its link text's length."""

    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[tuple[Element, ...], str]] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)


def parse(source: str) -> Page:
    page = Page()
    stack: list[Element] = [Element("", "", "", 0, False)]
    page.elements.append(stack[0])
    texts: list[str] = []
    sizes = page.sizes
    links = linked = 0
    at, end = 0, len(source)

    def close_block() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", "".join(texts)).strip()
        texts.clear()
        if text:
            page.blocks.append((tuple(stack), text))
            sizes.append(max(0, len(text) - linked))
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw)
        texts.append(text)
        if links:
            linked += len(text.strip())

    while at < end:
        m = _TAG.search(source, at)
        if m is None:
            say(source[at:])
            break
        if m.start() > at:
            say(source[at : m.start()])
        at = m.end()
        name = (m.group("name") or "").lower()
        if not name:
            continue
        ending = bool(m.group("end"))
        if name == "a":
            links = max(0, links - 1) if ending else links + 1
        if name == "br":
            texts.append(" ")
        if name in INLINE:
            continue
        close_block()
        if ending:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        if len(stack) > 1 and stack[-1].name == "p":
            stack.pop()
        while len(stack) > 1 and stack[-1].name in SIBLINGS.get(name, ()):
            stack.pop()
        signature, words = name, set()
        for a in _ATTRIBUTE.finditer(m.group("attrs")):
            value = next((v for v in a.groups()[1:] if v is not None), "").lower()
            words |= set(_WORDS.findall(value))
            signature += "." + re.sub(r"\d+", "0", value)
        top = stack[-1]
        path = blake2b(f"{top.path}/{signature}".encode(), digest_size=8).hexdigest()
        # a header within an article is its own, any other one the site's
        site_header = name == "header" and not any(e.name in ("article", "main") for e in stack)
        aside = site_header or name in ASIDE
        named = not aside and name not in NEVER_NAMED and bool(words & ASIDE_WORDS)
        element = Element(name, path, top.path, top.depth + 1, aside or named, named=named)
        page.elements.append(element)
        if name in VOID or m.group("attrs").rstrip().endswith("/"):
            continue
        stack.append(element)
        if name in RAW:
            closing = re.compile(rf"</{name}\b", re.I).search(source, at)
            at = closing.start() if closing else end
    close_block()
    # what holds most of the page's text is no aside, whatever it is called
    if any(e.named for e in page.elements):
        _add_masses(page, sizes, lambda e: e.aside and not e.named)
        whole = page.elements[0].mass
        for e in page.elements:
            e.aside = e.aside and not (e.named and 2 * e.mass > whole)
            e.mass = 0
    _add_masses(page, sizes, lambda e: e.aside)
    return page


def _add_masses(page: Page, sizes: list[int], outside) -> None:
    for (around, _), size in zip(page.blocks, sizes):
        if not any(outside(e) for e in around):
            for e in around:
                e.mass += size


def tokens_of(page: Page) -> dict[str, tuple[str, int, bool, int, int]]:
    """Of each path: its parent, depth, whether it is no article text, occurrences and text mass."""
    out: dict[str, tuple[str, int, bool, int, int]] = {}
    aside = {""} if page.elements[0].aside else set()
    for e in page.elements:
        if e.aside or e.parent in aside and e.depth:
            aside.add(e.path)
        _, _, _, n, mass = out.get(e.path, ("", 0, False, 0, 0))
        out[e.path] = (e.parent, e.depth, e.path in aside, n + 1, mass + e.mass)
    return out


def text_token(path: str, text: str) -> int:
    """A text block as a token; never 0."""
    found = blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(found, "little", signed=True) or 1


def texts_of(page: Page) -> dict[int, tuple[int, int]]:
    """Of each block that may be article text: its token, how often the page has it, and its mass."""
    out: dict[int, tuple[int, int]] = {}
    for (around, text), size in zip(page.blocks, page.sizes):
        if not any(e.aside for e in around):
            token = text_token(around[-1].path, text)
            n, mass = out.get(token, (0, 0))
            out[token] = (n + 1, mass + size)
    return out


def text_under(
    page: Page, elements: frozenset[str] = frozenset(), constant: frozenset[int] = frozenset()
) -> str:
    """The article text of a page, by its host's template: paths of elements, and text tokens."""
    blocks = [(around, text) for around, text in page.blocks if not any(e.aside for e in around)]
    if not constant:
        return "\n".join(text for _, text in blocks)
    varies = [text_token(around[-1].path, text) not in constant for around, text in blocks]
    if not any(varies):
        return ""
    # elements around all text that varies, the smallest one of the template last
    inside = [around[:-1] if len(around) > 1 else around for (around, _), own in zip(blocks, varies) if own]
    common = inside[0]
    for around in inside[1:]:
        n = next((i for i, (a, b) in enumerate(zip(common, around)) if a is not b), min(len(common), len(around)))
        common = common[:n]
    at = max((i for i, e in enumerate(common) if e.path in elements), default=0)
    slot = common[at]
    open_parts = {id(around[at + 1]) for (around, _), own in zip(blocks, varies) if own and len(around) > at + 1}
    found = []
    for around, text in blocks:
        if len(around) > at and around[at] is slot:
            part = around[at + 1] if len(around) > at + 1 else None
            if part is None or part.name in FLOW or id(part) in open_parts:
                found.append(text)
    return "\n".join(found)


def main_text(source: str, elements: frozenset[str] = frozenset(), constant: frozenset[int] = frozenset()) -> str:
    return text_under(parse(source), elements, constant)


# --- templates ----------------------------------------------------------------------------

TOKENS = "host string, page long, path string, token long, parent string, depth int, aside boolean, n int, mass long"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, page, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
            parsed = parse(source)
            rows += [(host, page, path, 0, *told) for path, told in tokens_of(parsed).items()]
            rows += [(host, page, "", token, "", 0, False, *told) for token, told in texts_of(parsed).items()]
        names = [c.split()[0] for c in TOKENS.split(", ")]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.int64())
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def _template_elements(sums: DataFrame) -> DataFrame:
    """``host, elements``: the paths of each host's template, as many as a page has at most."""
    tokens = sums.filter("token = 0")
    pages = tokens.filter("path = ''").select("host", F.col("pages").alias("all_pages"))
    enough = pages.filter(F.col("all_pages") >= HOST_PAGES)
    once = tokens.join(enough, "host").filter("most = 1 and pages >= all_pages * " + str(SUPPORT))
    # equivalence classes: equal vectors have equal sums of hashes
    classes = once.groupBy("host", "pages", "vector").agg(F.count("*").alias("size"))
    large = once.join(classes.filter(F.col("size") >= CLASS_SIZE), ["host", "pages", "vector"])
    held = large.select("host", F.col("path").alias("parent"), F.col("pages").alias("parent_pages"))
    nested = large.filter("depth > 0").join(held, ["host", "parent"]).filter("parent_pages >= pages and not aside")
    return nested.groupBy("host").agg(F.collect_set("path").alias("elements"))


def _template_texts(sums: DataFrame) -> DataFrame:
    """``host, constant``: the text tokens of each host's template, as many as its pages have blocks at most."""
    pages = sums.filter("token = 0 and path = ''").select("host", F.col("pages").alias("all_pages"), F.col("mass").alias("whole"))
    held = sums.filter("token <> 0").join(pages.filter(F.col("all_pages") >= TEXT_PAGES), "host")
    return (
        held.filter(F.col("pages") >= TEXT_SUPPORT * F.col("all_pages"))
        .groupBy("host")
        .agg(F.collect_set("token").alias("constant"), F.sum("mass").alias("mass"), F.first("whole").alias("whole"))
        .filter(F.col("mass") <= TEXT_SHARE * F.col("whole"))
        .select("host", "constant")
    )


def templates(pages: DataFrame) -> DataFrame:
    """``host, elements, constant`` of hosts with enough pages.

    ``pages``: ``host, page, html``, where ``page`` tells pages apart.
    """
    found = pages.select("host", "page", "html").mapInArrow(lean(_tokens), TOKENS)
    sums = settled(
        found.groupBy("host", "path", "token").agg(
            F.first("parent").alias("parent"),
            F.first("depth").alias("depth"),
            F.max("aside").alias("aside"),
            F.count("*").alias("pages"),
            F.max("n").alias("most"),
            F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).alias("vector"),
            F.sum("mass").alias("mass"),
        )
    )
    # elements are of use only beside template texts: without these all of a page varies
    return settled(_template_texts(sums).join(_template_elements(sums), "host", "left"))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    host, _ = host_and_path(F.col(url_column))
    told = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), host.alias("host"), whole_text(html_column).alias("html"))
    found = templates(told.select("host", F.xxhash64("page_id", "url").alias("page"), "html"))
    # bounded by its size: tokens of all hosts together
    tokens = sum((F.greatest(F.size(c), F.lit(0)) for c in ("elements", "constant")), F.lit(1))
    if found.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0] <= BROADCAST_TOKENS:
        found = F.broadcast(found)
    joined = told.join(found, "host", "left").select("page_id", "url", "html", "elements", "constant")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(source.as_py(), frozenset(elements.as_py() or ()), frozenset(constant.as_py() or ()))
                for source, elements, constant in zip(*(batch.column(c) for c in ("html", "elements", "constant")))
            ]
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    kind = told.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(lean(extracted), f"page_id {kind}, url string, text string, n_chars long")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
