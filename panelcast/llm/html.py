"""Main text of web pages as the maximum-scoring contiguous region of the page's tokens.

A page is a sequence of text runs and tags. The words of a run score by the
log-odds that such a run (its innermost region, its block, inside a link or
not) is content, and every tag costs by how rarely its kind occurs inside
content; both are learned from labelled pages: pages whose markup names
its own article. One linear scan finds the region of highest total score.
Inside the region, runs of regions that are no content (menus, adverts, forms,
reader comments, ...) are left out. A name (class, id, role) never makes one of
body, main or article, nor of an element that holds the page's article or,
where a page has none, nearly all of its text.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import scan_texts

SAMPLE_PAGES = 2_000  # labelled pages that the weights are fitted on, picked by id hash
SMOOTHING = 20.0
MAX_COST = 8.0
MIN_COST = 0.05
WORD_PRIOR = 0.5  # a word of an unknown kind of run leans to content
BASE_SHARE = 0.1  # a page without article whose text outside named regions is a smaller share of its words has a named wrapper

# Element names of the HTML standard by their role.
RAW_TEXT = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "select", "button", "noembed")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split())
REGIONS = frozenset(
    "article aside body details dialog div fieldset figure footer form head header main menu nav section table ul ol "
    "dl blockquote".split())
ARTICLE = frozenset(("article", "main"))
UNNAMED = ARTICLE | {"body"}  # names say nothing about these elements
OUTSIDE = frozenset(("nav", "aside", "footer", "form", "menu", "head", "dialog", "fieldset"))
SELF_CLOSING = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"),
                "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}

# Words in class, id and role attributes that name a region which is no content.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|"
    r"sidebar|side-bar|widget|menu|nav\w*|breadcrumbs?|footer|masthead|site-header|page-header|topbar|toolbar|"
    r"comments?|replies|disqus|respond|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|"
    r"search|pagination|pager|tags|copyright|skip\w*)(?:$|[\s_-])", re.I)
CONTENT_NAME = frozenset("article content post entry story main body text".split())
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main|body|text)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*>?|"
    r"<(?P<raw>" + "|".join(RAW_TEXT) + r")(?=[\s/>])(?P<rawattr>[^>]*)>.*?(?:</(?P=raw)\s*>|$)|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attr>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*|[^<>]*)/?>", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Run:
    """Text between tags: where it stands, its block's number and the raw text."""

    region: str
    block: str
    linked: bool
    excluded: bool
    in_article: bool
    number: int
    text: str
    within: tuple[int, ...] = ()  # elements around it that are regions of no content, by their place on the page
    inner: bool = False  # inside an article or main element, wherever that stands

    def keys(self) -> tuple[str, str, str]:
        return f"region:{self.region}", f"block:{self.block}", f"linked:{self.linked}"


@dataclass
class Weights:
    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, run: Run) -> float:
        if run.excluded:
            return -1.0
        return WORD_PRIOR + sum(self.words.get(k, 0.0) for k in run.keys())

    def tag(self, name: str) -> float:
        return self.tags.get(name, 1.0 if name.strip("/") in REGIONS else 0.2)


def _region_name(name: str, named: str, free: bool = False) -> tuple[str, bool]:
    """Kind of region an element opens and whether it is no content; ``free``: neither its name nor its kind says so."""
    boilerplate = name not in UNNAMED and BOILERPLATE.search(named) and CONTENT_NAME.isdisjoint(named.lower().split())
    if not free and (name in OUTSIDE or boilerplate):
        return f"{name}!", True
    return (f"{name}+" if CONTENT.search(named) else name), False


def _wrappers(runs: list[Run], fixed: set[int]) -> set[int]:
    """Elements of no content by name that must be wrappers: they hold the page's article or nearly all of its text.

    ``fixed`` elements (menus, asides, footers, ...) are never wrappers. Of
    several articles those under the fewest such elements are the page's own.
    """
    runs = [r for r in runs if fixed.isdisjoint(r.within)]
    articles = [r.within for r in runs if r.inner]
    if articles:
        least = min(map(len, articles))
        return {e for within in articles if len(within) == least for e in within}
    sized = [(r.within, len(r.text.split())) for r in runs if not r.linked]
    total, freed = sum(n for _, n in sized), set()
    while sum(n for within, n in sized if freed.issuperset(within)) < BASE_SHARE * total:
        held: Counter = Counter()
        for within, n in sized:
            outer = next((e for e in within if e not in freed), None)
            if outer is not None:
                held[outer] += n
        freed.add(held.most_common(1)[0][0])
    return freed


def parse(page: str) -> list[Run | str]:
    """Runs and tag names in page order; names are lower case, a closing tag is "/name".

    A tag inside a region that is no content ends in "!". A page with wrappers is scanned twice.
    """
    fixed: set[int] = set()
    out = _scan(page, frozenset(), fixed)
    runs = [t for t in out if isinstance(t, Run)]
    if not any(r.within for r in runs):
        return out
    freed = _wrappers(runs, fixed)
    return _scan(page, frozenset(freed), set()) if freed else out


def _scan(page: str, freed: frozenset[int], fixed: set[int]) -> list[Run | str]:
    """One pass over the whole page; adds to ``fixed`` the elements that no page has as its wrapper."""
    out: list[Run | str] = []
    # element, region, excluded, in article, regions of no content around, inside any article
    stack: list[tuple[str, str, bool, bool, tuple[int, ...], bool]] = []
    top = ("", "body", False, False, (), False)
    links, number, at, opened = 0, 0, 0, 0
    block = "body"

    def text(upto: int) -> None:
        if upto > at and not page[at:upto].isspace():
            _, region, excluded, inside, within, inner = stack[-1] if stack else top
            out.append(Run(region, block, links > 0, excluded, inside, number, page[at:upto], within, inner))
        elif upto > at and out and isinstance(out[-1], Run):
            out[-1].text += " "  # white space between inline elements separates words

    for m in _TOKEN.finditer(page):
        text(m.start())
        spaced = at < m.start() and page[m.start() - 1].isspace()
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        left_out = "!" if stack and stack[-1][2] else ""  # tags of regions that are no content say nothing about content
        out.append(("/" if m["close"] else "") + name + left_out)
        if spaced and name not in BLOCKS and len(out) > 1 and isinstance(out[-2], Run):
            out[-2].text += " "
        if name in BLOCKS:
            number += 1
            block = "body" if m["close"] else ("p" if name == "br" else name)
        if name == "a":
            links = 0 if m["close"] else 1
        if name in VOID or name not in REGIONS:
            continue
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        else:
            _, region, excluded, inside, within, inner = stack[-1] if stack else top
            named = " ".join(x or y or z for x, y, z in _NAMES.findall(m["attr"] or ""))
            opened += 1
            region, outside = _region_name(name, named, opened in freed)
            if name == "header" and not inside and opened not in freed:
                region, outside = "header!", True
            if name in OUTSIDE and name != "form":
                fixed.add(opened)
            if name in ("ul", "ol", "dl", "table", "div", "section", "blockquote", "figure") and stack and not outside:
                region = stack[-1][1] if region == name and stack[-1][1] not in ("body", "div") else region
            stack.append((name, region, excluded or outside, (inside or name in ARTICLE) and not outside,
                          (*within, opened) if outside else within, inner or name in ARTICLE))
    text(len(page))
    return out


def _n_words(run: Run) -> int:
    return len(run.text.split())


def count_tokens(page: str) -> Counter:
    """(key, is content) counts of a labelled page: one whose markup names its article; other pages count nothing."""
    tokens = parse(page)
    if not any(isinstance(t, Run) and t.in_article for t in tokens):
        return Counter()
    content = [i for i, t in enumerate(tokens) if isinstance(t, Run) and t.in_article and not t.excluded]
    if not content:
        return Counter()
    found: Counter = Counter()
    for i, t in enumerate(tokens):
        if isinstance(t, Run):
            for key in () if t.excluded else t.keys():
                found[key, t.in_article] += _n_words(t)
        elif t[-1] != "!":
            found[f"tag:{t}", content[0] < i < content[-1]] += 1
    return found


def weights_of(counts: dict[tuple[str, bool], int]) -> Weights:
    """Log-odds of the counts; a tag's cost is never below MIN_COST nor over MAX_COST."""
    keys = {k for k, _ in counts}
    totals = {side: sum(n for (k, s), n in counts.items() if s == side and k.startswith("linked:")) + 1 for side in (True, False)}
    out = Weights()
    for key in sorted(keys):
        inside, outside = counts.get((key, True), 0), counts.get((key, False), 0)
        if key.startswith("tag:"):
            cost = math.log((outside + 1) / (inside + 1)) + 2.0
            out.tags[key[4:]] = min(MAX_COST, max(MIN_COST, cost))
        else:
            share = inside + outside
            odds = math.log((inside / totals[True] * 1000 + 1) / (outside / totals[False] * 1000 + 1))
            out.words[key] = odds * share / (share + SMOOTHING)
    return out


def extract(page: str | None, weights: Weights) -> str:
    """Main text of one whole page: blocks joined by a line feed, white space inside a block as one space."""
    tokens = parse(page or "")
    best, best_span, total, start = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(tokens):
        total += weights.word(t) * _n_words(t) if isinstance(t, Run) else -weights.tag(t)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_span = total, (start, i + 1)
    blocks: dict[int, list[str]] = {}
    for t in tokens[best_span[0]:best_span[1]]:
        if isinstance(t, Run) and not t.excluded:
            blocks.setdefault(t.number, []).append(t.text)
    cleaned = (" ".join(htmllib.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(x for x in cleaned if x)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES) -> Weights:
    """Weights from at most ``sample`` labelled pages (only their counts reach the driver)."""
    ids = pages.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html")).join(
        F.broadcast(ids.distinct()), "id")  # at most `sample` ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for page in batch.column(1):
                found.update(count_tokens(page.as_py() or ""))
        rows = list(found.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0][0] for r in rows], pa.string()), pa.array([r[0][1] for r in rows], pa.bool_()),
             pa.array([r[1] for r in rows], pa.int64())], names=["key", "inside", "n"])

    counted = chosen.mapInArrow(run, "key string, inside boolean, n bigint").groupBy("key", "inside").agg(F.sum("n").alias("n"))
    return weights_of({(r["key"], r["inside"]): r["n"] for r in counted.collect()})


def extract_pages(pages: DataFrame, weights: Weights, id_col: str = "page_id", html_col: str = "html",
                  other: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``other`` columns, text) for every page; null and empty pages have an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p.as_py(), weights) for p in batch.column(1)]
            keep = [batch.column(0)] + [batch.column(i + 2) for i in range(len(other))]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(texts, pa.string())], names=["id", *other, "text"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([f"id {kind[id_col]}", *[f"`{c}` {kind[c]}" for c in other], "text string"])
    return scan_texts(pages, [id_col, html_col, *other], run, schema)


def op2_query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    out = extract_pages(pages, fit(pages), other=("url",))
    return out.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
