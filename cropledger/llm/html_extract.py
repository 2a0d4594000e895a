"""Main text of web pages by a maximum-scoring subsequence (operator 2).

A page is read as a sequence of words and tags. A word scores by where it stands:
its nearest telling container (element names and the words of their class and id),
its block, and whether it is a link. Tags score below zero. The content is the
contiguous run of words and tags of the highest sum, found by one linear scan; the
text is that of its blocks, without containers of their own low score inside (an
advert or a comment thread in the middle of an article).

The weights are log-odds of words inside and outside the content of labelled pages,
smoothed towards a short list of usual names. Labelled pages are those whose
markup names the content itself (one ``article`` or ``main``); at most
``TRAIN_PAGES`` of them are read, chosen by the hash of the page's key, whole pages. Without
any, the usual names alone decide.

The text of scripts, styles, titles, text areas and frames goes to their end tag, else to the
page's end. Controls, pictures and media (``LEFT_OUT``) are elements like any other whose
runs are left out: they end with their end tag, with ``/>`` or with their parent.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by a blank line; nothing is cut or capped. Null and
empty pages, and pages without words, give an empty text. Rows with a null key and
repeated rows are read like any other; other columns pass through (one named as a
new column is replaced); an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm.words import map_texts, text_array

TRAIN_PAGES = 2000
MAX_WEIGHTS = 20_000
#: How many words of evidence a usual name stands for.
PRIOR = 50.0
#: What a word scores before its place is looked at.
WORD = 0.5

# Element names of HTML, and usual names of page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
IMPLIED_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SEMANTIC = {"article", "main"}
LEFT_OUT = set("noscript template select button svg math object canvas audio video".split())
#: Elements inside svg and math that hold html again, and those that end svg and math elsewhere.
HOLDS_HTML = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split()
)
PAGE_PARTS = set("nav header footer aside form menu dialog fieldset".split())
OUTSIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert warning popup modal overlay "
    "subscribe subscription newsletter paywall nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar toolbar "
    "comment comments commentlist reply replies respond discussion disqus share sharing social related recommended widget login signup search form copyright legal pagination pager skip".split()
)
CONTENT_NAMES = set("article content main post entry story articlebody maincontent".split())

_TAG_PATTERN = (
    r"<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|iframe)\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|" + _TAG_PATTERN + r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_TAG = re.compile(r"(?P<raw>(?!))|" + _TAG_PATTERN, re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


class Run:
    """Text between two tags: its words' count and where it stands."""

    __slots__ = ("block", "block_tag", "container", "in_content", "link", "names", "tags", "text", "words")


def names_of(tag: str, attrs: str) -> list[str]:
    found = [x for m in _NAMES.finditer(attrs) for x in (m[1] or m[2] or m[3] or "",)]
    return [tag, *dict.fromkeys("." + w.lower() for x in found for w in _SPLIT.split(x) if w)]


def _foreign(stack: list[tuple[str, list[str]]]) -> bool:
    """Whether the innermost open element is read as svg or math."""
    for tag, _ in reversed(stack):
        if tag in ("svg", "math"):
            return True
        if tag in HOLDS_HTML:
            break
    return False


def read_page(page: str) -> Iterator[Run]:
    """The page's runs of text in order, with the tags before each."""
    stack: list[tuple[str, list[str]]] = []  # open elements: tag, names (inline ones without names)
    skip: int | None = None  # the place of the open element that is left out
    block, tags, at = 0, [], 0
    while True:
        m = _TOKEN.search(page, at)
        if m and m["raw"] and skip is not None and _foreign(stack):
            m = _TAG.match(page, m.start())  # in svg and math these are elements
        text = page[at : m.start()] if m else page[at:]
        if skip is not None:
            text = ""
        if text and not text.isspace():
            run = Run()
            run.text, run.words, run.block, run.tags = text, len(text.split()), block, tags
            run.names = [n for t, n in stack if t not in INLINE]
            run.link = any(t == "a" for t, _ in stack)
            run.block_tag = next((t for t, _ in reversed(stack) if t not in INLINE), "")
            run.in_content = any(t in SEMANTIC for t, _ in stack)
            tags = []
            yield run
        if m is None:
            break
        at = m.end()
        if text and text.isspace():
            # white space between inline runs stays a word border
            run = Run()
            run.text, run.words, run.block, run.tags, run.names, run.link, run.block_tag, run.in_content = " ", 0, block, [], [], False, "", False
            yield run
        if m["raw"]:
            if skip is None:
                tags.append(m["raw"].lower())
                block += m["raw"].lower() in ("title", "textarea")
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        ended = bool(m["close"] or m["close2"])
        if ended:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    break
                if tag in INLINE and stack[i][0] not in INLINE and (skip is None or i < skip):
                    i = len(stack)  # a stray inline end tag doesn't close its block
                    break
            else:
                i = len(stack)
            inside = tag in LEFT_OUT or skip is not None and i >= skip
            del stack[i:]
            if skip is not None and skip >= len(stack):
                skip = None
            if inside:
                continue
        elif skip is not None:
            if tag in ENDS_FOREIGN:
                while _foreign(stack):
                    stack.pop()
            elif tag in ("button", "select"):  # these don't nest
                for i in range(len(stack) - 1, skip - 1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            if skip >= len(stack):
                skip = None
        alone = tag in VOID or (m["attrs"] or m["attrs2"] or "").endswith("/")
        if skip is not None:
            if not alone:
                stack.append((tag, []))
            continue
        tags.append(tag)
        if tag in LEFT_OUT:
            block += tag == "select"
            if not alone:
                skip = len(stack)
                stack.append((tag, []))
            continue
        if tag not in INLINE:
            block += 1
        elif tag == "br":
            run = Run()
            run.text, run.words, run.block, run.tags, run.names, run.link, run.block_tag, run.in_content = " ", 0, block, [], [], False, "", False
            yield run
        if not ended and not alone:
            if tag not in INLINE:  # a new block ends an open paragraph, a new item the open item
                ends = IMPLIED_END.get(tag, set()) | {"p"}
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE:
                        break
            stack.append((tag, names_of(tag, m["attrs"] or m["attrs2"] or "")))


def _prior(name: str) -> tuple[float, float]:
    """Words of evidence (inside, outside) that a usual name brings."""
    if name in PAGE_PARTS or name[:1] == "." and name[1:] in OUTSIDE_NAMES:
        return 1.0, PRIOR * 20
    if name in SEMANTIC or name[:1] == "." and name[1:] in CONTENT_NAMES:
        return PRIOR * 20, 1.0
    if name == "block:p":
        return PRIOR * 3, PRIOR
    if name in ("block:li", "link"):
        return PRIOR, PRIOR * 2
    return PRIOR, PRIOR


def features(run: Run) -> list[str]:
    own = [n for names in run.names for n in names if n not in SEMANTIC and (n[0] == "." or n in PAGE_PARTS)]
    return [*dict.fromkeys(own), "block:" + run.block_tag, *(["link"] if run.link else []), *("tag:" + t for t in run.tags)]


class Weights:
    """Log-odds of names, from counts (inside, outside)."""

    def __init__(self, counts: dict[str, tuple[float, float]]):
        self.counts = counts
        self.known: dict[str, float] = {}

    def odds(self, name: str, most: float) -> float:
        got = self.known.get(name)
        if got is None:
            inside, outside = self.counts.get(name, (0.0, 0.0))
            p, q = _prior(name)
            got = math.log((inside + p) / (outside + q))
            if len(self.known) < MAX_WEIGHTS:
                self.known[name] = got
        return max(-most, min(most, got))

    def container(self, names: list[list[str]]) -> tuple[float, bool]:
        """Score of the nearest container that tells, and whether it is a page part
        inside content. An ``article`` inside a page part counts as content (the part
        was not closed), unless the part is a thread of comments."""
        score, within = 0.0, False
        for element in names:
            own = [self.odds(n, 4.0) for n in element if n[0] == "." or n in PAGE_PARTS or n in SEMANTIC]
            low, high = min(own, default=0.0), max(own, default=0.0)
            if low <= -1.5:
                within = within or score > 0
                score = low
                thread = any(n in (".comment", ".comments", ".reply", ".replies", ".discussion", ".respond") for n in element)
                if thread:
                    return score, within
            elif high >= 1.5 and (score >= 0 or element[0] in SEMANTIC):
                score, within = high, False
        return score, within

    def place(self, run: Run) -> tuple[float, float]:
        """Score of a word of the run, its link left aside, and the least that the
        run may add to a region: little is lost by a page part inside content."""
        score, within = self.container(run.names)
        return WORD + score + self.odds("block:" + run.block_tag, 1.0), -3.0 if within else -math.inf

    def tag(self, tag: str) -> float:
        """A tag scores below zero, the more so the more of its kind stand outside."""
        return min(-0.05, self.odds("tag:" + tag, 2.0) / 2 - 0.25)


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run of the highest positive sum (the first of
    equals, empty if none), by one scan."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weights: Weights) -> str:
    runs = list(read_page(page or ""))
    places = [weights.place(r) if r.words else (0.0, 0.0) for r in runs]
    scores: list[float] = []  # for each run its tags, then its words
    for r, (s, least) in zip(runs, places, strict=True):
        scores.append(sum(weights.tag(t) for t in r.tags))
        scores.append(max(least, r.words * (s + (weights.odds("link", 1.0) if r.link else 0.0))))
    start, end = best_region(scores)
    out: list[str] = []
    now, block = [], None
    for i in range(start // 2, (end + 1) // 2):
        r = runs[i]
        if r.words and places[i][0] < 0:
            continue
        if r.block != block and now:
            out.append("".join(now))
            now = []
        block = r.block
        now.append(r.text)
    out.append("".join(now))
    clean = (" ".join(html.unescape(x).split()) for x in out)
    return "\n\n".join(x for x in clean if x)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(name, inside, outside): words and tags of labelled pages by where they stand."""
    total: dict[str, list[float]] = {}
    for frame in frames:
        for page in frame["html"]:
            runs = [r for r in read_page(page) if r.words]
            if not any(r.in_content for r in runs):
                continue
            for r in runs:
                for f in features(r):
                    at = total.setdefault(f, [0.0, 0.0])
                    at[0 if r.in_content else 1] += 1 if f.startswith("tag:") else r.words
    yield pd.DataFrame([(k, a, b) for k, (a, b) in total.items()], columns=["name", "inside", "outside"])


def fit(pages: DataFrame, key_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> Weights:
    """Weights from at most ``train_pages`` labelled pages (about, by hash of the key)."""
    page = F.col(f"`{html_col}`")
    labelled = pages.select(F.xxhash64(F.col(f"`{key_col}`").cast("string")).alias("h"), page.alias("html")).where(
        page.rlike(r"(?i)<(article|main)[\s>]")
    )
    # the share is taken from a count of all pages, so every labelled page has the same chance
    n = pages.count()
    share = min(1.0, train_pages / max(n, 1))
    some = labelled.where(F.pmod("h", F.lit(1_000_003)) < share * 1_000_003).select("html")
    counts = some.mapInPandas(_count, "name string, inside double, outside double").groupBy("name").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b"))
    top = counts.orderBy(F.desc(F.col("a") + F.col("b")), "name").limit(MAX_WEIGHTS).collect()
    return Weights({r["name"]: (r["a"], r["b"]) for r in top})


def extract(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (its code points)."""
    counts = weights.counts

    def run(texts: pa.Array) -> Iterator[list[pa.Array]]:
        own = Weights(counts)
        out = [main_text(t, own) for t in text_array(texts).to_pylist()]
        yield [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]

    return map_texts(pages, html_col, run, "text string, n_chars long", drop_text=True)


NAME, ORACLE = "op2_html_extract", None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, fit(pages))
