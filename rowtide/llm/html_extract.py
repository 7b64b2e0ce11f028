"""HTML extraction with a site style tree: same-host pages merged, low-importance branches removed.

Each page is read into a tree of elements; a style node is an element's path of
tags and classes within a host.  Merging the pages of a host gives, for each style
node, how many pages hold it, which presentations (sequences of child elements) and
which contents (texts under it, links included) occur there, and how often.  With m
pages, the importance of a node is the larger of the entropies of its presentations
and its contents to the base m: 0 if all pages agree there (a template), 1 if all
differ, and 1 if m is 1.  A branch's content is all the text under it, so it counts
as important as soon as something in it is.

Tags and class names set bounds to that: navigation, header, footer, side bars, forms,
notices, adverts, comments, scripts and the like have no importance at all; an
article (or main) element is important however alike the pages of its host are, and on a page where
such elements hold a quarter of the text or more, noise aside, nothing outside them is.  Elsewhere
branches whose importance is under ``least`` are removed from each page of the host; the page as a whole, html
and body are never removed.  Equal pages of a host are one page of the tree.

Text: character references decoded, white space inside a block made one space, blocks
in page order joined by a line feed.  Null or empty html gives empty text.  The host
is the url's (null urls share one empty host).  Each row is extracted, repeated rows as often as they
come, all alike; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .url_filter import host_of

TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"""
                 r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)|[!?/][^>]*+>)""", re.S)
ATTR = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript template textarea title svg iframe object select canvas".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
            "tfoot thead tr ul".split())
NOISE_TAGS = RAW | set("head nav header footer aside form menu dialog button".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
NOISE_WORDS = set("ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent "
                  "cookie cookies copyright discussion disqus footer header login masthead menu modal nav navbar navigation "
                  "newsletter notice notification overlay pager pagination popup promo promotion recommended related reply "
                  "replies search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
                  "widget".split())
COMMENT_WORDS = set("comment comments discussion disqus reply replies".split())
CONTENT_WORDS = set("article body content main page post story text wrapper".split())
#: an opening tag closes these open elements, up to the given ancestors
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}


MAIN_SHARE = 0.25  # of a page's text, noise aside, that makes its articles the page


@dataclass
class Node:
    tag: str
    path: str
    noise: bool
    main: bool
    children: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)


@dataclass
class Block:
    path: str
    noise: bool
    main: bool
    parts: list[str]


def _kind(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """Style signature of an element, and whether it is noise or main content by name."""
    names, words, role = [], set(), ""
    if "=" in attrs:
        for key, a, b, c in ATTR.findall(attrs):
            value = (a or b or c).lower()
            if key.lower() == "role":
                role = value.strip()
            elif key.lower() == "itemprop":
                words |= {"articlebody"} & {value.strip()}
            else:
                names += sorted(value.split())
                words.update(x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", a or b or c).lower()) if x)
    main = (tag in ("article", "main") or role in ("main", "article") or "articlebody" in words) and not words & COMMENT_WORDS
    named = words & NOISE_WORDS and not words & CONTENT_WORDS or words & COMMENT_WORDS and tag not in ("html", "body")
    noise = tag in NOISE_TAGS or role in NOISE_ROLES or bool(named) and tag not in ("html", "body") and not main
    return re.sub(r"\d+", "0", ".".join([tag, *names])), noise and not main, main


def parse(page: str | None) -> tuple[list[Block], list[Node]]:
    """Text blocks and elements of a page, both in page order."""
    page = page or ""
    root = Node("", "", False, False)
    stack, nodes, blocks = [root], [root], []
    current: Block | None = None
    at, last = 0, page.rfind(">") + 1

    def say(text: str) -> None:
        nonlocal current
        top = stack[-1]
        text = htmllib.unescape(text) if "&" in text else text
        if current is None:
            k = len(stack) - 1
            while k and stack[k].tag not in BLOCK:
                k -= 1
            # noise or main content that an inline element starts belongs to that element's block
            current = Block(stack[k].path, top.noise, top.main, [])
            blocks.append(current)
        elif current.noise != top.noise or current.main != top.main:
            current = Block(top.path, top.noise, top.main, [])
            blocks.append(current)
        current.parts.append(text)
        top.text.append(text)

    def pop_to(k: int) -> None:
        nonlocal current
        if any(x.tag in BLOCK for x in stack[k:]):
            current = None
        del stack[k:]

    while at < last:
        m = TAG.search(page, at, last)
        if m is None:
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        tag = name.lower()
        if m["end"]:
            block = tag in BLOCK
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
                if not block and stack[k].tag in BLOCK:
                    break
            continue
        if tag in BLOCK:
            current = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag in CLOSES:
            which, until = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in which:
                    pop_to(k)
                    break
                if stack[k].tag in until:
                    break
        if tag in ("br", "td", "th", "img", "input"):
            if current is not None:
                current.parts.append(" ")
        attrs = m["attrs"]
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            last = max(last, at)
        if tag in RAW or tag in VOID or attrs.endswith("/>") and tag not in BLOCK and tag not in ("a", "b", "i", "span"):
            stack[-1].children.append(tag)
            continue
        style, noise, main = _kind(tag, attrs)
        up = stack[-1]
        up.children.append(style)
        node = Node(tag, f"{up.path}/{style}", up.noise or noise, up.main or main)
        nodes.append(node)
        stack.append(node)
    if at < len(page):
        say(page[at:])
    return blocks, nodes


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def style_rows(page: str | None) -> list[tuple[int, int, int]]:
    """(style node, 0 for presentation or 1 for content, what is there) of a page, one row per node and kind."""
    shown: dict[str, list[str]] = {}
    said: dict[str, list[str]] = {}
    for n in parse(page)[1]:
        steps = shown.setdefault(n.path, [])
        for c in n.children:  # runs of equal children are one
            if not steps or steps[-1] != c:
                steps.append(c)
        text = " ".join("".join(n.text).split())
        if text:
            path = n.path
            while True:  # a branch's content is all the text under it
                said.setdefault(path, []).append(text)
                if not path:
                    break
                path = path.rpartition("/")[0]
    return ([(_hash(p), 0, _hash("/".join(s))) for p, s in shown.items()]
            + [(_hash(p), 1, _hash("\n".join(s))) for p, s in said.items()])


def extract(page: str | None, low: set[int]) -> str:
    """Text of a page without noise and without the branches in ``low``."""
    shown = []
    for b in parse(page)[0]:
        text = "" if b.noise else " ".join("".join(b.parts).split())
        if text:
            shown.append((b, text))
    main = sum(len(text) for b, text in shown if b.main)
    # an article that holds little of the page is a teaser: then branches outside are judged too
    main_only = main >= MAIN_SHARE * sum(len(text) for _, text in shown) > 0
    return "\n".join(text for b, text in shown if b.main or not main_only and not _is_low(b.path, low))


def _is_low(path: str, low: set[int]) -> bool:
    """Whether a branch of low importance leads to the path; html, body and the page as a whole are no branches."""
    steps = path.split("/") if low else []
    return any(_hash("/".join(steps[:k])) in low for k in range(2, len(steps) + 1) if steps[k - 1].split(".")[0] not in ("html", "body"))


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Site style tree: (host, node, pages, importance).

    Equal pages of a host count once: copies say nothing about a template.  What is shuffled are
    hashes, a few for each page, without repeats of a task; a hot host's rows are spread by what is at the node.
    """
    ship()

    @F.pandas_udf("array<struct<node:long,kind:int,what:long>>")
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[dict(zip(("node", "kind", "what"), r)) for r in style_rows(h)] for h in batch])

    seen = (pages.select(host_of(F.col(url_col)).alias("host"), F.xxhash64(html_col).alias("page"), F.explode(rows(F.col(html_col))).alias("s"))
            .select("host", "page", "s.*").distinct().groupBy("host", "node", "kind", "what").agg(F.count("*").alias("c")))
    m = F.sum("c")
    entropy = F.when(m <= 1, 1.0).otherwise((F.log(m) - F.sum(F.col("c") * F.log("c")) / m) / F.log(m))
    by_kind = seen.groupBy("host", "node", "kind").agg(m.alias("n"), entropy.alias("h"))
    return by_kind.groupBy("host", "node").agg(F.max("n").alias("pages"), F.max("h").alias("importance"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least: float = 0.2, max_broadcast: int = 200_000, salts: int = 64) -> DataFrame:
    """Per row: id, url, ``text`` and ``n_chars``.

    Up to ``max_broadcast`` low nodes are broadcast.  More are joined by host and one of
    ``salts`` slices of the pages, so a hot host's pages are spread.
    """
    ship()
    nodes = written(style_tree(pages, url_col, html_col).where(F.col("importance") < least).select("host", "node"), "low-nodes")
    low = nodes.groupBy("host").agg(F.collect_list("node").alias("low"))
    rows = pages.select(F.col(id_col).alias("a"), F.col(url_col).alias("b"), F.col(html_col).alias("c"),
                        host_of(F.col(url_col)).alias("host"))
    if nodes.count() <= max_broadcast:
        rows = rows.join(F.broadcast(low), "host", "left")
    else:
        low = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("a", "c"), F.lit(salts)).cast("int")).join(low, ["host", "salt"], "left")

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, lows in batches:
            yield pd.Series([extract(h, set(x) if x is not None else set()) for h, x in zip(htmls, lows)])

    return (rows.select(F.col("a").alias(id_col), F.col("b").alias(url_col), run("c", "low").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
