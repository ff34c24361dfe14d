"""Main text of web pages by consensus of their hosts.

Pages of a host share a template. A first pass parses each page into containers
and blocks, scores the containers and lets the page vote for the generalised
tag-class path of its best one. Votes are summed by host and path in Spark;
paths with a tenth of a host's votes win. A second pass parses each page again
and takes the blocks of the containers under a winning path: its own best path
if a quarter of the host's pages chose that; else, of the winning paths that it
has, the best by votes and score. A page that has none of them keeps its own
best container.

Elements that surely are no article (menus, forms, scripts and the like) are
left out by tag. Elements whose class, id or role says so count little when
containers are scored and are left out below the container that is taken, so a
wrapper called ``has-sidebar`` does not cost a page its text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import by_bytes, ship, stage
from matchforge.operators.joins import sized_broadcast

#: A path wins with this share of the votes of its host; a page keeps its own
#: best path if that has the second share.
WIN_SHARE, OWN_SHARE = 0.1, 0.25
#: Longer paths are written as their hash.
LONGEST_PATH = 1_000
#: Weight of text for a container that is one level further up, of containers
#: whose tag or class speaks for an article, of what speaks against one, and of
#: the body, which holds everything.
UP, FOR, AGAINST, WHOLE = 0.8, 1.25, 0.05, 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
#: Never part of an article.
DROPPED = frozenset("nav header footer aside form button select option dialog menu noscript template svg math canvas object audio video "
                    "map head script style textarea title xmp iframe noembed noframes input".split())
#: Start tags that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
#: Start tags that end an open element of the first set, not beyond one of the second.
IMPLIED = {"li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
           "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])), "tr": (frozenset(["tr"]), frozenset(["table"])),
           "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
           "tbody": (frozenset(["thead", "tbody", "tr"]), frozenset(["table"])), "option": (frozenset(["option"]), frozenset(["select"]))}
IN_HEAD = frozenset("meta link base title style script noscript template".split())
CONTAINERS = frozenset("body div article section main td center figure blockquote fieldset details".split())
SCOPE = frozenset("table td th caption".split())
GOOD_WORDS = frozenset("article body content entry main post story text".split())
BAD_WORDS = frozenset("ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
                      "disqus footer form header hidden login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
                      "promo promoted related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
                      "toolbar widget alert complementary contentinfo".split())

COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>", re.S)
OTHER = re.compile(r"<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"'>]|\Z)", re.I)
DIGITS, WORD = re.compile(r"\d+"), re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "path", "parent", "bad", "good", "dropped", "score")

    def __init__(self, tag: str, classes: str, words: str, parent: Element | None):
        self.tag, self.parent, self.score = tag, parent, 0.0
        plain = tag in ("html", "body")
        names = [] if plain else sorted({DIGITS.sub("#", c) for c in classes.lower().split()})
        self.path = (parent.path + ">" if parent else "") + ".".join([tag, *names])
        if len(self.path) > LONGEST_PATH:  # of nests without end, a hash is enough
            self.path = hashlib.md5(self.path.encode("utf-8", "replace")).hexdigest()
        said = set() if plain else set(WORD.findall(words.lower()))
        self.bad = not said.isdisjoint(BAD_WORDS)
        self.good = tag in ("article", "main") or not said.isdisjoint(GOOD_WORDS)
        self.dropped = tag in DROPPED or (parent is not None and parent.dropped)


def _attributes(text: str) -> tuple[str, str]:
    """(classes, all that names the element) of a start tag."""
    if not text or text.isspace():
        return "", ""
    classes, words = "", []
    for name, *values in ATTRIBUTE.findall(text):
        value = values[0] or values[1] or values[2]
        if name.lower() == "class" and not classes:
            classes = value
        words.append("hidden" if name.lower() == "hidden" else value)
    return classes, " ".join(words)


def blocks_of(page: str) -> tuple[list[tuple[Element, str, int]], list[Element]]:
    """Blocks (innermost element, text, characters in links) in page order, and
    all containers in page order."""
    root = Element("html", "", "", None)
    stack, opened, blocks, containers, parts, link = [root], Counter(), [], [], [], [0, 0]
    inline_bad = []  # open inline elements that are left out

    def close_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((stack[-1], text, min(link[1], len(text))))
            parts.clear()
        link[1] = 0

    def push(name: str, classes: str = "", words: str = "") -> None:
        stack.append(Element(name, classes, words, stack[-1]))
        opened[name] += 1
        if name in CONTAINERS and not stack[-1].dropped:
            containers.append(stack[-1])

    def pop(at: int) -> None:
        close_block()
        opened.subtract(e.tag for e in stack[at:])
        del stack[at:]
        inline_bad.clear()

    def find(names, stop) -> int:
        if not any(opened[x] for x in names):
            return 0
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                return k
            if stack[k].tag in stop:
                return 0
        return 0

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at and not stack[-1].dropped and not inline_bad:
            text = page[at:lt]
            if "&" in text:
                text = entities.unescape(text)
            if len(stack) == 1 and not text.isspace():  # text before any tag: the body begins
                push("body")
            parts.append(text)
            if link[0]:
                link[1] += len(text)
        if lt == end:
            break
        tag = TAG.match(page, lt)
        if tag is None:
            skip = COMMENT.match(page, lt) or OTHER.match(page, lt)
            if skip:
                at = skip.end()
            elif page[lt + 1:lt + 2].isalpha():  # a tag that the page breaks off in
                break
            else:  # a mark of its own
                if not stack[-1].dropped and not inline_bad:
                    if len(stack) == 1:
                        push("body")
                    parts.append("<")
                at = lt + 1
            continue
        at, closing, name = tag.end(), tag[1], tag[2].lower()
        if closing:
            if name in INLINE:
                if name == "a":
                    link[0] = 0
                if inline_bad and inline_bad[-1] == name:
                    inline_bad.pop()
            elif name not in ("body", "html", "br"):
                k = find((name,), () if name in SCOPE or name in ("tr", "tbody", "thead", "tfoot") else SCOPE)
                if k:
                    link[0] = 0
                    pop(k)
            continue
        if name in INLINE:
            if name == "a":
                link[0] = 1
            if tag[3] and name not in VOID:
                words = _attributes(tag[3])[1]
                if inline_bad and inline_bad[-1] == name or words and not BAD_WORDS.isdisjoint(WORD.findall(words.lower())):
                    inline_bad.append(name)
            elif inline_bad and inline_bad[-1] == name:
                inline_bad.append(name)
            continue
        if name == "br":
            if not stack[-1].dropped:
                parts.append(" ")
            continue
        if name == "html":
            continue
        if stack[-1].tag == "head" and name not in IN_HEAD:
            pop(len(stack) - 1)
        if name == "body":
            if len(stack) > 1:
                continue
        elif len(stack) == 1 and name not in IN_HEAD and name != "head":  # the body tag may be left out
            push("body")
        if name in ENDS_P and (k := find(("p",), SCOPE)):
            pop(k)
        if name in IMPLIED and (k := find(*IMPLIED[name])):
            pop(k)
        close_block()
        if name in VOID:
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag[3].endswith("/") and name in ("svg", "math"):
            continue
        push(name, *_attributes(tag[3]))
    close_block()
    return blocks, containers


def path_scores(blocks: list[tuple[Element, str, int]], containers: list[Element]) -> dict[str, float]:
    """Score of each container path of a page. Text outside links counts for
    all containers above it, less the higher they are, little where a class
    or role on the way speaks against it."""
    for e in containers:
        e.score = 0.0
    for element, text, linked in blocks:
        weight, e = float(len(text) - linked), element
        while e is not None and weight > 0:
            if e.bad:
                weight *= AGAINST
            if e.tag in CONTAINERS:
                e.score += weight
                weight *= UP
            e = e.parent
    out: dict[str, float] = {}
    for e in containers:
        if e.score > 0:
            out[e.path] = out.get(e.path, 0.0) + e.score * (WHOLE if e.tag == "body" else FOR if e.good else 1.0)
    return out


def best_path(scores: dict[str, float], votes: dict[str, float] | None = None) -> str | None:
    """The page's own best path if there are no votes or that has many; else,
    of the paths with votes, the best by votes squared times score."""
    if not scores:
        return None
    own = min(scores.items(), key=lambda x: (-x[1], x[0]))[0]
    known = {p: s * votes[p] ** 2 for p, s in scores.items() if p in votes} if votes else {}
    if not known or known.get(own) and votes[own] >= OWN_SHARE:
        return own
    return min(known.items(), key=lambda x: (-x[1], x[0]))[0]


def text_of(blocks: list[tuple[Element, str, int]], path: str | None) -> str:
    """Blocks below the outermost containers with this path, without those in
    elements that speak against an article."""
    out = []
    for element, text, _ in blocks if path else ():
        e = element
        while e is not None and e.path != path and not e.bad:
            e = e.parent
        if e is not None and e.path == path:
            out.append(text)
    return "\n\n".join(out)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> the path that each page with text votes for."""
    for batch in by_bytes(batches, "html"):
        hosts, paths = [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            path = best_path(path_scores(*blocks_of(page))) if page else None
            if path:
                hosts.append(host)
                paths.append(path)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["host", "path"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, winners) -> (page_id, url, text, n_chars, path)."""
    for batch in by_bytes(batches, "html"):
        texts, paths = [], []
        for page, winners in zip(batch.column("html").to_pylist(), batch.column("winners").to_pylist()):
            blocks, containers = blocks_of(page) if page else ([], [])
            path = best_path(path_scores(blocks, containers), {w["path"]: w["share"] for w in winners or ()})
            texts.append(text_of(blocks, path))
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(np.array([len(t) for t in texts], dtype=np.int64)), pa.array(paths, pa.string())],
            names=["page_id", "url", "text", "n_chars", "path"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, html) -> (host, winners): at most ten paths a host, each with its
    share of the votes."""
    votes = stage(pages.mapInArrow(_votes, "host string, path string").groupBy("host", "path").agg(F.count("*").alias("votes")), "votes")
    total = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    return stage(votes.join(total, "host").where(F.col("votes") >= WIN_SHARE * F.col("total"))
                 .groupBy("host").agg(F.collect_list(F.struct("path", (F.col("votes") / F.col("total")).alias("share"))).alias("winners")), "winners")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars long, path) of every page (row).

    ``path`` is the container path that the text comes from, null if there is
    none. Null, empty and textless pages have the text ''. Null urls and those
    without a host form one host. Repeated rows vote and come back each. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    ship(spark)
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col], F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"), host.alias("host"))
    winners = sized_broadcast(winning_paths(rows.select("host", "html")))
    return (rows.join(winners, "host", "left").select("page_id", "url", "html", "winners")
            .mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint, path string"))
