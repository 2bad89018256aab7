"""Main text of web pages by equivalence-class template deduction.

Tokens are tags with their path and text blocks with their path. Over the
distinct pages of a host every token has an occurrence vector (how often it
occurs on each page), kept as a digest that Spark can aggregate in any order.
Tokens with equal vectors form an equivalence class; classes that are large and
frequent (``LEAST_PAGES`` pages, ``SUPPORT`` of the host's pages, two tokens) are
valid, and nest by their vectors: the class that is once on every page is the
root, the others hang below it with falling support. Text tokens of valid
classes are template, the rest are slots; every page is read by its slots.

Element names are a hint for which slots are the article: a semantic container
(article, main, or a container named so) with all it holds, its sibling parts
and parts of the same path, loose text of the elements around it and, where the
host has a template, the slots beside it. Pages without a container give all
their slots. Outside the container, or the host's path with most slot text,
blocks that are mostly links do not count. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments are left out by
element, role and name.

Passages that many pages quote stay: inside a container a text is template only
if every page of the host has it, or if its class also holds the tag of its own
element, so that both come and go together; quotation elements are never
template, and a host whose container text would be template for more than half
has copies of one article and loses nothing inside containers.

Defined results: null html is empty text; pages without a url share the host
""; repeated rows give equal rows; a host with too few pages has no template and
falls back to the elements alone.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import stage

LEAST_PAGES = 3
PAGE = 0  # stands for a page among its tokens
SUPPORT = 0.3
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title|select|object|math|canvas|button)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
BLOCKS = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside blockquote body center details dialog div dl fieldset figure footer form header html li main menu nav ol section table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT_TAGS = frozenset("nav aside footer form head menu dialog fieldset label".split())
OUT_WORDS = frozenset("ad ads advert advertisement advertising adsense adbox adslot banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup social share sharing related recommended recommendations sidebar breadcrumb breadcrumbs menu nav navbar navigation topbar masthead footer comment comments commentlist disqus reply replies respond widget toolbar pagination pager skip login search".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MAIN_WORDS = frozenset("article articlebody content story entry post maincontent".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
QUOTE = re.compile(r"/blockquote(?=[/.]|$)")


class Block(NamedTuple):
    text: str
    path: str
    out: bool  # inside a left-out element
    main: int  # number of the outermost semantic container, 0 outside
    linked: int  # characters inside links
    at: int  # number of the element that holds the block


class Tree(NamedTuple):
    parents: list[int]  # the element around each element; the root is its own
    mains: list[tuple[int, str]]  # element and path of each semantic container, from number 1 on


class _Open(NamedTuple):
    tag: str
    path: str
    out: bool
    header: bool
    main: int
    at: int


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)} if source else {}


def _words(value: str) -> set[str]:
    return set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))


def parse(page: str) -> tuple[list[Block], Counter, Tree]:
    """Text blocks in page order, the number of times each tag path occurs, and the elements that hold blocks."""
    stack = [_Open("", "", False, False, 0, 0)]
    tree = Tree([0], [(0, "")])
    blocks: list[Block] = []
    tags: Counter = Counter()
    text: list[str] = []
    links = linked = 0
    heading = False

    def flush() -> None:
        nonlocal linked
        joined = " ".join(html_lib.unescape("".join(text)).split())
        text.clear()
        top = stack[-1]
        if joined:
            blocks.append(Block(joined, top.path, top.out or (top.header and not (top.main and heading)), top.main, linked, top.at))
        linked = 0

    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            text.append(m["text"])
            if links:
                linked += len(m["text"])
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in BLOCKS:
                flush()
                heading = False
            if tag == "a":
                links = max(0, links - 1)
            if any(o.tag == tag for o in stack[1:]):
                while stack[-1].tag != tag:
                    stack.pop()
                stack.pop()
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            heading = tag in HEADINGS
            while stack[-1].tag == "p":
                stack.pop()
            if tag == "li":
                while stack[-1].tag in ("li", "p"):
                    stack.pop()
        if tag == "a":
            links += 1
        attributes = _attributes(m["attr"])
        named = _words(f"{attributes.get('class', '')} {attributes.get('id', '')}")
        role = attributes.get("role", "").lower()
        top = stack[-1]
        out = top.out or tag in OUT_TAGS or role in OUT_ROLES or bool(named & OUT_WORDS) or "hidden" in attributes or attributes.get("aria-hidden") == "true"
        if tag in ("body", "html", "article", "main") and not top.out:
            out = tag == "article" and bool(named & {"comment", "comments", "reply", "related", "ad", "sponsored"})
        header = top.header or tag == "header" or "header" in named
        path = f"{top.path}/{tag}" + (f".{attributes['class'].lower()}" if attributes.get("class") else "")
        tags[path] += 1
        if tag in VOID or m["attr"].endswith("/"):
            continue
        if tag in CONTAINERS or tag == "head" or (out and not top.out):
            main = top.main
            if not out and not main and (tag in ("article", "main") or role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody" or (tag in ("div", "section") and named & MAIN_WORDS)):
                main = len(tree.mains)
                tree.mains.append((len(tree.parents), path))
            stack.append(_Open(tag, path, out, header, main, len(tree.parents)))
            tree.parents.append(top.at)
    flush()
    return blocks, tags, tree


def main_text(blocks: list[Block], tree: Tree, template: frozenset[int], content_path: int | None, deduced: bool) -> str:
    """The article's slots, by its semantic containers and what lies around them, else all slots of the page."""
    kept = [b for b in blocks if not b.out]
    slots = [b for b in kept if token_id(b) not in template]
    if any(b.main for b in kept) and not any(b.main for b in slots):
        slots = kept  # the article of other pages once more
    sizes: Counter = Counter()
    for b in slots:
        if b.main:
            sizes[b.main] += len(b.text) - b.linked
    if not sizes:
        inside = lambda b: any(_digest(b.path[:m.start()]) == content_path for m in re.finditer("/|$", b.path))
        return "\n\n".join(b.text for b in slots if 2 * b.linked <= len(b.text) or inside(b))
    best, best_path = tree.mains[max(sizes, key=lambda k: (sizes[k], -k))]
    parent = at = tree.parents[best]
    around = {0, at}
    while at:
        at = tree.parents[at]
        around.add(at)
    beside = [deduced and parent == 0]  # per element: the container's parent or below it
    for i, up in enumerate(tree.parents[1:], 1):
        beside.append(deduced and (i == parent or beside[up]))

    def belongs(b: Block) -> bool:
        if b.main:
            own, path = tree.mains[b.main]
            return path == best_path or tree.parents[own] == parent
        return (b.at in around or beside[b.at]) and 2 * b.linked <= len(b.text)

    return "\n\n".join(b.text for b in slots if belongs(b))


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def token_id(block: Block) -> int:
    return _digest(f"{block.path}\n{block.text}")


def _host():
    """The host of the url, lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def _tokens(pages: DataFrame) -> DataFrame:
    """Per page: (host, page, token, is_text, times, path, free, holder, inner); ``path`` and ``holder`` are tag tokens.

    ``free`` are the unlinked characters of slots below a path; texts inside a
    container have their element as ``holder`` and their characters as ``inner`` instead.
    One row a page, with null ``is_text``, stands for the page and its ``inner``.
    """
    names = ["host", "page", "token", "is_text", "times", "path", "free", "holder", "inner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = source.as_py()
                blocks, tags, _ = parse(page)
                own = _digest(page)
                rows += [(host, own, _digest(p), False, n, None, 0, None, 0) for p, n in tags.items()]
                seen: dict[int, list] = {}
                for b in blocks:
                    if not b.main:
                        at = seen.setdefault(token_id(b), [0, _digest(b.path), 0 if b.out else max(0, len(b.text) - 2 * b.linked), None, 0])
                    elif b.out or QUOTE.search(b.path):
                        continue
                    else:
                        at = seen.setdefault(token_id(b), [0, None, 0, _digest(b.path), 0])
                        at[4] += len(b.text)
                    at[0] += 1
                rows += [(host, own, t, True, *at) for t, at in seen.items()]
                rows.append((host, own, PAGE, None, 1, None, 0, None, sum(at[4] for at in seen.values())))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return pages.mapInArrow(run, "host string, page long, token long, is_text boolean, times long, path long, free long, holder long, inner long")


def deduce_templates(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, template array<long>, content_path, deduced): the template's text tokens, the path of the main slot outside containers, and whether the host has pages enough; ``pages(host, html)``."""
    tokens = _tokens(pages).groupBy("host", "page", "token").agg(*(F.max(c).alias(c) for c in ("is_text", "times", "path", "free", "holder", "inner")))
    vectors = tokens.groupBy("host", "token").agg(
        F.max("is_text").alias("is_text"), F.count(F.lit(1)).alias("support"), F.bit_xor(F.xxhash64("page", "times")).alias("vector"),
        F.max("path").alias("path"), F.sum("free").alias("free"), F.max("holder").alias("holder"), F.sum("inner").alias("inner"))
    vectors = stage(spark, vectors.where(f"is_text is null or support >= {LEAST_PAGES} or free > 0"), "page-vectors")
    hosts = vectors.where("is_text is null").select("host", F.col("support").alias("pages"), F.col("inner").alias("all_inner"))
    frequent = vectors.where(f"is_text is not null and support >= {LEAST_PAGES}").join(hosts, "host").where(f"support >= {SUPPORT} * pages")
    frequent = stage(spark, frequent, "page-frequent")
    same = ["host", "support", "vector"]
    classes = frequent.groupBy(same).agg(F.count(F.lit(1)).alias("size")).where("size >= 2")
    # a class nests in the root if it is as frequent, else below it; every valid class is part of the host's template
    outside = frequent.where("is_text and holder is null").join(classes, same).select("host", "token")
    # inside containers also quoted passages form classes: those have no element of their own, and are not on every page
    held = frequent.where("not is_text").select(*same, F.col("token").alias("holder"), F.lit(True).alias("held"))
    inside = frequent.where("holder is not null").join(held, [*same, "holder"], "left").where("support = pages or held").select("host", "token", "inner", "all_inner")
    copies = inside.groupBy("host").agg(F.sum("inner").alias("inner"), F.max("all_inner").alias("all_inner")).where("2 * inner > all_inner").select("host")
    members = outside.unionByName(inside.join(copies, "host", "left_anti").select("host", "token"))
    template = members.groupBy("host").agg(F.collect_set("token").alias("template"))
    slots = vectors.where("is_text and free > 0").join(members, ["host", "token"], "left_anti")
    paths = slots.groupBy("host", "path").agg(F.sum("free").alias("free")).groupBy("host").agg(F.max_by("path", F.struct("free", "path")).alias("content_path"))
    enough = hosts.select("host", (F.col("pages") >= LEAST_PAGES).alias("deduced"))
    return stage(spark, enough.join(template.join(paths, "host", "full"), "host", "left").select("host", "template", "content_path", "deduced"), "templates")


def extract_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", _host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    templates = deduce_templates(spark, rows.select("host", "html"))
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "template", "content_path", "deduced")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, template, path, deduced in zip(batch.column(2), *(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
                blocks, _, tree = parse(page.as_py())
                texts.append(main_text(blocks, tree, frozenset(template or ()), path, bool(deduced)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
