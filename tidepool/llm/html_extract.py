"""Main text of web pages by removing each site's template.

First pass: every element subtree of every page is hashed (tag, texts and the
hashes of its children), and Spark counts for how many bodies of a host each hash
occurs. Pages of one body, copies and most near copies, have one vote: the sketch
of the least hashes of their blocks. A subtree in at least half of a host's bodies,
and in five or more, is template. Second pass: a page's template subtrees are
deleted (within ``article`` and ``main`` only boxes without running text, since
what recurs there may be near copies of one article), then what its
markup marks as no article (menus, headers, footers, asides, forms, scripts,
adverts, notices, comments by tag, role or class); the rest of its
``article`` elements, else of ``main``, else of the body, is the text.

A template hash occurs on half of a host's pages, so a host has at most twice as
many of them as its average page has subtrees: their list per host is as small
as a page. Counting combines before the shuffle, so a host with a third of all
pages is no more than its different subtrees. Whether the lists are broadcast
is up to Spark, which reads their size from the written table; a join on the
host is split where a host is large.

Defined cases: null or empty html gives an empty text; broken markup is read
as far as it goes (unclosed elements end with their parent); a page whose whole
text would be template keeps it; a null url is a host of its own (empty);
repeated rows and null ids give a row each; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ship, written

#: A subtree is template from this share of a host's pages, and this many pages, on.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 5
#: Least hashes of blocks in a body's sketch.
VOTE_BLOCKS = 2

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split())
#: An opening tag ends an open element of these kinds (up to the nearest of the second kind).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements of running text, and boxes that may hold them.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption".split())
BOXES = frozenset("div section aside ul ol dl table figure details fieldset center header footer".split())
P_ENDS = BLOCK - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"}
P_STOPS = frozenset({"td", "th", "li", "div", "article", "section", "body", "button", "dd", "figure", "blockquote"})

#: What is no part of an article: tags, roles, and words of class or id.
NO_ARTICLE = frozenset(
    "head script style noscript template nav aside footer form button select textarea iframe svg canvas object menu "
    "dialog title audio video".split())
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice popup modal overlay share sharing "
    "social related recommended newsletter subscribe widget login signup toolbar pagination pager skip".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|$)", re.I)
_KEEP, _SOFT, _HARD, _HEADER = range(4)


class Node:
    __slots__ = ("tag", "drop", "kids", "hash", "holds")

    def __init__(self, tag: str, drop: int = _KEEP):
        self.tag, self.drop, self.kids, self.hash, self.holds = tag, drop, [], 0, False


def _drop_of(tag: str, attributes: str) -> tuple[int, bool]:
    """(how firmly the element is no article, whether it is marked as main)."""
    if tag in NO_ARTICLE:
        return _HARD, False
    drop, main = (_HEADER if tag == "header" else _KEEP), tag in ("article", "main")
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return _HARD, False
            if name == "role":
                if value in NO_ARTICLE_ROLES:
                    return _HARD, False
                main |= value in ("main", "article")
            elif name in ("class", "id"):
                words = set(re.split(r"[\s_-]+", value))
                if words & COMMENT_WORDS:
                    return _HARD, False
                if words & NO_ARTICLE_WORDS:
                    drop = _SOFT
                elif drop == _KEEP and words & {"header", "masthead"}:
                    drop = _HEADER
    return drop, main


def parse(page: str) -> Node:
    """The element tree; every node with the hash of its subtree."""
    root = Node("#root")
    stack, open_ = [root], Counter()

    def close() -> None:
        node = stack.pop()
        open_[node.tag] -= 1
        parts = [node.tag]
        for kid in node.kids:
            if isinstance(kid, str):
                parts.append(" ".join(kid.split()))
            else:
                parts.append(f"\x00{kid.hash}")
        node.hash = xxhash.xxh3_64_intdigest("\x01".join(parts)) - (1 << 63)
        if stack and (node.holds or node.tag in ("article", "main")):
            stack[-1].holds = True

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            close()

    def text(raw: str) -> None:
        if raw:
            stack[-1].kids.append(entities.unescape(raw) if "&" in raw else raw)

    at, find = 0, _TOKEN.search
    while (m := find(page, at)) is not None:
        text(page[at:m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if open_[name] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != name:
                    depth -= 1
                close_to(depth)
            elif name == "p":
                stack[-1].kids.append(Node("p"))
            continue
        if name in P_ENDS and open_["p"] > 0:
            ends, stops = {"p"}, P_STOPS
        else:
            ends, stops = ENDS.get(name, (None, None))
        if ends:
            depth, found = len(stack) - 1, 0
            while depth > 0 and stack[depth].tag not in stops:
                if stack[depth].tag in ends:
                    found = depth
                depth -= 1
            if found:
                close_to(found)
        drop, main = _drop_of(name, m[3])
        node = Node("article" if main and name not in ("article", "main") else name, drop)
        if main:
            stack[-1].holds = True
        stack[-1].kids.append(node)
        if name in VOID or m[3].endswith("/") and name not in BLOCK:
            continue
        stack.append(node)
        open_[node.tag] += 1
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            inner = page[at:end.start()] if end else page[at:]
            text(inner)
            at = end.end() if end else len(page)
            close()
    text(page[at:])
    close_to(0)
    return root


def subtree_hashes(root: Node) -> set[int]:
    """The hashes of all subtrees that hold text."""
    out, stack = set(), [k for k in root.kids if not isinstance(k, str)]
    while stack:
        node = stack.pop()
        out.add(node.hash)
        stack += [k for k in node.kids if not isinstance(k, str)]
    return out


def _runs(node: Node) -> bool:
    """Whether there is running text in a subtree."""
    stack = [node]
    while stack:
        inner = stack.pop()
        if inner.tag in RUNNING:
            return True
        stack += [k for k in inner.kids if not isinstance(k, str)]
    return False


def body_sketch(root: Node) -> int:
    """A hash of the VOTE_BLOCKS least hashes of a page's blocks: mostly the same for near copies."""
    blocks, stack = set(), [k for k in root.kids if not isinstance(k, str)]
    while stack:
        node = stack.pop()
        if node.drop not in (_HARD, _SOFT):
            if node.tag in RUNNING or node.tag in BOXES and not _runs(node):
                blocks.add(node.hash)
            else:
                stack += [k for k in node.kids if not isinstance(k, str)]
    least = sorted(blocks, key=lambda h: xxhash.xxh64_intdigest(str(h)))[:VOTE_BLOCKS]
    return xxhash.xxh64_intdigest(" ".join(map(str, sorted(least)))) - 2**63


def _dropped(node: Node, in_article: bool, templates: frozenset) -> bool:
    if node.drop == _HARD:
        return True
    if node.hash in templates and node.tag not in VOID and not (in_article and (node.tag not in BOXES or _runs(node))):
        return True
    if node.drop == _SOFT:
        return not node.holds
    return node.drop == _HEADER and not in_article and not node.holds


def _roots(root: Node, tag: str, templates: frozenset) -> list[Node]:
    """The outermost kept elements of that tag, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == tag:
            out.append(node)
            continue
        stack += [k for k in reversed(node.kids) if not isinstance(k, str) and not _dropped(k, False, templates)]
    return out


def _text(nodes: list[Node], in_article: bool, templates: frozenset) -> str:
    parts, stack = [], list(reversed(nodes))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
            continue
        block = node.tag in BLOCK
        if block:
            parts.append(" ")
            stack.append(" ")
        stack += [k for k in reversed(node.kids) if isinstance(k, str) or not _dropped(k, in_article, templates)]
    return " ".join("".join(parts).split())


def main_text(root: Node, templates: frozenset = frozenset()) -> str:
    """The article's blocks, white space made single spaces, joined by one space."""
    for known in dict.fromkeys((templates, frozenset())):
        for tag in ("article", "main"):
            nodes = _roots(root, tag, known)
            if nodes and (text := _text(nodes, True, known)):
                return text
        if text := _text([root], False, known):
            return text
    return ""


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def site_templates(pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_PAGES) -> DataFrame:
    """(host, templates array<bigint>) from (page_id, host, html); of the pages of one body the first one counts."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, hosts, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for page in batch.column(2).to_pylist():
                root = parse(page)
                found.append((body_sketch(root), sorted({0, *subtree_hashes(root)})))  # 0 counts the bodies
            votes, hashes = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hosts, pa.string()), pa.array(votes, pa.int64()),
                                              pa.array(hashes, pa.list_(pa.int64()))], ["page_id", "host", "vote", "hashes"])

    bodies = (pages.select("page_id", "host", "html").mapInArrow(run, "page_id long, host string, vote long, hashes array<long>")
              .groupBy("host", "vote").agg(F.min(F.struct("page_id", "hashes")).alias("first")))
    counts = (bodies.select("host", F.explode("first.hashes").alias("hash")).groupBy("host", "hash")
              .agg(F.count("*").alias("n")).where(F.col("n") >= least))
    counts = written(counts, "html-subtrees")
    total = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    return (counts.where("hash <> 0").join(total, "host").where(F.col("n") >= share * F.col("pages"))
            .groupBy("host").agg(F.collect_list("hash").alias("templates")))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), _host(F.col(url_col)).alias("host"))
    templates = written(site_templates(rows.select("page_id", "host", "html")), "html-templates")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, urls, pages_, known = (batch.column(c) for c in ("page_id", "url", "html", "templates"))
            texts = [main_text(parse(p), frozenset(t or ())) for p, t in zip(pages_.to_pylist(), known.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (rows.join(templates, "host", "left").select("page_id", "url", "html", "templates")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
