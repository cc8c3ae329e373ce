"""Main text of web pages by wrappers: union-free expressions inferred from the pages of a host.

A page is read into a tree of elements (inline mark-up dropped, missing end tags supplied) with a slot for every text.
Two trees are aligned child by child: equal elements are aligned in turn; where they differ, an element like the one
before becomes a repetition, and otherwise the nearest element that both have is sought and what is skipped becomes
optional; texts that differ become slots, texts that are the same on most of a host's distinct pages (copies of a page
count once) belong to the template, and a text that fewer have is a slot, too. The first step is
done within every page, which folds its lists and paragraphs, so the pages of a host come down to few shapes. Shapes
are counted over all pages with an aggregate (with the extremes of every text's hash), and the shapes of a host are
aligned one after another, the commonest first, into its wrapper; of many shapes, stretches of SHAPES_PER_TASK first.

The wrapper says where the article is: in `article`, else `main`, else an element named for content, else the innermost
element with most of the varying text. Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are known by their element or name and left out anywhere. A page that has no such place, or nothing there but
template, or a host of one page, is read by the same rules over its own tree.

Trees have MAX_DEPTH levels: deeper elements are kept track of, but their texts become blocks of the element at that
level, except those of deeper asides, which go. Nulls and empty pages give an empty text. Pages without a host in their URL are a host of their own. Repeated rows get
equal texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, few_rows, written

SHAPES_PER_TASK, BROADCAST_ROWS, MAX_DEPTH = 200, 200_000, 200

#: Fixed values of HTML: elements without content, elements whose content is raw text, elements inside a line of text,
#: and elements that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes|template"
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: Elements that an element of the same kind ends, and what stops the search for it.
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

#: Elements and name parts that are not the article's own text.
ASIDE_TAGS = frozenset("head nav header footer aside form script style noscript select button iframe template dialog menu svg canvas object textarea title option fieldset".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promos promotion "
    "related respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets "
    "complementary contentinfo search alert replies reply discussion".split())
MAIN_NAMES = frozenset("article articlebody content entry main post posttext story text body".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>|(?P<text>[^<]++|<)", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: A slash at the end closes an element unless it is a part of an unquoted value.
_CLOSED = re.compile(r"(?:^|[\s\"']|\s[^\s\"'=]+)/\s*$")


class Node:
    """An element or a text ("#") of a page, or a part of a wrapper with its repetition and option marks."""

    __slots__ = ("sig", "children", "text", "size", "seen", "repeat", "optional")

    def __init__(self, sig: str, text=None, size: int = 0, seen: int = 1):
        """`seen`: how many distinct pages have a text here."""
        self.sig, self.children, self.text, self.size, self.seen, self.repeat, self.optional = sig, [], text, size, seen, False, False

    def expression(self) -> str:
        """The wrapper as a union-free expression."""
        inner = "".join(c.expression() for c in self.children)
        own = ("#" if self.text is None else "=") if self.sig == "#" else inner if self.sig.startswith("(") else f"<{self.sig}>{inner}</>"
        return f"({own})+" if self.repeat and not self.optional else f"({own})*" if self.repeat else f"({own})?" if self.optional else own


def _signature(tag: str, attrs: str) -> str:
    """Tag, and the values of class, id and role without digits."""
    if not attrs:
        return tag
    named = sorted({f"{m[1].lower()}={re.sub(r'[0-9]+', '', m[2] or m[3] or m[4] or '').strip()}" for m in _ATTR.finditer(attrs)})
    return " ".join([tag, *(n for n in named if not n.endswith("="))])


def _names(sig: str) -> set[str]:
    """Lower-case name parts of a signature's attributes."""
    return {part.lower() for value in re.findall(r"=([^=]*?)(?= (?:class|id|role)=|$)", sig) for part in _NAME.findall(value)}


def is_aside(sig: str) -> bool:
    tag = sig.split(" ", 1)[0]
    if tag in ASIDE_TAGS:
        return True
    return tag not in ("html", "body", "main") and bool(_names(sig) & ASIDE_NAMES)


def parse(page: str) -> Node:
    """The tree of a page."""
    top = Node("")
    stack = [top]

    def close(tag: str, stops: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            open_tag = stack[k].sig.split(" ", 1)[0]
            if open_tag == tag:
                del stack[k:]
                if k >= MAX_DEPTH:
                    stack[-1].children.append(Node("hr"))  # what follows is a block of its own
                return
            if open_tag in stops:
                return

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            last = stack[-1].children[-1] if stack[-1].children else None
            if last is not None and last.sig == "#":
                last.text += text
            elif not text.isspace():
                stack[-1].children.append(Node("#", text))
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        if tag == "br":
            last = stack[-1].children[-1] if stack[-1].children else None
            if last is not None and last.sig == "#":
                last.text += " "
            continue
        if m["end"]:
            close(tag, ("table", "article") if tag in ("p", "li", "td", "tr") else ())
            continue
        if tag in ENDS_PARAGRAPH:
            close("p", ("table", "article", "div", "section", "li", "td", "blockquote"))
        if tag in SIBLINGS:
            close(tag, SIBLINGS[tag])
            if tag in ("dt", "dd"):
                close("dd" if tag == "dt" else "dt", ("dl",))
        if tag in VOID:
            if tag == "hr":
                stack[-1].children.append(Node("hr"))
            continue
        node = Node(_signature(tag, m["attrs"]))
        stack[-1].children.append(node)
        if _CLOSED.search(m["attrs"]):
            continue
        if len(stack) >= MAX_DEPTH and not is_aside(node.sig):
            node, above = Node(node.sig), node
            node.children, above.sig = stack[-1].children, "hr"
        elif len(stack) >= MAX_DEPTH:
            stack[-1].children.pop()
        stack.append(node)
    return top


# --- alignment ---------------------------------------------------------------------------------------------

def align(a: Node, b: Node, same_page: bool = False) -> Node:
    """The least expression that covers both; their signatures are equal. Neighbours in one tree are of the same pages."""
    out = Node(a.sig, a.text if a.text == b.text else None, a.size + b.size, max(a.seen, b.seen) if same_page else a.seen + b.seen)
    out.repeat, out.optional = a.repeat or b.repeat, a.optional or b.optional
    out.children = _align_children(a.children, b.children, same_page)
    return out


def _optional(node: Node) -> Node:
    node.optional = True
    return node


def _next(sig: str, nodes: list[Node], start: int) -> int:
    return next((k for k in range(start, len(nodes)) if nodes[k].sig == sig), -1)


def _align_children(a: list[Node], b: list[Node], same_page: bool = False) -> list[Node]:
    out: list[Node] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i].sig == b[j].sig:
            out.append(align(a[i], b[j], same_page))
            i, j = i + 1, j + 1
            continue
        if out and i < len(a) and a[i].sig == out[-1].sig:
            out[-1] = align(out[-1], a[i], True)
            out[-1].repeat = True
            i += 1
            continue
        if out and j < len(b) and b[j].sig == out[-1].sig:
            out[-1] = align(out[-1], b[j], True)
            out[-1].repeat = True
            j += 1
            continue
        in_b = _next(a[i].sig, b, j) if i < len(a) else -1
        in_a = _next(b[j].sig, a, i) if j < len(b) else -1
        if in_b >= 0 and (in_a < 0 or in_b - j <= in_a - i):
            out += map(_optional, b[j:in_b])
            j = in_b
        elif in_a >= 0:
            out += map(_optional, a[i:in_a])
            i = in_a
        else:
            if i < len(a):
                out.append(_optional(a[i]))
                i += 1
            if j < len(b):
                out.append(_optional(b[j]))
                j += 1
    return out


def _alike(a: Node, b: Node) -> bool:
    """Whether one of the elements has all the kinds of children that the other has."""
    x, y = {c.sig for c in a.children}, {c.sig for c in b.children}
    return x <= y or y <= x


def fold(node: Node) -> Node:
    """Neighbours with equal signatures and like children become one repetition, and so do neighbouring groups of two to four."""
    kids: list[Node] = []
    for child in map(fold, node.children):
        if kids and kids[-1].sig == child.sig and child.sig != "#" and _alike(kids[-1], child):
            kids[-1] = align(kids[-1], child)
            kids[-1].repeat = True
        else:
            kids.append(child)
    for width in (2, 3, 4):
        k = 0
        while k + 2 * width <= len(kids):
            group = [c.sig for c in kids[k:k + width]]
            times = 1
            while [c.sig for c in kids[k + times * width:k + (times + 1) * width]] == group:
                times += 1
            if times > 1:
                whole = None
                for t in range(times):
                    part = Node("(" + ",".join(group) + ")")
                    part.children = kids[k + t * width:k + (t + 1) * width]
                    whole = part if whole is None else align(whole, part)
                whole.repeat = True
                kids[k:k + times * width] = [whole]
            k += 1
    node.children = kids
    return node


def shape_of(page: str) -> tuple[str, list[tuple[int, int]]]:
    """A page's folded tree as text, and (hash or 0 where it varies within the page, length) of its texts in order."""
    top = parse(page)

    def hashed(node: Node) -> None:
        if node.sig == "#":
            words = " ".join(node.text.split())
            node.text, node.size = int.from_bytes(hashlib.blake2b(words.encode("utf-8", "replace"), digest_size=7).digest(), "big") + 1, len(words)
        for child in node.children:
            hashed(child)

    hashed(top)
    slots: list[tuple[int, int]] = []

    def walk(node: Node) -> list:
        if node.sig == "#":
            slots.append((node.text or 0, node.size))
        return [node.sig, int(node.repeat) + 2 * int(node.optional), [walk(c) for c in node.children]]

    return json.dumps(walk(fold(top)), separators=(",", ":"), ensure_ascii=False), slots


def tree_of(shape: str, slots: list[tuple[int | None, int] | tuple[int | None, int, int]]) -> Node:
    """The tree that `shape_of` wrote; a slot's text is its hash, or None where texts differ, then its size and how many pages have it."""
    rest = iter(slots)

    def build(item: list) -> Node:
        node = Node(item[0])
        node.repeat, node.optional = bool(item[1] & 1), bool(item[1] & 2)
        if node.sig == "#":
            node.text, node.size, *seen = next(rest)
            node.seen = seen[0] if seen else 1
        node.children = [build(c) for c in item[2]]
        return node

    return build(json.loads(shape))


def dump_tree(node: Node) -> tuple[str, list[tuple[int | None, int, int]]]:
    slots: list[tuple[int | None, int, int]] = []

    def walk(n: Node) -> list:
        if n.sig == "#":
            slots.append((n.text, n.size, n.seen))
        return [n.sig, int(n.repeat) + 2 * int(n.optional), [walk(c) for c in n.children]]

    return json.dumps(walk(node), separators=(",", ":"), ensure_ascii=False), slots


# --- where the article is ----------------------------------------------------------------------------------

def _places(node: Node, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], Node]]:
    """Elements outside asides with their paths; repeated groups are no element of their own."""
    for child in node.children:
        if child.sig == "#" or is_aside(child.sig):
            continue
        if child.sig.startswith("("):
            yield from _places(child, path)
            continue
        yield (*path, child.sig), child
        yield from _places(child, (*path, child.sig))


def _varying(node: Node, keep_template: bool) -> int:
    own = node.size if node.sig == "#" and (keep_template or node.text is None) else 0
    return own + sum(_varying(c, keep_template) for c in node.children if c.sig == "#" or not is_aside(c.sig))


def find_article(top: Node, template_known: bool) -> tuple[list[str], bool]:
    """(path of the article's element, whether it was found by its varying text alone)."""
    places = list(_places(top))
    for wanted in ("article", "main"):
        named = [p for p, n in places if n.sig.split(" ", 1)[0] == wanted or (wanted == "main" and "role=main" in n.sig) or (wanted == "article" and "role=article" in n.sig)]
        if named:
            return list(min(named, key=len)), False
    keep = not template_known
    named = [(p, n) for p, n in places if n.sig.split(" ", 1)[0] not in ("html", "body") and _names(n.sig) & MAIN_NAMES]
    if named:
        best = max(named, key=lambda x: (_varying(x[1], keep), -len(x[0])))
        if _varying(best[1], keep) > 0:
            return list(best[0]), False
    total, path, node = _varying(top, keep), [], top
    while True:
        inner = [(p, n) for p, n in _places(node) if len(p) == 1]
        best = max(inner, key=lambda x: _varying(x[1], keep), default=None)
        if best is None or best[1].repeat or 2 * _varying(best[1], keep) <= total:
            return path, True
        if best[1].sig.split(" ", 1)[0] in ("p", "h1", "h2", "h3", "ul", "ol", "table", "blockquote", "pre"):
            return path, True
        path, node = [*path, best[1].sig], best[1]


def _release(node: Node, pages: int) -> None:
    """A text that not most of the distinct pages have is no template."""
    if node.sig == "#" and 2 * node.seen <= pages:
        node.text = None
    for child in node.children:
        _release(child, pages)


def wrapper_of(trees: list[Node], pages: int) -> dict:
    """What extraction needs of a host's wrapper; `pages` are its distinct ones."""
    whole = trees[0]
    for tree in trees[1:]:
        whole = align(whole, tree)
    if pages > 2:
        _release(whole, pages)
    path, by_text = find_article(whole, pages > 2)
    return {"path": path, "template": sorted(_constants(whole)) if by_text and pages > 2 else [], "expression": whole.expression()}


def _constants(node: Node) -> set[int]:
    own = {node.text} if node.sig == "#" and node.text else set()
    return own.union(*map(_constants, node.children))


def blocks(node: Node, template: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """The texts below an element in page order, one for each block."""
    out: list[str] = []
    for child in node.children:
        if child.sig == "#":
            text = " ".join(unescape(child.text).split())
            if text and not (template and int.from_bytes(hashlib.blake2b(" ".join(child.text.split()).encode("utf-8", "replace"), digest_size=7).digest(), "big") + 1 in template):
                out.append(text)
        elif not is_aside(child.sig):
            out += blocks(child, template)
    return out


def _at(node: Node, path: list[str]) -> list[Node]:
    if not path:
        return [node]
    return [found for child in node.children if child.sig == path[0] for found in _at(child, path[1:])]


def main_text(page: str, wrapper: dict | None) -> str:
    """A page's text by its host's wrapper, or by its own tree where that has no place for it."""
    top = parse(page)
    found = _at(top, wrapper["path"]) if wrapper else []
    template = set(wrapper["template"]) if wrapper else set()
    texts = [text for node in found for text in blocks(node, template)]
    if not found or (template and not texts):
        for node in (own := parse(page)).children:
            _measure(node)
        texts = [text for node in _at(top, find_article(own, False)[0]) for text in blocks(node)]
    return "\n".join(texts)


def _measure(node: Node) -> None:
    if node.sig == "#":
        node.size = len(node.text)
    for child in node.children:
        _measure(child)


# --- over DataFrames ---------------------------------------------------------------------------------------

def host_of(url):
    """Lower-case host of a URL column; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def host_shapes(pages: DataFrame) -> DataFrame:
    """(host, shape, pages, slots): every shape of a host, with hash (null where pages differ) and summed length per text. Pages with equal html count once."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            made = [shape_of(t or "") for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([[{"hash": h, "size": s} for h, s in m[1]] for m in made], pa.list_(pa.struct([("hash", pa.int64()), ("size", pa.int64())])))],
                                             names=["shape", "slots"])

    made = F.arrow_udf(run, "struct<shape:string,slots:array<struct<hash:bigint,size:bigint>>>")(F.col("html"))
    shaped = pages.select("host", F.md5(F.col("html").cast("binary")).alias("content"), made.alias("s")).select("host", "content", "s.*").distinct()
    keyed = shaped.select("host", "shape", F.posexplode_outer("slots").alias("pos", "slot"))
    slots = keyed.groupBy("host", "shape", "pos").agg(
        F.count("*").alias("pages"), F.when(F.min("slot.hash") == F.max("slot.hash"), F.nullif(F.max("slot.hash"), F.lit(0))).alias("hash"), F.sum("slot.size").alias("size"))
    return slots.groupBy("host", "shape").agg(F.max("pages").alias("pages"), F.array_sort(F.collect_list(F.struct("pos", "hash", "size"))).alias("slots"))


def _slots(row, pages: int) -> list[tuple[int | None, int, int]]:
    return [(None if s["hash"] is None else int(s["hash"]), int(s["size"] or 0), pages) for s in row if s["pos"] is not None]


def host_wrappers(pages: DataFrame, shapes_per_task: int = SHAPES_PER_TASK) -> DataFrame:
    """(host, distinct pages, wrapper as JSON) from (host, html)."""
    shapes = written(host_shapes(pages), "shapes")
    many = shapes.groupBy("host").agg(F.count("*").alias("shapes"))
    parts = shapes.join(many, "host").withColumn("part", F.pmod(F.xxhash64("shape"), F.ceil(F.col("shapes") / shapes_per_task)).cast("int"))

    def first(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pages", "shape"], ascending=[False, True])
        trees = [tree_of(s, _slots(x, int(n))) for s, x, n in zip(rows["shape"], rows["slots"], rows["pages"], strict=True)]
        whole = trees[0]
        for tree in trees[1:]:
            whole = align(whole, tree)
        shape, slots = dump_tree(whole)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "part": [rows["part"].iloc[0]], "pages": [rows["pages"].sum()], "tree": [json.dumps([shape, slots])]})

    def second(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pages", "part"], ascending=[False, True])
        trees = [tree_of(*json.loads(t)) for t in rows["tree"]]
        pages_seen = int(rows["pages"].sum())
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "pages": [pages_seen], "wrapper": [json.dumps(wrapper_of(trees, pages_seen))]})

    return parts.groupBy("host", "part").applyInPandas(first, "host string, part int, pages bigint, tree string").groupBy("host").applyInPandas(
        second, "host string, pages bigint, wrapper string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shapes_per_task: int = SHAPES_PER_TASK) -> DataFrame:
    """(page_id, url, host, text, n_chars) of every page."""
    bounded_batches(pages.sparkSession, 500)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    wrappers = written(host_wrappers(rows.select("host", "html"), shapes_per_task), "wrappers").select(
        "host", F.to_json(F.struct(F.get_json_object("wrapper", "$.path").alias("path"), F.get_json_object("wrapper", "$.template").alias("template"))).alias("wrapper"))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known: dict[str, dict] = {}
        for html, wrapper in batches:
            texts = []
            for page, spec in zip(html.to_pylist(), wrapper.to_pylist(), strict=True):
                if spec is not None and spec not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[spec] = {k: json.loads(v) for k, v in json.loads(spec).items()}
                texts.append(main_text(page or "", known[spec] if spec is not None else None))
            yield pa.array(texts, pa.string())

    joined = rows.join(few_rows(wrappers, BROADCAST_ROWS), "host", "left")
    return joined.select("page_id", "url", "host", F.arrow_udf(run, "string")(F.col("html"), F.col("wrapper")).alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
