"""Problem 1: markup residue. Chunks are parsed to trees, same-host trees are aligned by simple tree matching, constant
nodes become the host's template, varying slots content; the content is then written as clean text."""

from __future__ import annotations

import html
import math
import operator
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from html.entities import html5
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.llm.bits import SALTS, salted_join
from quarryloom.runtime import cut, spread

#: Each shape's nodes are voted on by its own pages, and besides by those of all shapes of its host and field that have at
#: least such a share of labels in common with it: pages of one layout, pages alike, all pages.
NEAR = (0.75, 0.5, 0.0)
#: Nodes and votes of the shapes that are packed into one row, so that a host's shapes meet in pairs of rows, and such pairs a
#: task. No result depends on them.
BLOCK_NODES, PAIRS_PER_TASK = 1024, 32
#: A node is template when at least so many pages have it and this share of them has the same text there.
MIN_SUPPORT, CONSTANT_SHARE = 5, 0.6

#: HTML element names.
ELEMENTS = frozenset(
    "a abbr acronym address applet area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data "
    "datalist dd del details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i "
    "iframe img input ins kbd label legend li link main map mark menu meta meter nav noscript object ol optgroup option output p param picture pre progress q rp rt "
    "ruby s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track "
    "tt u ul var video wbr".split())
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
#: LaTeX commands that take no braces.
BARE_COMMANDS = frozenset("item ldots dots hline newline noindent centering par maketitle tableofcontents LaTeX TeX newpage clearpage appendix bigskip medskip smallskip indent hfill vfill".split())
MARKER = "<!-- Data Table -->"

#: Marks that pair over any length are found by ``_paired`` and ``_formulas``, which pass over a text once.
_FENCE = re.compile(r"^[ \t]*(```+).*?(?:^[ \t]*\1`*[ \t]*\r?$|\Z)", re.M | re.S)
_TICKS = re.compile(r"`+")
_MAYBE = re.compile(r"[<&*_\[\]{}#=\\$~']|^[ \t]{0,3}-{2,}", re.M)

_HTML = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s+[A-Za-z_:@][\w:.\-]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?)*)\s*(/?)>|<![A-Za-z][^>]*>", re.S)
#: An entity, escaped once or more often.
_ENTITY = re.compile(r"&(?:amp;)*(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_TEX_ENV = re.compile(r"\\(begin|end)\{([A-Za-z]+\*?)\}(?:\[[^\]\n]*\])?")
_TEX_OPEN = re.compile(r"\$\$(?=\S|\n)|\\\[|\\\(")
_TEX_INLINE = re.compile(r"(?<![\\$\w])\$(?![\s$])([^$\n]*[^\s$\\])\$(?![\d$])")
_TEX_MATH = re.compile(r"[\\^_={}<>+*/]|^[A-Za-z]$|^[A-Za-z]\(")
_TEX_CMD = re.compile(r"(?<![\w\\:/])\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?(?:\{([^{}\n]*)\})")
_TEX_BARE = re.compile(r"(?<![\w\\:/])\\([A-Za-z]+)(?![\w{\\])")
_WIKI_TABLE = re.compile(r"^[ \t]*\{\|.*?(?:^[ \t]*\|\}|\Z)", re.M | re.S)
_WIKI_HEAD = re.compile(r"^[ \t]*(={1,6})[ \t]*([^=\s](?:[^\n]*?[^=\s])?)[ \t]*\1[ \t]*\r?$", re.M)
_WIKI_LINK = re.compile(r"\[\[([^\[\]\n|]+)(?:\|([^\[\]\n]*))?\]\]")
_WIKI_EXT = re.compile(r"(?<!\[)\[((?:https?|ftp)://[^\s\]]+)(?:[ \t]+([^\]\n]*))?\](?![(\[:])")
_WIKI_TEMPLATE = re.compile(r"\{\{[ \t]*[^{}|\n\s][^{}|\n]*(?:\|[^{}]*)*\}\}")
_QUOTES = re.compile(r"'+")
_MD_IMAGE = re.compile(r"!\[([^\]\n]*)\](?:\(([^()\s]*(?:\([^()\s]*\)[^()\s]*)*)(?:\s+[\"'][^\n\"']*[\"'])?\)|\[[^\]\n]*\])")
_MD_LINK = re.compile(r"(?<![!\[])\[([^\[\]\n]+)\]\(([^()\n]*(?:\([^()\n]*\)[^()\n]*)*)\)")
_MD_REF = re.compile(r"(?<![!\[\]])\[([^\[\]\n]+)\]\[([^\[\]\n]*)\]")
_MD_DEF = re.compile(r"^[ \t]{0,3}\[([^\[\]\n]+)\]:[ \t]*\S[^\n]*$", re.M)
_MD_HEAD = re.compile(r"^[ \t]{0,3}(#{1,6})[ \t]+(?=\S)([^\n]*?)[ \t]*#*[ \t]*\r?$", re.M)
_MD_UNDER = re.compile(r"^([ \t]{0,3}(?![-=>|+*#]|\d+[.)] )[^\s|][^\n|]*)\n[ \t]{0,3}(=+|-{2,})[ \t]*\r?$", re.M)
_MD_STRIKE = re.compile(r"(?<!~)~~(?=\S)([^\n~]+?)(?<=\S)~~(?!~)")
_MD_STAR = re.compile(r"(?<![\\*\w])(\*{1,3})(?=[^\s*])([^*\n]*[^\s*])\1(?!\*)|(?<!\*)(\*{1,3})(?=[^\s*])([^*\n]*[^\s*])\3(?![\w*])")
_SCORES = re.compile(r"_+")


def _blank(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with spans overwritten by U+0000, so that offsets stay and nothing is found in them; line feeds stay."""
    parts, at = [], 0
    for a, b in sorted(spans):
        a = max(a, at)
        if b > a:
            parts += (text[at:a], re.sub(r"[^\n]", "\0", text[a:b]))
            at = b
    return "".join(parts) + text[at:]


def _paired(text: str, marks: re.Pattern, opens: Callable[[int, int], bool], closes: Callable[[int, int], bool]) -> Iterator[tuple[int, int, str]]:
    """``(start, end, inner text)`` of runs of marks on one line and the next run of the same length there, in one pass.

    ``opens`` and ``closes`` say of a run, given its start and end, whether it can begin or end such a span.
    """
    line: list[tuple[int, int]] = []

    def spans() -> Iterator[tuple[int, int, str]]:
        ends: dict[int, int] = {}
        partner: list[int | None] = [None] * len(line)
        for i in range(len(line) - 1, -1, -1):
            size = line[i][1] - line[i][0]
            partner[i] = ends.get(size)
            if closes(*line[i]):
                ends[size] = i
        i = 0
        while i < len(line):
            j = partner[i] if opens(*line[i]) else None
            if j is not None:
                yield line[i][0], line[j][1], text[line[i][1] : line[j][0]]
                i = j
            i += 1

    for m in marks.finditer(text):
        if line and text.find("\n", line[-1][1], m.start()) >= 0:
            yield from spans()
            line.clear()
        line.append(m.span())
    yield from spans()


def _formulas(text: str) -> Iterator[tuple[int, int, str]]:
    """Display and inline formulas in ``$$``, ``\\[`` and ``\\(``: ``(start, end, formula)``. An opening mark without its end is none."""
    ends, open_only, at = {"$$": "$$", "\\[": "\\]", "\\(": "\\)"}, set(), 0
    while m := _TEX_OPEN.search(text, at):
        at = m.end()
        if m.group() not in open_only:
            end = text.find(ends[m.group()], at + 1)
            if end < 0:
                open_only.add(m.group())
            else:
                yield m.start(), end + 2, text[at:end].strip()
                at = end + 2


def _tags(text: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """Tags in order, and comments of any length as ``None``."""
    at, comments = 0, True
    while m := _HTML.search(text, at):
        at = m.end()
        if m.group() != "<!--":
            yield *m.span(), m
        elif comments:
            end = text.find("-->", at)
            comments = end >= 0
            if comments:
                at = end + 3
                yield m.start(), at, None


def _inline_code(text: str) -> list[tuple[int, int]]:
    return [(a, b) for a, b, _ in _paired(text, _TICKS, lambda a, b: True, lambda a, b: True)]


def code_spans(text: str) -> list[tuple[int, int]]:
    fences = [m.span() for m in _FENCE.finditer(text)] if "```" in text else []
    return fences + _inline_code(_blank(text, fences))


def scan(text: str | None, heading: bool = False) -> list[tuple[int, int, str, str, str]]:
    """Markup outside of code as ``(start, end, kind, name, inner text)``, in order; inner tokens of another are found too."""
    if not text or not _MAYBE.search(text):
        return []
    plain = text
    if "`" in text:
        plain = _blank(text, code_spans(text) if not heading else _inline_code(text))
    found: list[tuple[int, int, str, str, str]] = []
    hide: list[tuple[int, int]] = []
    if "<" in plain:
        for start, end, m in _tags(plain):
            if m is None:
                if plain[start:end] != MARKER:
                    found.append((start, end, "html", "!--", ""))
            elif m.group().startswith("<!"):
                found.append((start, end, "html", "!doctype", ""))
            else:
                name = m.group(2).lower()
                # List<T>: a capital that follows a word, without end tag or attribute, is a type parameter.
                generic = not m.group(1) and not m.group(3) and len(name) == 1 and m.group(2).isupper() and plain[m.start() - 1 : m.start()].isalnum()
                if name not in ELEMENTS or generic:
                    continue
                found.append((start, end, "html", m.group(1) + name, m.group(3) or ""))
            hide.append((start, end))
    if "&" in plain:
        for m in _ENTITY.finditer(plain):
            body = re.sub(r"^&(?:amp;)*(?=.)", "", m.group())
            if body[0] == "#" or body in html5:
                found.append((*m.span(), "html", "&", m.group()))
                hide.append(m.span())
    if hide:
        plain, hide = _blank(plain, hide), []
    if "\\" in plain or "$" in plain:
        for m in _TEX_ENV.finditer(plain):
            found.append((*m.span(), "latex", m.group(1) + ":" + m.group(2), ""))
            hide.append(m.span())
        for start, end, inner in _formulas(plain):
            found.append((start, end, "latex", "formula", inner))
            hide.append((start, end))
        if hide:
            plain, hide = _blank(plain, hide), []
        for m in _TEX_INLINE.finditer(plain):
            if _TEX_MATH.search(m.group(1)):
                found.append((*m.span(), "latex", "formula", m.group(1)))
                hide.append(m.span())
        if hide:
            plain, hide = _blank(plain, hide), []
        for m in _TEX_CMD.finditer(plain):
            found.append((*m.span(), "latex", m.group(1), m.group(2)))
        for m in _TEX_BARE.finditer(plain):
            if m.group(1) in BARE_COMMANDS:
                found.append((*m.span(), "latex", m.group(1), ""))
    if "{" in plain:
        for m in _WIKI_TABLE.finditer(plain):
            found.append((*m.span(), "wiki", "table", ""))
            hide.append(m.span())
        for m in _WIKI_TEMPLATE.finditer(plain):
            found.append((*m.span(), "wiki", "template", m.group()[2:-2].partition("|")[2]))
            hide.append(m.span())
        if hide:
            plain, hide = _blank(plain, hide), []
    if "''" in plain:
        known = lambda a, b: b - a in (2, 3, 5)
        found.extend((a, b, "wiki", "quote", inner) for a, b, inner in _paired(plain, _QUOTES, known, known))
    if "=" in plain or "#" in plain or "--" in plain:
        for m in _WIKI_HEAD.finditer(plain):
            found.append((*m.span(), "wiki", "heading", m.group(1)))
        for m in _MD_HEAD.finditer(plain):
            found.append((*m.span(), "markdown", "heading", m.group(1)))
        if not heading:
            for m in _MD_UNDER.finditer(plain):
                found.append((*m.span(), "markdown", "underlined", m.group(2)[0]))
    if "[" in plain:
        for kind, name, rx, group in (("wiki", "link", _WIKI_LINK, 0), ("wiki", "external", _WIKI_EXT, 2), ("markdown", "image", _MD_IMAGE, 1), ("markdown", "link", _MD_LINK, 1), ("markdown", "reference", _MD_REF, 1), ("markdown", "definition", _MD_DEF, 0)):
            for m in rx.finditer(plain):
                inner = (m.group(2) or m.group(1)) if name == "link" and kind == "wiki" else (m.group(2) or m.group(1)) if name == "external" else m.group(group) if group else ""
                found.append((*m.span(), kind, name, inner))
    if "~~" in plain:
        found.extend((*m.span(), "markdown", "strike", m.group(1)) for m in _MD_STRIKE.finditer(plain))
    if "*" in plain:
        found.extend((*m.span(), "markdown", "emphasis", m.group(2) or m.group(4)) for m in _MD_STAR.finditer(plain))
    if "_" in plain:
        opens = lambda a, b: b - a < 4 and not (a and (plain[a - 1].isalnum() or plain[a - 1] == "\\")) and not plain[b : b + 1].isspace() and b < len(plain)
        closes = lambda a, b: a > 0 and not plain[a - 1].isspace() and not plain[b : b + 1].isalnum()
        found.extend((a, b, "markdown", "emphasis", inner) for a, b, inner in _paired(plain, _SCORES, opens, closes))
    found.sort(key=lambda t: (t[0], -t[1]))
    return found


class Node:
    __slots__ = ("children", "kind", "label", "span", "text")

    def __init__(self, label: str, kind: str, text: str, span: tuple[int, int]):
        self.label, self.kind, self.text, self.span, self.children = label, kind, text, span, []


def tree(text: str, tokens: list[tuple[int, int, str, str, str]]) -> Node:
    """The document tree: elements and environments nest, other markup and the lines of text between are leaves."""
    root = Node("#root", "", "", (0, len(text)))
    stack, at = [root], 0

    def words(upto: int) -> None:
        nonlocal at
        if upto > at and text[at:upto].strip():
            stack[-1].children.append(Node("#text", "", " ".join(text[at:upto].split()), (at, upto)))
        at = max(at, upto)

    for start, end, kind, name, inner in tokens:
        if start < at and kind != "html":
            stack[-1].children.append(Node(f"{kind}:{name}", kind, inner, (start, end)))
            continue
        words(start)
        at = max(at, end)
        closing = name.startswith("/") or name.startswith("end:")
        bare = name.lstrip("/").partition(":")[2] if name.startswith(("begin:", "end:")) else name.lstrip("/")
        label = f"{kind}:{bare}"
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].label == label:
                    del stack[depth:]
                    break
            else:
                stack[-1].children.append(Node(f"{label}/", kind, "", (start, end)))
            continue
        node = Node(label, kind, inner, (start, end))
        stack[-1].children.append(node)
        if (kind == "html" and bare in ELEMENTS and bare not in _VOID) or name.startswith("begin:"):
            stack.append(node)
    words(len(text))
    return root


def flatten(root: Node) -> tuple[list[int], list[str], list[int]]:
    """Preorder arrays: parent index, label, hash of the node's own text."""
    parents, labels, hashes, todo = [], [], [], [(root, -1)]
    while todo:
        node, parent = todo.pop()
        me = len(parents)
        parents.append(parent)
        labels.append(node.label)
        hashes.append(xxhash.xxh32_intdigest(node.text) if node.text else 0)
        todo.extend((c, me) for c in reversed(node.children))
    return parents, labels, hashes


class Shape:
    """A tree's preorder arrays with children, heights and, for each node, a number that nodes with equal trees below them share."""

    __slots__ = ("canon", "heights", "inner", "kids", "labels")

    def __init__(self, parents: list[int], labels: list[str], known: dict[tuple, int]):
        self.labels = labels
        self.kids: list[list[int]] = [[] for _ in parents]
        for i, p in enumerate(parents):
            if p >= 0:
                self.kids[p].append(i)
        self.canon, self.heights = [0] * len(parents), [0] * len(parents)
        for i in range(len(parents) - 1, -1, -1):
            if self.kids[i]:
                self.heights[i] = 1 + max(self.heights[c] for c in self.kids[i])
            self.canon[i] = known.setdefault((labels[i], *[self.canon[c] for c in self.kids[i]]), len(known))
        #: Distinct children that have children themselves.
        self.inner = [list({self.canon[c]: c for c in k if self.kids[c]}.values()) for k in self.kids]


#: Children lists with more pairs than this are compared a row at a time by numpy, in memory of their length times its root.
_FEW_PAIRS = 2048


def _lists(a: Shape, b: Shape, x: int, y: int, memo: dict[tuple[int, int], int], trace: bool) -> tuple[int, list[tuple[int, int]]]:
    """The greatest weight of an order-preserving matching of two nodes' children, and with ``trace`` its pairs."""
    xs, ys = a.kids[x], b.kids[y]

    def weight(i: int, k: int) -> int:
        if a.labels[i] != b.labels[k]:
            return 0
        return memo[a.canon[i], b.canon[k]] if a.kids[i] and b.kids[k] else 1

    pairs, i, j = [], len(xs), len(ys)
    if len(xs) * len(ys) <= _FEW_PAIRS:
        rows = [[0] * (len(ys) + 1)]
        for u in xs:
            last, row = rows[-1], [0]
            for k, v in enumerate(ys):
                w = weight(u, v)
                row.append(max(last[k + 1], row[k], last[k] + w if w else 0))
            rows.append(row)
        while trace and i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        return rows[-1][-1], pairs
    column: dict[int, int] = {}
    at = np.array([column.setdefault(b.canon[v], len(column)) for v in ys])
    distinct = list({b.canon[v]: v for v in ys}.values())
    weights: dict[int, np.ndarray] = {}

    def following(last: np.ndarray, u: int) -> np.ndarray:
        if a.canon[u] not in weights:
            weights[a.canon[u]] = np.array([weight(u, v) for v in distinct], dtype=np.int64)
        row = np.zeros_like(last)
        np.maximum.accumulate(np.maximum(last[1:], last[:-1] + weights[a.canon[u]][at]), out=row[1:])
        return row

    step, row = math.isqrt(len(xs)) + 1, np.zeros(len(ys) + 1, dtype=np.int64)
    starts = [row]
    for n, u in enumerate(xs, 1):
        row = following(row, u)
        if n % step == 0:
            starts.append(row)
    while trace and i and j:
        first = (i - 1) // step * step
        rows = [starts[first // step]]
        for u in xs[first:i]:
            rows.append(following(rows[-1], u))
        while i > first and j:
            here, above = rows[i - first], rows[i - first - 1]
            if here[j] == above[j]:
                i -= 1
            elif here[j] == here[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
    return int(row[-1]), pairs


def match_shapes(a: Shape, b: Shape) -> list[tuple[int, int]]:
    """Simple tree matching: the largest order- and ancestor-preserving set of equally labelled node pairs, roots included."""
    need, todo = {(a.canon[0], b.canon[0]): (0, 0)}, [(0, 0)]
    while todo:
        x, y = todo.pop()
        for i in a.inner[x]:
            for k in b.inner[y]:
                key = a.canon[i], b.canon[k]
                if a.labels[i] == b.labels[k] and key not in need:
                    need[key] = i, k
                    todo.append((i, k))
    memo: dict[tuple[int, int], int] = {}
    del need[a.canon[0], b.canon[0]]
    for key, (x, y) in sorted(need.items(), key=lambda n: a.heights[n[1][0]]):
        memo[key] = 1 + _lists(a, b, x, y, memo, False)[0]
    out, todo = [], [(0, 0)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        if a.kids[x] and b.kids[y]:
            todo.extend(_lists(a, b, x, y, memo, True)[1])
    return out


def match_trees(a: tuple[list[int], list[str]], b: tuple[list[int], list[str]]) -> list[tuple[int, int]]:
    """``match_shapes`` of two trees in preorder arrays."""
    known: dict[tuple, int] = {}
    return match_shapes(Shape(*a, known), Shape(*b, known))


KINDS = ("html", "latex", "markdown", "wiki")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())]
    names = ["id", "field", "host", "shape", "parents", "labels", "hashes"]
    for b in batches:
        rows = []
        for i, host, heading, content in zip(*(b.column(c).to_pylist() for c in ("id", "host", "heading", "content")), strict=True):
            for field, text in (("heading", heading), ("content", content)):
                tokens = scan(text, field == "heading")
                if tokens:
                    parents, labels, hashes = flatten(tree(text, tokens))
                    shape = xxhash.xxh64_intdigest(f"{parents}{labels}") - (1 << 63)
                    rows.append((i, field, host, shape, parents, labels, hashes))
        cols = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)


def markup_trees(chunks: DataFrame) -> DataFrame:
    """``id, field, host, shape, parents, labels, hashes``: a tree for each chunk and field that holds markup, equal deliveries once.

    ``host`` is the first segment of ``filename`` ("" if null), ``shape`` stands for the tree without its texts.
    """
    rows = chunks.select(F.col("id").cast("string").alias("id"), F.coalesce(F.split("filename", "/")[0], F.lit("")).alias("host"), "heading", "content")
    trees = rows.mapInArrow(_parse, "id string, field string, host string, shape bigint, parents array<int>, labels array<string>, hashes array<bigint>")
    return trees.withColumn("texts", F.xxhash64("hashes")).dropDuplicates(["id", "field", "host", "shape", "texts"]).drop("texts")


_NONE: dict[int, int] = {}


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All shapes of a block against all of another, or of the same: for each of their nodes and its texts, how many pages have
    the aligned node and how many of them that text, by nearness of the pages' shape."""
    rings = len(NEAR) + 1
    names = ["host", "field", "shape", "node", "text", *(f"n{r}" for r in range(rings)), *(f"all{r}" for r in range(rings))]
    types = [pa.string(), pa.string(), pa.int64(), pa.int32(), *[pa.int64()] * (2 * rings + 1)]

    class Side:
        def __init__(self, rows: list[dict], known: dict[tuple, int], columns: dict[str, int]):
            self.rows, self.shapes = rows, [Shape(r["parents"], r["labels"], known) for r in rows]
            self.bags = np.zeros((len(rows), len(columns)), dtype=np.int64)
            self.texts, self.counts, self.all = [], [], []
            for bag, r in zip(self.bags, rows, strict=True):
                for label, n in Counter(r["labels"]).items():
                    bag[columns[label]] = n
                texts: dict[int, dict[int, int]] = {}
                for v in r["votes"]:
                    texts.setdefault(v["node"], {})[v["text"]] = v["n"]
                self.texts.append(texts)
                self.counts.append({})
                self.all.append({node: [0] * rings for node in texts})

        def add(self, i: int, node: int, ring: int, pages: int, theirs: dict[int, int]) -> None:
            mine = self.texts[i].get(node)
            if mine is None:
                return
            self.all[i][node][ring] += pages
            for text in mine if len(mine) <= len(theirs) else theirs:
                if text in mine and text in theirs:
                    self.counts[i].setdefault((node, text), [0] * rings)[ring] += theirs[text]

        def result(self, host: str, field: str) -> Iterator[tuple]:
            for r, texts, counts, everything in zip(self.rows, self.texts, self.counts, self.all, strict=True):
                for node, mine in texts.items():
                    whole = list(accumulate(everything[node]))
                    for text in mine:
                        yield host, field, r["shape"], node, text, *accumulate(counts.get((node, text), [0] * rings)), *whole

    for batch in batches:
        for at in range(batch.num_rows):
            r = batch.slice(at, 1).to_pylist()[0]
            same, known, columns = r["block"] == r["other"], {}, {}
            for s in r["mine"] + r["theirs"]:
                for label in s["labels"]:
                    columns.setdefault(label, len(columns))
            a = Side(r["mine"], known, columns)
            b = a if same else Side(r["theirs"], known, columns)
            sizes = b.bags.sum(axis=1)
            for i, x in enumerate(a.rows):
                common = 2 * np.minimum(a.bags[i], b.bags).sum(axis=1) / (sizes + len(x["labels"]))
                for j in range(i if same else 0, len(b.rows)):
                    y = b.rows[j]
                    if same and i == j:
                        for node, texts in a.texts[i].items():
                            a.add(i, node, 0, x["n"], texts)
                        continue
                    ring = 1 + next(k for k, least in enumerate(NEAR) if common[j] >= least)
                    # The lesser shape comes first, so that no pair's alignment depends on blocks.
                    pairs = match_shapes(a.shapes[i], b.shapes[j]) if x["shape"] < y["shape"] else [(u, v) for v, u in match_shapes(b.shapes[j], a.shapes[i])]
                    for u, v in pairs:
                        a.add(i, u, ring, y["n"], b.texts[j].get(v, _NONE))
                        b.add(j, v, ring, x["n"], a.texts[i].get(u, _NONE))
            rows = [*a.result(r["host"], r["field"]), *(() if same else b.result(r["host"], r["field"]))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _constant(trees: DataFrame) -> DataFrame:
    """``host, field, shape, node, text``: nodes of each shape with the text that enough pages have there.

    A text with the needed share of all votes on a node has it among the pages of at least one shape, so only texts that
    lead somewhere on the host are counted. All pairs of a host's shapes are aligned, in pairs of blocks of shapes.
    """
    place, by = ["host", "field"], ["host", "field", "shape"]
    shapes = trees.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.first("parents").alias("parents"), F.first("labels").alias("labels"))
    votes = trees.select(*by, F.posexplode("hashes").alias("node", "text")).where("node > 0").groupBy(*by, "node", "text").agg(F.count(F.lit(1)).alias("n"))
    votes = cut(votes)
    pages = votes.groupBy(*by, "node").agg(F.sum("n").alias("pages"), F.max_by("text", "n").alias("text"), F.max("n").alias("n"))
    leading = pages.where(F.col("n") >= CONSTANT_SHARE * F.col("pages")).select(*place, "text").distinct()
    votes = votes.join(leading, [*place, "text"], "left_semi").groupBy(*by).agg(F.collect_list(F.struct("node", "text", "n")).alias("votes"))
    shapes = cut(shapes.join(votes, by, "left").withColumn("votes", F.coalesce("votes", F.array())))
    blocks = shapes.groupBy(*place).agg(F.ceil(F.sum(F.size("labels") + F.size("votes")) / BLOCK_NODES).cast("int").alias("blocks"))
    packed = salted_join(shapes, blocks, place, "shape").withColumn("block", F.pmod(F.xxhash64("shape"), F.col("blocks")).cast("int"))
    packed = cut(packed.groupBy(*place, "block", "blocks").agg(F.collect_list(F.struct("shape", "n", "parents", "labels", "votes")).alias("mine")))
    one = packed.select(*place, "block", "mine", F.explode(F.expr("sequence(block, blocks - 1)")).alias("other"))
    two = packed.select(*place, F.col("block").alias("other"), F.col("mine").alias("theirs"))
    width = spread(packed, packed.agg(F.sum(F.col("blocks") - F.col("block"))).first()[0] or 0, PAIRS_PER_TASK)
    rings = range(len(NEAR) + 1)
    counts = ", ".join(f"n{r} bigint" for r in rings) + ", " + ", ".join(f"all{r} bigint" for r in rings)
    met = one.repartition(width, *place, "other").join(two.repartition(width, *place, "other"), [*place, "other"]).mapInArrow(_vote, f"host string, field string, shape bigint, node int, text bigint, {counts}")
    met = met.groupBy(*by, "node", "text").agg(*[F.sum(f"{c}{r}").alias(f"{c}{r}") for c in ("n", "all") for r in rings])
    enough = [(F.col(f"all{r}") >= MIN_SUPPORT) & (F.col(f"n{r}") >= CONSTANT_SHARE * F.col(f"all{r}")) for r in rings]
    return met.where(reduce(operator.or_, enough)).select(*by, "node", "text")


def wrapped(chunks: DataFrame) -> DataFrame:
    """Wrapper induction: ``id, field, labels, template`` for each chunk and field with markup; ``template`` lists the
    preorder indices of its nodes that are constant on the host, all other nodes being content slots.

    Pages of one shape are aligned as they stand, and each distinct shape by simple tree matching with every other shape of
    its host and field. On each node of a shape four votes are taken: of its own pages, and of those of all shapes within
    each share of ``NEAR``. A node is template if its text is the constant one in any of them. The number of alignments
    grows with the square of a host's distinct shapes. The join on hosts and shapes is salted ``SALTS`` times.
    """
    trees = cut(markup_trees(chunks))
    by = ["host", "field", "shape"]
    constant = _constant(trees).groupBy(*by).agg(F.collect_set(F.struct("node", "text")).alias("constant"))
    salted = constant.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    met = trees.withColumn("salt", (F.abs(F.xxhash64("id")) % SALTS).cast("int")).join(salted, [*by, "salt"], "left")
    nodes = F.transform("hashes", lambda h, i: F.struct(i.alias("node"), h.alias("text")))
    template = F.transform(F.filter(nodes, lambda n: F.coalesce(F.array_contains("constant", n), F.lit(False))), lambda n: n["node"])
    return met.select("id", "field", "labels", template.alias("template"))


def markup_nodes(chunks: DataFrame) -> DataFrame:
    """``id, field, markup, template_nodes, slot_nodes``: how much markup of each kind the aligned tree of a chunk's field
    holds in the host's template and in content slots. Null texts and texts without markup have no rows."""
    node = wrapped(chunks).select("id", "field", "template", F.posexplode("labels").alias("node", "label"))
    node = node.select("id", "field", F.substring_index("label", ":", 1).alias("markup"), F.array_contains("template", F.col("node")).alias("constant")).where(F.col("markup").isin(*KINDS))
    return node.groupBy("id", "field", "markup").agg(F.count_if("constant").alias("template_nodes"), F.count_if(~F.col("constant")).alias("slot_nodes"))


def markup_kinds(chunks: DataFrame) -> DataFrame:
    """``id, field, markup``: each kind of markup in the template nodes or content slots of a chunk's field. Null texts have none."""
    return markup_nodes(chunks).where(F.col("template_nodes") + F.col("slot_nodes") > 0).select("id", "field", "markup")


#: Headings and formulas stay, even where all pages of a host have the same.
_KEPT = frozenset(["wiki:heading", "markdown:heading", "markdown:underlined", "latex:formula", "latex:chapter", "latex:section", "latex:subsection", "latex:subsubsection", *(f"html:h{n}" for n in range(1, 7))])


def _dropped(root: Node, template: frozenset[int]) -> list[tuple[int, int]]:
    """Spans of the nodes that are template with all below them, in order; breaks and other nodes without text stay."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(node.children))
    number = {id(n): i for i, n in enumerate(order)}
    whole: dict[int, bool] = {}
    for i in range(len(order) - 1, -1, -1):
        node = order[i]
        kept = not (node.text or node.children) or node.label in _KEPT
        whole[i] = i in template and not kept and all(whole[number[id(c)]] for c in node.children)
    return sorted(order[i].span for i in range(1, len(order)) if whole[i])


_BLOCK = frozenset("address article aside blockquote body dd div dl dt fieldset figcaption figure footer form header html main nav ol p section table tbody tfoot thead tr ul".split())


def clean_text(text: str | None, template: frozenset[int] = frozenset(), heading: bool = False) -> str | None:
    """The text without markup; headings become ``#`` lines, list items ``- `` lines, formulas ``$...$``; code stays as it is.

    Template nodes and all below them are dropped. Entities are resolved, also where they were escaped more than once.
    """
    if text is None:
        return None
    tokens = scan(text, heading)
    if not tokens:
        return text
    drop = _dropped(tree(text, tokens), template) if template else []

    def kept(a: int, b: int) -> str:
        parts = []
        for x, y in drop:
            if y > a and x < b:
                parts.append(text[a : max(a, x)])
                a = max(a, min(y, b))
        return "".join(parts) + text[a:b]

    out, at = [], 0
    for start, end, kind, name, inner in tokens:
        if start < at:
            continue
        out.append(kept(at, start))
        at = end
        if any(a <= start and end <= b for a, b in drop):
            continue
        whole = text[start:end]
        if name == "&":
            plain = whole
            while (once := html.unescape(plain)) != plain:
                plain = once
            out.append(plain.replace("\xa0", " "))
        elif kind == "html":
            bare = name.lstrip("/")
            if re.fullmatch(r"h[1-6]", bare):
                out.append("\n" if name[0] == "/" else "\n" + "#" * int(bare[1]) + " ")
            elif name == "li":
                out.append("\n- ")
            elif name in ("td", "th"):
                out.append(" | ")
            elif bare in ("code", "tt", "kbd", "samp"):
                out.append("`")
            elif bare == "pre":
                out.append("\n```\n")
            elif bare in ("br", "hr") or bare in _BLOCK:
                out.append("\n")
        elif name == "formula":
            out.append(f"${inner}$")
        elif kind == "latex":
            if name == "item":
                out.append("- ")
            elif name in ("section", "subsection", "subsubsection", "chapter"):
                out.append("#" * {"chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3}[name] + f" {inner}")
            elif name in ("cite", "ref", "label", "pageref", "eqref") or ":" in name:
                pass
            else:
                out.append(clean_text(inner, heading=heading) or "")
        elif name == "heading":
            bare = whole.strip().strip("=#").strip()
            out.append((clean_text(bare, heading=True) or "") if heading else "#" * len(inner) + " " + (clean_text(bare, heading=True) or ""))
        elif name == "underlined":
            out.append(("# " if inner == "=" else "## ") + (clean_text(whole.split("\n")[0].strip(), heading=True) or ""))
        elif name == "table":
            for row in whole.split("\n")[1:]:
                cells = [c.strip() for c in re.split(r"\|\||!!", row.strip().lstrip("|!"))]
                if row.strip() not in ("|-", "|}") and any(cells):
                    out.append("| " + " | ".join(cells) + " |\n")
        elif name == "definition":
            pass
        else:
            out.append(clean_text(inner, heading=heading) or "")
    out.append(kept(at, len(text)))
    joined = "".join(out)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", joined)).strip() if joined != text else text


def cleaned_chunks(chunks: DataFrame) -> DataFrame:
    """``id, heading, content`` of every chunk (redelivered rows once) without markup and without template nodes."""
    marks = wrapped(chunks)
    fields = marks.groupBy("id").agg(*[F.max(F.when(F.col("field") == f, F.col("template"))).alias(f"t_{f}") for f in ("heading", "content")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[clean_text(t, frozenset(m), f == "heading") if m is not None else t for t, m in zip(b.column(f).to_pylist(), b.column(f"t_{f}").to_pylist(), strict=True)] for f in ("heading", "content")]
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, pa.string()) for c in cols)], ["id", "heading", "content"])

    rows = chunks.select(F.col("id").cast("string").alias("id"), "heading", "content").dropDuplicates(["id"])
    return rows.join(fields, "id", "left").mapInArrow(work, "id string, heading string, content string")
