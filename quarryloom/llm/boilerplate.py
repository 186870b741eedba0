"""Problem 4: page furniture mixed with main text. Parser events give each line's text-to-tag ratio; Gaussian smoothing
and threshold clustering select content regions; what lies outside them is furniture, but for marked-up structure.

No word of any language is written down here. Sentences that belong to furniture, as in consent notices, weigh less as
text the more their words are those of sentences that stand among menus and buttons elsewhere in the corpus.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from operator import mul

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Deviation of the Gaussian, in lines of a block.
SIGMA = 0.6
#: An unfinished line of at most so many words reads as a title or button: this share of it counts as text.
TITLE_WORDS, TITLE_SHARE = 12, 0.3
#: Tags that a separator or symbol weighs.
SIGN_TAGS = 2
#: Most words of an item in a side list.
LISTED_WORDS = 8
#: Slots of the word statistics, and steps of the histogram of levels: fixed bounds of what the driver receives.
SLOTS, STEPS = 1 << 18, 128
#: Most that one word or pair of words says for or against furniture, in nats; sentences that each is thought to be in besides, in proportion to the two kinds.
CLIP, UNSEEN = 3.0, 1.0
_TOP = math.log1p(5000)

#: Signs that separate the links of a menu or mark a control.
_SIGNS = re.compile(r"\s[|·•/›»>–—]\s|[›»«‹▾▼★☆©®]|&copy;|\s{2,}\S|\t")
_BULLET = re.compile(r"^(?:[-*+•]\s+)(.*)$", re.S)
_LINK = re.compile(r"!?\[[^\[\]]*\]\([^()]*\)")
_MARKUP_LINE = re.compile(r"^(?:[|{}\\$\[<#=!>]|-{2,}|={2,}|\d+[.)]\s|```|~~~|:::|\*\*|''|__)")
_UNDERLINE = re.compile(r"^[ \t]*(?:-{2,}|={2,})[ \t]*\r?$")
_FINISHED = re.compile(r"(?<![.…])[.!?。！？]\W*$|[.!?;]\s+\S+\s+\S+\s+\S|[,;)\]}]\W*$")
_SENTENCE = re.compile(r"(?<![.…])[.!?。！？]\W*$")
_TOKEN = re.compile(r"[^\W\d_]+")
_INLINE = re.compile(r"[`*{}\\$=<>]|\]\(")
_NAV_TAGS = frozenset("nav header footer aside menu form button select option".split())


class LineEvents(HTMLParser):
    """Counts tags and text characters per line from the standard parser's stream of events, and marks lines inside navigation elements."""

    def __init__(self, lines: int):
        super().__init__(convert_charrefs=False)
        self.tags, self.text, self.links, self.nav = [0] * lines, [0] * lines, [0] * lines, [False] * lines
        self.depth = self.anchors = 0

    def _line(self) -> int:
        return min(self.getpos()[0] - 1, len(self.tags) - 1)

    def handle_starttag(self, tag, attrs):
        n = self._line()
        self.tags[n] += 1
        if tag in _NAV_TAGS:
            self.depth += 1
        self.anchors += tag == "a"
        self.nav[n] |= self.depth > 0

    def handle_startendtag(self, tag, attrs):
        self.tags[self._line()] += 1

    def handle_endtag(self, tag):
        n = self._line()
        self.tags[n] += 1
        self.nav[n] |= self.depth > 0
        if tag in _NAV_TAGS and self.depth:
            self.depth -= 1
        if tag == "a" and self.anchors:
            self.anchors -= 1

    def handle_data(self, data):
        n = self._line()
        for k, part in enumerate(data.split("\n")):
            at = min(n + k, len(self.text) - 1)
            (self.links if self.anchors else self.text)[at] += len(part.strip())
            self.nav[at] |= self.depth > 0

    def handle_entityref(self, name):
        self.text[self._line()] += 1

    handle_charref = handle_entityref


def _kernel(sigma: float) -> list[float]:
    radius = math.ceil(2 * sigma)
    raw = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-radius, radius + 1)]
    return [x / sum(raw) for x in raw]


_KERNEL = _kernel(SIGMA)


def smooth(values: list[float]) -> list[float]:
    """Gaussian means of a block's lines; beyond its ends the outer lines go on."""
    n, r = len(values), len(_KERNEL) // 2
    if n == 1:
        return values
    padded = [values[0]] * r + values + [values[-1]] * r
    return [sum(map(mul, _KERNEL, padded[i : i + 2 * r + 1])) for i in range(n)]


def threshold(others: np.ndarray, sentences: np.ndarray) -> float:
    """The border between two clusters of levels, from histograms over 0 to ``_TOP`` of sentences and of other lines.

    Lloyd's iteration over both together, from their means. Without other lines nothing lies below the border, without
    sentences everything does.
    """
    if not others.sum() or not sentences.sum():
        return _TOP if others.sum() else 0.0
    centres = (np.arange(len(others)) + 0.5) * _TOP / len(others)
    both = others + sentences
    low, high = (others * centres).sum() / others.sum(), (sentences * centres).sum() / sentences.sum()
    for _ in range(100):
        below = centres <= (low + high) / 2
        a, b = both[below].sum(), both[~below].sum()
        if not a or not b:
            break
        new = (both * centres)[below].sum() / a, (both * centres)[~below].sum() / b
        if abs(new[0] - low) + abs(new[1] - high) < 1e-6:
            break
        low, high = new
    return float((low + high) / 2)


def code_lines(lines: list[str]) -> list[bool]:
    """Lines of fences (with their delimiters) and of CSV blocks below a ``<!-- Data Table -->`` marker up to a blank line."""
    out, fenced, table = [], False, False
    for line in lines:
        bare = line.strip()
        if bare.startswith("```"):
            out.append(True)
            fenced = not fenced
            continue
        if not fenced:
            table = bare.startswith("<!-- Data Table -->") or (table and bool(bare))
        out.append(fenced or table)
    return out


@dataclass(slots=True)
class Line:
    """One non-blank line outside of code: ``level`` is the logarithm of its text-to-tag ratio."""

    no: int
    text: str
    level: float
    nav: bool = False
    bare_links: bool = False
    fixed: bool = False
    bullet: bool = False
    words: int = 0
    sentence: bool = False


def blocks(text: str) -> Iterator[list[Line]]:
    """The lines of a chunk by runs without blank lines. Text within links counts as tags; so do signs between links.
    ``fixed`` lines are marked-up structure: tables, headings, formulas, numbered lists."""
    lines = text.split("\n")
    events = None
    if "<" in text or "&" in text:
        events = LineEvents(len(lines))
        try:
            events.feed(text)
            events.close()
        except (AssertionError, ValueError):  # the standard parser gives up on some declarations
            pass
    block: list[Line] = []
    for i, (raw, is_code) in enumerate(zip(lines, code_lines(lines), strict=True)):
        line = raw.strip()
        if not line or is_code:
            if block:
                yield block
                block = []
            continue
        bullet = _BULLET.match(line)
        body = bullet.group(1).strip() if bullet else line
        tags = chars = links = 0
        if events is not None and "<" in line:
            tags, chars, links = events.tags[i], events.text[i], events.links[i]
        elif "](" in body:
            rest = _LINK.sub("", body)
            tags = 2 * body.count("](")
            chars = len(re.sub(r"[\s|·›/,]+", " ", rest).strip())
            links = len(body) - len(rest)
        else:
            chars = len(body)
        bare = links > 0 and chars == 0 and not body.startswith("!")
        words = len(body.split())
        share = 1.0 if _FINISHED.search(body) or words > TITLE_WORDS else TITLE_SHARE
        ratio = share * chars / (max(tags, 1) + SIGN_TAGS * len(_SIGNS.findall(line)))
        fixed = not bare and bool(_MARKUP_LINE.match(line) or _UNDERLINE.match(lines[i + 1] if i + 1 < len(lines) else ""))
        block.append(Line(i + 1, body, min(math.log1p(ratio), _TOP), events is not None and events.nav[i], bare, fixed, bool(bullet), words, bool(_SENTENCE.search(body))))
    if block:
        yield block


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh32_intdigest(word)
        return value


_HASHES = _WordHash()


def _slots(line: str) -> list[int]:
    """The slots of a line's words and pairs of neighbouring words."""
    ids = [_HASHES[w] for w in _TOKEN.findall(line.casefold())]
    return list({*(h % SLOTS for h in ids), *((a * 31 + b) % SLOTS for a, b in zip(ids, ids[1:], strict=False))})


def _tally(batches: Iterator[pa.RecordBatch], count) -> Iterator[pa.RecordBatch]:
    """Sums what ``count(block, totals)`` adds for every block of a task: ``slot, low, high`` of the slots met."""
    totals = np.zeros((2, SLOTS), np.int64)
    for b in batches:
        for text in b.column(0).to_pylist():
            for block in blocks(text):
                count(block, totals)
    at = np.flatnonzero(totals.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(totals[0][at]), pa.array(totals[1][at])], ["slot", "low", "high"])


def _totals(texts: DataFrame, count) -> np.ndarray:
    rows = texts.mapInArrow(lambda it: _tally(it, count), "slot int, low bigint, high bigint").groupBy("slot").agg(F.sum("low"), F.sum("high")).collect()
    out = np.zeros((2, SLOTS), np.int64)
    for slot, low, high in rows:
        out[:, slot] = low, high
    return out


def _plain(line: Line) -> bool:
    return not (line.nav or line.bare_links or line.fixed or line.bullet)


def _count_levels(block: list[Line], totals: np.ndarray) -> None:
    for line, level in zip(block, smooth([x.level for x in block]), strict=True):
        if _plain(line):
            totals[int(line.sentence), min(int(level / _TOP * STEPS), STEPS - 1)] += 1


@dataclass(frozen=True)
class Model:
    """``border`` between the levels of furniture and of text; ``odds``: what each slot says for furniture, in nats."""

    border: float
    prior: float
    odds: array

    def text_share(self, line: str) -> float:
        """How much of a sentence counts as text, by its words."""
        return 1 / (1 + math.exp(min(self.prior + sum(map(self.odds.__getitem__, _slots(line))), 50.0)))


def learn(chunks: DataFrame) -> Model:
    """Border and word statistics from all chunks, in two passes of which only sums of fixed size reach the driver.

    The first clusters the levels of all lines. The second tells apart sentences in blocks whose mean level is that of
    furniture, and sentences in blocks of text, and counts their words and pairs of words.
    """
    texts = chunks.where(F.col("content").isNotNull()).select("content")
    border = threshold(*_totals(texts, _count_levels)[:, :STEPS])

    def count_words(block: list[Line], totals: np.ndarray) -> None:
        level = sum(x.level for x in block) / len(block)
        for line in block:
            if _plain(line) and line.sentence:
                side = 0 if level <= border else 1
                totals[side, SLOTS - 1] += 1
                totals[side, _slots(line.text)] += 1

    low, high = _totals(texts, count_words)
    sentences = max(int(low[-1]), 1), max(int(high[-1]), 1)
    part = UNSEEN / sum(sentences)
    odds = np.log(low / sentences[0] + part) - np.log(high / sentences[1] + part)
    return Model(border, math.log(sentences[0] / sentences[1]), array("f", np.clip(odds, -CLIP, CLIP).astype(np.float32).tolist()))


def furniture_lines(text: str | None, model: Model) -> list[int]:
    """Numbers (from 1) of the non-blank lines that are furniture: those outside of content regions, after a check of structure.

    Lines within navigation elements and lines of nothing but links are outside at any level. Fixed structure is kept.
    A sentence that its own words make text isn't drawn out of its region by the lines beside it.
    Bulleted lines are furniture only as short items of a list right below a furniture line.
    """
    if not text or text.isspace():
        return []
    out = []
    for block in blocks(text):
        levels = []
        for line in block:
            level = line.level
            if _plain(line) and line.sentence:
                level = math.log1p(math.expm1(level) * model.text_share(line.text))
            levels.append(level)
        in_list = False
        for line, level, own in zip(block, smooth(levels), levels, strict=True):
            if line.nav or line.bare_links:
                out.append(line.no)
                in_list = in_list and not line.nav
            elif line.fixed or (max if line.sentence else min)(level, own) > model.border:  # a content region
                in_list = False
            elif line.bullet:
                in_list = in_list and line.words <= LISTED_WORDS and not _FINISHED.search(line.text)
                if in_list:
                    out.append(line.no)
            elif max(level, own) > model.border and _INLINE.search(line.text):
                in_list = False
            else:
                out.append(line.no)
                in_list = True
    return out


def _lines(held):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, numbers = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = furniture_lines(t, held.value)
                ids.extend([i] * len(found))
                numbers.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(numbers, pa.int32())], ["id", "line_no"])

    return work


def furniture(chunks: DataFrame) -> DataFrame:
    """``id, line_no`` of site furniture in ``content``, lines split at line feeds and counted from 1. Null and blank contents have none; redelivered rows count once."""
    held = chunks.sparkSession.sparkContext.broadcast(learn(chunks))
    return chunks.select(F.col("id").cast("string"), "content").mapInArrow(_lines(held), "id string, line_no int").distinct()


def main_text(chunks: DataFrame) -> DataFrame:
    """``id, filename, content, removed``: every chunk without its furniture lines, and how many they were."""
    held = chunks.sparkSession.sparkContext.broadcast(learn(chunks))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t in b.column("content").to_pylist():
                drop = set(furniture_lines(t, held.value))
                kept = t if not drop else re.sub(r"\n{3,}", "\n\n", "\n".join(x for n, x in enumerate(t.split("\n"), 1) if n not in drop)).strip("\n")
                texts.append(kept)
                counts.append(len(drop))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("filename"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], ["id", "filename", "content", "removed"])

    rows = chunks.select(F.col("id").cast("string").alias("id"), F.col("filename").cast("string").alias("filename"), "content").dropDuplicates(["id"])
    return rows.mapInArrow(work, "id string, filename string, content string, removed int")
