"""Problem 3: splitting oversized items at natural boundaries by agglomerative merging of atomic segments."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS, OVERLAP = 500, 40
#: Boundary kinds, coarsest first. A stronger boundary is merged later.
PARAGRAPH, LINE, SENTENCE, WORD = range(4)
NAMES = ("paragraph", "line", "sentence", "word")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
#: The same runs as ``str.split`` gives.
_TOKEN = re.compile(r"\S+")


def line_spans(text: str) -> list[tuple[int, int]]:
    spans, start = [], 0
    while True:
        end = text.find("\n", start)
        if end < 0:
            spans.append((start, len(text)))
            return spans
        spans.append((start, end))
        start = end + 1


def units(text: str) -> list[tuple[int, int, int]]:
    """Sentences in order as ``(start, end, kind of the boundary before it)``; their spans hold no outer line ends.

    Blank lines end paragraphs, except inside a triple-backtick fence.
    """
    out: list[tuple[int, int, int]] = []
    fenced, pending = False, PARAGRAPH
    for start, end in line_spans(text):
        line = text[start:end]
        bare = line.strip()
        if not bare and not fenced:
            pending = PARAGRAPH
            continue
        if bare.startswith("```"):
            fenced = not fenced
        if not bare:
            continue
        at = start
        for m in _SENTENCE_END.finditer(line):
            if text[at : start + m.start()].strip():
                out.append((at, start + m.start(), pending))
                pending = SENTENCE
                at = start + m.end()
        if text[at:end].strip():
            out.append((at, end, pending))
        pending = LINE
    return out


def boundary_of(sizes: list[tuple[int, int]], fits: int) -> int:
    """The coarsest kind for which every unit has at most ``fits`` tokens. ``sizes``: (tokens, boundary before) of each sentence."""
    for kind in (PARAGRAPH, LINE, SENTENCE):
        run = most = 0
        for n, before in sizes:
            run = n if before <= kind else run + n
            most = max(most, run)
        if most <= fits:
            return kind
    return WORD


def merge(sizes: list[int], strengths: list[int], fits: int) -> list[tuple[int, int]]:
    """Merges neighbours, weakest boundary first, the smaller union first among equals, while a union has at most ``fits`` tokens.

    ``strengths[i]`` is the kind before segment i (0 = strongest). Gives ranges of segment indices.
    """
    n = len(sizes)
    nxt, prev, total, last = list(range(1, n + 1)), list(range(-1, n - 1)), list(sizes), list(range(n))
    alive = [True] * n
    heap = [(-strengths[i + 1], sizes[i] + sizes[i + 1], i, i + 1) for i in range(n - 1) if sizes[i] + sizes[i + 1] <= fits]
    heapq.heapify(heap)
    while heap:
        _, size, i, j = heapq.heappop(heap)
        if not (alive[i] and alive[j]) or nxt[i] != j or total[i] + total[j] != size:
            continue
        total[i], last[i], alive[j] = size, last[j], False
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if size + total[nxt[i]] <= fits:
                heapq.heappush(heap, (-strengths[nxt[i]], size + total[nxt[i]], i, nxt[i]))
        if prev[i] >= 0 and size + total[prev[i]] <= fits:
            heapq.heappush(heap, (-strengths[i], size + total[prev[i]], prev[i], i))
    out, i = [], 0
    while i < n:
        out.append((i, last[i]))
        i = nxt[i]
    return out


def split_text(text: str, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP) -> tuple[str, list[tuple[str, int, int, int]]]:
    """``(boundary, pieces)``; a piece is ``(text, tokens, start, own)``.

    Pieces are slices of the text: ``text[own:...]`` of each, joined, give the text again; before ``own`` lie the last
    ``overlap`` tokens of the piece before. A text within the limit is one piece.
    """
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    fits = max_tokens - overlap
    found = units(text)
    starts = [s for s, _ in tokens]
    sizes, at = [], 0
    for _, end, before in found:
        first = at
        while at < len(starts) and starts[at] < end:
            at += 1
        sizes.append((at - first, before))
    kind = boundary_of(sizes, fits)
    if len(tokens) <= max_tokens:
        return NAMES[kind], [(text, len(tokens), 0, 0)]
    seg_tokens: list[int] = []
    strengths: list[int] = []
    for n, before in sizes:
        if n <= fits:
            seg_tokens.append(n)
            strengths.append(before)
        else:  # a sentence over the limit falls into words
            seg_tokens.extend([1] * n)
            strengths.extend([before] + [WORD] * (n - 1))
    ranges = merge(seg_tokens, strengths, fits)
    firsts, acc = [], 0
    for n in seg_tokens:
        firsts.append(acc)
        acc += n
    pieces = []
    for k, (a, b) in enumerate(ranges):
        first = firsts[a]
        stop = firsts[b] + seg_tokens[b]
        own = 0 if k == 0 else starts[first]
        begin = 0 if k == 0 else starts[max(0, first - overlap)]
        end = len(text) if k == len(ranges) - 1 else starts[stop]
        pieces.append((text[begin:end], stop - max(0, first - (overlap if k else 0)), begin, own))
    return NAMES[kind], pieces


_DDL = "id string, chunk_type string, boundary string, n_pieces int, piece int, tokens int, start int, own int, content string"


def split_oversized(chunks: DataFrame, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Pieces of every chunk of more than ``max_tokens`` tokens, whatever its stored ``token_count`` or type.

    ``id, chunk_type, boundary, n_pieces, piece (from 1), tokens, start, own, content``: ``start`` and ``own`` are
    offsets in characters of the piece and of its part that repeats nothing. Every piece has at most ``max_tokens``
    tokens and, but for the first, begins with the last ``overlap`` tokens of the one before. Cuts fall at the
    strongest boundaries. Null and short contents give no rows; redelivered rows are split once (equal rows of id,
    type and content). ``with_text=False`` leaves ``content`` null.
    """
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be less than max_tokens")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "chunk_type", "boundary", "n_pieces", "piece", "tokens", "start", "own", "content"]
        types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
        for b in batches:
            rows = []
            for i, kind, text in zip(*(b.column(c).to_pylist() for c in ("id", "chunk_type", "content")), strict=True):
                if len(text.split()) <= max_tokens:
                    continue
                boundary, pieces = split_text(text, max_tokens, overlap)
                for k, (piece, n, start, own) in enumerate(pieces):
                    rows.append((i, kind, boundary, len(pieces), k + 1, n, start, own, piece if with_text else None))
            cols = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

    long = chunks.select(F.col("id").cast("string").alias("id"), "chunk_type", "content").where(F.length("content") > 2 * max_tokens)
    return long.dropDuplicates(["id", "chunk_type", "content"]).mapInArrow(work, _DDL)


def oversized_boundaries(chunks: DataFrame) -> DataFrame:
    """``id, boundary`` of every oversized chunk, from its pieces."""
    return split_oversized(chunks, with_text=False).where("piece = 1").select("id", "boundary").distinct()
