"""Tables in Markdown and HTML: converters, spans, parsers, token-limited splits and reports."""

from __future__ import annotations

import csv
import io
import math
import re
from html.parser import HTMLParser

from quarryloom.operators.markdown import fence_lines

MARKER = "<!-- Data Table -->"


def to_csv(rows: list[list[str]]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue().rstrip("\n")


class _Cells(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.caption, self.cell, self.in_caption = [], "", None, False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell = []
        elif tag == "caption":
            self.in_caption = True
        elif self.cell is not None:
            self.cell.append(self.get_starttag_text() if tag != "br" else " ")

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "caption":
            self.in_caption = False
        elif self.cell is not None:
            self.cell.append(f"</{tag}>")

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)
        elif self.in_caption:
            self.caption += data


def html_table(table: str) -> str:
    """One HTML table as a marked CSV block with its caption; rows are padded to one width. A table without cells stays."""
    p = _Cells()
    p.feed(table)
    p.close()
    rows = [r for r in p.rows if r]
    if not rows:
        return table
    width = max(map(len, rows))
    caption = " ".join(p.caption.split())
    return "\n".join([MARKER, *([f"Table: {caption}"] if caption else []), to_csv([r + [""] * (width - len(r)) for r in rows])])


def html_tables_to_csv(text: str) -> str:
    return re.sub(r"<table\b.*?</table\s*>", lambda m: html_table(m.group()), text, flags=re.I | re.S)


def split_row(line: str) -> list[str]:
    """Cells of a pipe row; ``\\|`` is a pipe in a cell."""
    cells = [c.replace("\0", "|").strip() for c in line.strip().replace("\\|", "\0").strip("|").split("|")]
    return cells


_SEPARATOR = re.compile(r"^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$")


def _pipe(line: str) -> bool:
    """A row of a pipe table; the first and last line of a wiki table are none."""
    return line.count("|") - line.count("\\|") >= 1 and not line.strip().startswith(("{|", "|}"))


def table_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` character spans outside fences: pipe tables (a separator in row two) and, below a marker, CSV rows of one width (two at least)."""
    lines = text.split("\n")
    fenced = fence_lines(lines)
    starts = [0]
    for x in lines:
        starts.append(starts[-1] + len(x) + 1)
    out, i = [], 0
    while i < len(lines):
        if not fenced[i] and _pipe(lines[i]) and i + 1 < len(lines) and not fenced[i + 1] and _SEPARATOR.match(lines[i + 1]) and "|" in lines[i + 1]:
            j = i + 2
            while j < len(lines) and not fenced[j] and _pipe(lines[j]):
                j += 1
            out.append((starts[i], starts[j] - 1, "pipe"))
            i = j
        elif not fenced[i] and lines[i].strip() == MARKER:
            j = i + 1
            while j < len(lines) and (not lines[j].strip() or lines[j].startswith("Table:")):
                j += 1
            first = j
            width = len(next(csv.reader([lines[j]]), [])) if j < len(lines) else 0
            while j < len(lines) and lines[j].strip() and not fenced[j] and len(next(csv.reader([lines[j]]), [])) == width:
                j += 1
            if width >= 2 and j - first >= 2:
                out.append((starts[i], starts[j] - 1, "csv"))
            i = max(j, i + 1)
        else:
            i += 1
    return out


def parse_table(text: str) -> list[list[str]]:
    """Cells of a pipe or CSV table, without marker, caption and separator."""
    body = [x for x in text.split("\n") if x.strip() and x.strip() != MARKER and not x.startswith("Table:")]
    if body and all(_pipe(x) for x in body):
        return [split_row(x) for x in body if not _SEPARATOR.match(x)]
    return [r for r in csv.reader(body) if r]


def pipe_tables_to_csv(text: str) -> str:
    """Pipe tables as marked CSV blocks; missing headers are named ``Column i``."""
    for start, end, kind in reversed(table_spans(text)):
        if kind == "pipe":
            rows = parse_table(text[start:end])
            width = max(map(len, rows))
            head = [c or f"Column {i}" for i, c in enumerate(rows[0] + [""] * (width - len(rows[0])), 1)]
            text = text[:start] + MARKER + "\n" + to_csv([head, *(r + [""] * (width - len(r)) for r in rows[1:])]) + text[end:]
    return text


def decorate(heading: str, table: str) -> str:
    """A caption that names the heading, the first and the last row and their number."""
    rows = parse_table(table)[1:]
    if not rows:
        return table
    body = "\n".join(x for x in table.split("\n") if x.strip() != MARKER and not x.startswith("Table:"))
    return f"{MARKER}\nTable: {heading} (from {rows[0][0]} to {rows[-1][0]}: {len(rows)} rows)\n{body}"


def row_tokens(rows: list[list[str]]) -> list[int]:
    return [len(to_csv([r]).split()) for r in rows]


def split_rows(header: list[str], rows: list[list[str]], limit: int) -> list[tuple[list[list[str]], int, bool]]:
    """Greedy parts of at most ``limit`` tokens that each repeat the header: ``(rows, tokens, overflow)``; one row beyond the limit is a part of its own."""
    head, out = len(to_csv([header]).split()), []
    part, used = [], head
    for row, n in zip(rows, row_tokens(rows), strict=True):
        if part and used + n > limit:
            out.append((part, used, used > limit))
            part, used = [], head
        part.append(row)
        used += n
    if part:
        out.append((part, used, used > limit))
    return out


def split_balanced(header: list[str], rows: list[list[str]], limit: int) -> list[tuple[list[list[str]], int, bool]] | None:
    """Two parts within the limit whose tokens differ least (the first of equals); None if there are none."""
    head, sizes = len(to_csv([header]).split()), row_tokens(rows)
    best, left = None, 0
    for k in range(1, len(rows)):
        left += sizes[k - 1]
        a, b = head + left, head + sum(sizes) - left
        if max(a, b) <= limit and (best is None or abs(a - b) < best[0]):
            best = (abs(a - b), k, a, b)
    return best and [(rows[: best[1]], best[2], False), (rows[best[1] :], best[3], False)]


def split_marked_tables(text: str, limit: int = 490, large: int = 900) -> tuple[str, list[tuple[int, int, int, bool]]]:
    """Marked CSV tables above ``limit`` tokens split, below ``large`` into two balanced parts if possible: the text and ``(table, part, tokens, overflow)``."""
    stats, spans = [], [s for s in table_spans(text) if s[2] == "csv"]
    for t, (start, end, _) in reversed(list(enumerate(spans, 1))):
        rows = parse_table(text[start:end])
        total = sum(row_tokens(rows))
        if total <= limit:
            continue
        parts = split_balanced(rows[0], rows[1:], limit) if total < large else None
        parts = parts or split_rows(rows[0], rows[1:], limit if total >= large else math.ceil(total * 0.5))
        stats = [(t, k, n, o) for k, (_, n, o) in enumerate(parts, 1)] + stats
        text = text[:start] + "\n\n".join(MARKER + "\n" + to_csv([rows[0], *p]) for p, _, _ in parts) + text[end:]
    return text, stats


def move_error_tables(text: str, pattern: str = r"error returned") -> str:
    """Tables whose header names returned errors move to the end of their section."""
    for start, end, _ in reversed(table_spans(text)):
        head = " ".join(" ".join(parse_table(text[start:end])[:1][0]).replace("\\_", "_").split()) if parse_table(text[start:end]) else ""
        if not re.search(pattern, head, re.I):
            continue
        above = [m for m in re.finditer(r"^(#{1,6})\s", text[:start], re.M)]
        level = len(above[-1].group(1)) if above else 0
        after = re.compile(rf"^#{{1,{level or 6}}}\s", re.M).search(text, end)
        stop = after.start() if after else len(text)
        rest = text[end:stop].strip("\n")
        if rest:
            text = text[:start] + rest + "\n\n" + text[start:end] + "\n" + ("\n" if after else "") + text[stop:]
    return text
