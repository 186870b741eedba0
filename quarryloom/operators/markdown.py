"""Markdown cleaning: line-wise steps that need the fence state, run as one Arrow UDF over whole documents."""

from __future__ import annotations

import csv
import html
import io
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryloom.operators.code import annotate_fences

_ATX = re.compile(r"^(#{1,6})\s+(.*?)\s*$")
_FRONT = re.compile(r"\A\s*---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\Z)", re.S)


def fence_lines(lines: list[str]) -> list[bool]:
    """Whether each line belongs to a backtick or tilde fence; a fence ends only at a delimiter of its own kind."""
    out, mark = [], ""
    for line in lines:
        bare = line.strip()
        m = re.match(r"(`{3,}|~{3,})", bare)
        if mark:
            out.append(True)
            if m and bare.startswith(mark) and not bare[len(m.group(1)) :].strip():
                mark = ""
        elif m:
            mark = m.group(1)[:3]
            out.append(True)
        else:
            out.append(False)
    return out


def front_matter(text: str) -> tuple[dict[str, str], str]:
    """Flat ``key: value`` front matter and the rest of the text; quotes around values go, lines without a colon are skipped."""
    m = _FRONT.match(text)
    if not m:
        return {}, text
    meta = {}
    for line in m.group(1).splitlines():
        key, colon, value = line.partition(":")
        if colon and key.strip():
            meta[key.strip()] = value.strip().strip("\"'")
    return meta, text[m.end() :]


def front_matter_block(meta: dict[str, str | None], order: tuple[str, ...] = ("title", "author", "category", "description", "tags", "date")) -> str:
    return "---\n" + "".join(f"{k}: {meta.get(k) or ''}\n" for k in order) + "---\n"


def drop_before_h1(text: str) -> str:
    """Keeps front matter and everything from the first H1 outside fences; a text without one stays."""
    m = _FRONT.match(text)
    head, body = (text[: m.end()], text[m.end() :]) if m else ("", text)
    lines = body.split("\n")
    fenced = fence_lines(lines)
    for i, line in enumerate(lines):
        if not fenced[i] and line.startswith("# "):
            return head + "\n".join(lines[i:])
    return text


#: Headings of page furniture whose sections go.
FURNITURE_HEADINGS = (r"^####[ \t]*On this page", r"^#####[ \t]*Search")


def drop_furniture_sections(text: str, patterns: tuple[str, ...] = FURNITURE_HEADINGS) -> str:
    """Deletes the sections of such headings up to the next heading line, and empty ``# comment:`` lines."""
    out, skipping = [], False
    for line in text.split("\n"):
        if any(re.match(p, line) for p in patterns):
            skipping = True
            continue
        if skipping and line.startswith("#"):
            skipping = False
        if not skipping and not re.fullmatch(r"#\s*comment:\s*", line):
            out.append(line)
    return "\n".join(out)


def sections_of(text: str, fence_aware: bool = True) -> list[tuple[str, int, str]]:
    """``(heading, level, body)`` in order, text before the first heading as level 0 with an empty heading."""
    lines = text.split("\n")
    fenced = fence_lines(lines) if fence_aware else [False] * len(lines)
    out: list[tuple[str, int, list[str]]] = [("", 0, [])]
    for line, f in zip(lines, fenced, strict=True):
        m = None if f else _ATX.match(line)
        if m:
            out.append((m.group(2), len(m.group(1)), []))
        else:
            out[-1][2].append(line)
    return [(h, n, "\n".join(b)) for h, n, b in out]


def _rebuild(sections: list[tuple[str, int, str]]) -> str:
    parts = []
    for h, n, b in sections:
        if n:
            parts.append("#" * n + " " + h + ("\n" + b if b else ""))
        elif b:
            parts.append(b)
    return "\n".join(parts)


def blank_short_sections(text: str, min_chars: int = 30, fence_aware: bool = False) -> str:
    return _rebuild([(h, n, b if not n or len(b.strip()) >= min_chars else "") for h, n, b in sections_of(text, fence_aware)])


def drop_short_sections(text: str, min_words: int) -> str:
    """Heading and body go where the body has fewer words."""
    return _rebuild([s for s in sections_of(text) if not s[1] or len(s[2].split()) >= min_words])


def fill_empty_h1(text: str) -> str:
    """The first H1, where nothing but blank lines stands before the next H2, gets a sentence and a bullet for each later H2."""
    lines = text.split("\n")
    titles = [re.match(r"(#{1,2})[ \t]+(\S.*)$", x) for x in lines]
    top = next((i for i, m in enumerate(titles) if m and m.group(1) == "#"), None)
    if top is None:
        return text
    below = [i for i in range(top + 1, len(lines)) if titles[i] and titles[i].group(1) == "##"]
    if not below or any(x.strip() for x in lines[top + 1 : below[0]]):
        return text
    bullets = [f"- {titles[i].group(2).strip()}" for i in below]
    return "\n".join([*lines[: top + 1], "", f"For information about {titles[top].group(2).strip()}, see the following:", "", *bullets, "", "", *lines[top + 1 :]])


def ensure_h1(text: str) -> str:
    """A document that starts without heading gets the front matter's title as H1; without a title it stays."""
    meta, body = front_matter(text)
    first = next((x for x in body.split("\n") if x.strip()), "")
    if first.startswith("#") or not meta.get("title"):
        return text
    return text[: len(text) - len(body)] + f"# {meta['title']}\n\n" + body.lstrip("\n")


def strip_heading_numbers(text: str) -> str:
    lines = text.split("\n")
    fenced = fence_lines(lines)
    return "\n".join(x if f else re.sub(r"^(#{1,6})\s+\d+(?:\.\d+)*\.?\s+(?=\S)", r"\1 ", x) for x, f in zip(lines, fenced, strict=True))


def strip_line_numbers(text: str, everywhere: bool = False) -> str:
    """One to three digits that number a code line; outside fences only with ``everywhere``, as that also hits ordered lists."""
    lines = text.split("\n")
    fenced = [True] * len(lines) if everywhere else fence_lines(lines)
    return "\n".join(re.sub(r"^\d{1,3}(?!\d)", "", x) if f else x for x, f in zip(lines, fenced, strict=True))


def load_rules(csv_text: str) -> list[tuple[str, str, str]]:
    """``(pattern, replacement, flags)`` by priority from ``pattern,replacement,flags,priority,comment`` lines; lines that name no replacement are skipped."""
    rows = []
    for i, row in enumerate(csv.reader(io.StringIO(csv_text))):
        if i == 0 or len(row) < 2 or not row[0]:
            continue
        flags = "".join(f for f in (row[2] if len(row) > 2 else "").upper() if f in "IMS") if len(row) > 2 and re.fullmatch(r"[IMS| ]*", row[2].upper()) else ""
        priority = int(row[3]) if len(row) > 3 and row[3].strip().isdigit() else 1_000_000
        rows.append((priority, i, row[0], row[1], flags))
    return [(p, r, f) for _, _, p, r, f in sorted(rows)]


def apply_rules(column: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Rules as one projection of nested replacements in the JVM; back references are written ``\\1`` or ``$1``."""
    for pattern, replacement, flags in rules:
        prefix = f"(?{flags.lower()})" if flags else ""
        column = F.regexp_replace(column, prefix + pattern, re.sub(r"\\(\d)", r"$\1", replacement))
    return column


def deindent_lists(text: str) -> str:
    """Entities resolved, LF line ends, and no indent before top-level bullets or numbers that follow a blank line."""
    text = html.unescape(text.replace("\r\n", "\n").replace("\r", "\n"))
    return re.sub(r"(?m)(^|\n\n)[ \t]{1,3}([*+\-]|\d+\.)(?=\s)", r"\1\2", text)


def blank_after_headings(text: str) -> str:
    """A blank line between a heading and a paragraph, and a line end after a heading that ends the text; before headings and fences none."""
    lines = text.split("\n")
    fenced = fence_lines(lines)
    out = []
    for i, line in enumerate(lines):
        out.append(line)
        if not fenced[i] and re.match(r"#{1,6}[ \t]+\S", line):
            follows = lines[i + 1] if i + 1 < len(lines) else None
            if follows is None or (follows.strip() and not follows.lstrip().startswith("#") and not follows.startswith("```")):
                out.append("")
    return "\n".join(out)


def unwrap_comments(text: str) -> str:
    """Runs of ``//`` comment lines become one; ``///`` lines stay."""
    out: list[str] = []
    joined = False
    for line in text.split("\n"):
        m = re.match(r"^(\s*)//(?!/)\s?(.*)$", line)
        if m and joined:
            out[-1] = out[-1].rstrip() + " " + m.group(2).strip()
        else:
            out.append(line)
        joined = bool(m)
    return "\n".join(out)


CLEANING: tuple[Callable[[str], str], ...] = (
    drop_before_h1, drop_furniture_sections, blank_short_sections, fill_empty_h1, ensure_h1, strip_heading_numbers, annotate_fences, strip_line_numbers, deindent_lists)


def text_udf(*steps: Callable[[str], str]) -> Callable[[Column], Column]:
    """An Arrow UDF that applies the steps in order; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            for step in steps:
                s = s.map(step, na_action="ignore")
            yield s

    return run


def clean_documents(docs: DataFrame, column: str = "text", rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """The whole cleaning chain over a text column; rules run in the JVM after it."""
    out = docs.withColumn(column, text_udf(*CLEANING)(F.col(column)))
    return out.withColumn(column, apply_rules(F.col(column), rules)) if rules else out


def merge_metadata(base: dict[str, str | None], page: dict[str, str]) -> dict[str, str]:
    """Page front matter over catalogue metadata: titles are joined, the description replaced, other keys become ``k=v`` tags, each once in order. Tags are separated by commas, bars or semicolons; values lose their commas."""
    out = {k: (v or "") for k, v in base.items()}
    title = page.get("title", "")
    if title and title not in out.get("title", "").split(" - "):
        out["title"] = f"{out['title']} - {title}" if out.get("title") else title
    if page.get("description"):
        out["description"] = page["description"]
    kept = re.split(r"[,|;]", out.get("tags", "")) if out.get("tags", "").strip() != "[]" else []
    tags = [t.strip() for t in kept if t.strip()] + [f"{k}={v.replace(',', ' ').strip()}" for k, v in page.items() if k not in ("title", "description") and v]
    out["tags"] = ", ".join(dict.fromkeys(tags))
    return out
