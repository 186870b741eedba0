"""Documents to heading blocks, chunks of bounded size, and section reports."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryloom.operators.code import code_spans, detect_language, split_code
from quarryloom.operators.markdown import fence_lines, front_matter
from quarryloom.operators.tables import decorate, table_spans

_COLUMN0 = re.compile(r"^(#{1,6})\s+(.+?)\s*#*\s*$")
_INDENTED = re.compile(r"^\s{0,3}(#{1,6})\s+(.+?)\s*$")


def heading_blocks(text: str) -> list[tuple[str, int, str]]:
    """``(heading, level, content)`` after the front matter; fences keep their headings, text before the first heading goes."""
    lines = front_matter(text)[1].split("\n")
    out: list[tuple[str, int, list[str]]] = []
    for line, fenced in zip(lines, fence_lines(lines), strict=True):
        m = None if fenced else _COLUMN0.match(line)
        if m:
            out.append((m.group(2), len(m.group(1)), []))
        elif out:
            out[-1][2].append(line)
    return [(h, n, "\n".join(b).strip("\n")) for h, n, b in out]


def report_sections(text: str, max_depth: int = 6) -> list[tuple[int, str, str]]:
    """``(level, title, content)`` for token reports: any fence line toggles, headings may be indented, deeper headings go."""
    out: list[tuple[int, str, list[str]]] = []
    fenced = False
    for line in text.split("\n"):
        if line.lstrip().startswith("```"):
            fenced = not fenced
        m = None if fenced else _INDENTED.match(line)
        if m and len(m.group(1)) <= max_depth:
            out.append((len(m.group(1)), m.group(2), []))
        elif out and not m:
            out[-1][2].append(line)
    return [(n, t, "\n".join(b).strip()) for n, t, b in out]


def parse_heading(line: str) -> tuple[str, int]:
    m = _COLUMN0.match(line.strip())
    return (m.group(2), len(m.group(1))) if m else ("", 999)


def heading_of(line: Column) -> Column:
    """Struct of ``heading`` and ``level`` of a line; ("", 999) for a line that is none. As ``parse_heading``, in the JVM."""
    rx = r"^(#{1,6})\s+(.+?)\s*#*\s*$"
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    return F.struct(F.regexp_extract(bare, rx, 2).alias("heading"), F.when(bare.rlike(rx), F.length(F.regexp_extract(bare, rx, 1))).otherwise(999).alias("level"))


_BLOCK = "array<struct<heading:string,level:int,content:string>>"


def explode_blocks(docs: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``file, seq, heading, level, content``, a row per heading block in document order."""

    @F.pandas_udf(_BLOCK)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: [{"heading": h, "level": n, "content": c} for h, n, c in heading_blocks(t)] if isinstance(t, str) else [])

    return docs.select(F.col(path).alias("file"), F.posexplode(parse(F.col(text))).alias("seq", "b")).select("file", "seq", "b.*")


def with_hierarchy(blocks: DataFrame, sep: str = " > ") -> DataFrame:
    """Adds ``concat_header_path`` and ``parent_seq`` from levels in document order.

    Per level, the last heading so far; it is an ancestor if it is above the row's level and newer than all headings
    of lower number of level before it. Windows over one file each.
    """
    w = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = blocks
    for n in range(1, 7):
        out = out.withColumn(f"__l{n}", F.last(F.when(F.col("level") == n, F.struct("seq", "heading")), ignorenulls=True).over(w))
    valid = []
    for n in range(1, 7):
        newest = F.greatest(F.lit(-1), *[F.coalesce(F.when(F.lit(k) < n, F.col(f"__l{k}.seq")), F.lit(-1)) for k in range(1, n)]) if n > 1 else F.lit(-1)
        valid.append((F.col(f"__l{n}").isNotNull()) & (F.lit(n) <= F.col("level")) & (F.col(f"__l{n}.seq") > newest))
    path = F.concat_ws(sep, *[F.when(v, F.col(f"__l{n}.heading")) for n, v in enumerate(valid, 1)])
    parent = F.greatest(*[F.when(v & (F.lit(n) < F.col("level")), F.col(f"__l{n}.seq")) for n, v in enumerate(valid, 1)])
    return out.withColumn("concat_header_path", path).withColumn("parent_seq", parent).drop(*[f"__l{n}" for n in range(1, 7)])


def enforce_size(heading: str, content: str, limit: int = 500, count: Callable[[str], int] = lambda t: len(t.split())) -> list[tuple[str, str, str]]:
    """``(kind, content, language)``: while the text is above the limit, its largest fence, else its last table, becomes a part of its own.

    Parts follow the text in document order; long fences are split at function starts, tables get a caption.
    """
    rest, parts = content, []
    while count(rest) > limit:
        spans = code_spans(rest)
        if spans:
            best = max(spans, key=lambda s: (count(s[3]), -s[0]))
            start, end, tag, code = best
            lang = tag or detect_language(code)
            pieces = split_code(code, lang, keep_head=True) if count(code) > limit else [code.rstrip("\n")]
            parts.append((start, [("example", f"```{lang}\n{p}\n```", lang) for p in pieces]))
        elif tables := table_spans(rest):
            start, end, _ = tables[-1]
            parts.append((start, [("table", decorate(heading, rest[start:end]), "")]))
        else:
            break
        rest = rest[:start].rstrip("\n") + "\n\n" + rest[end:].lstrip("\n")
    out = [("heading", rest.strip("\n"), "")]
    for _, group in sorted(parts, key=lambda p: p[0]):
        out.extend(group)
    return out


def build_chunks(docs: DataFrame, path: str = "path", text: str = "text", limit: int = 500) -> DataFrame:
    """Documents to chunks: ``id, filename, parent_id, heading, header_level, concat_header_path, chunk_type, content, examples, language, token_count, pos``."""
    from quarryloom.functions.text import chunk_id, token_count

    blocks = with_hierarchy(explode_blocks(docs, path, text))

    @F.pandas_udf("array<struct<kind:string,content:string,language:string>>")
    def parts(heading: pd.Series, content: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "content": c, "language": g} for k, c, g in enforce_size(h, t or "", limit)] for h, t in zip(heading, content, strict=True)])

    rows = blocks.select("*", F.posexplode(parts("heading", "content")).alias("part", "p")).withColumn("pos", F.col("seq") * 1000 + F.col("part"))
    own = chunk_id(F.col("level"), F.col("file"), F.col("pos"), F.col("p.kind"))
    head = chunk_id(F.col("level"), F.col("file"), F.col("seq") * 1000, F.lit("heading"))
    rows = rows.withColumn("id", own).withColumn("head", head)
    parents = blocks.select(F.col("file").alias("pf"), F.col("seq").alias("ps"), chunk_id(F.col("level"), F.col("file"), F.col("seq") * 1000, F.lit("heading")).alias("up"))
    rows = rows.join(parents, (F.col("file") == F.col("pf")) & (F.col("parent_seq") == F.col("ps")), "left")
    examples = F.collect_list(F.when(F.col("part") > 0, F.col("id"))).over(Window.partitionBy("file", "seq").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.select(
        "id", F.col("file").alias("filename"), F.when(F.col("part") > 0, F.col("head")).otherwise(F.col("up")).alias("parent_id"), "heading", F.col("level").alias("header_level"), "concat_header_path",
        F.col("p.kind").alias("chunk_type"), F.col("p.content").alias("content"), F.when(F.col("part") == 0, examples).otherwise(F.array().cast("array<string>")).alias("examples"),
        F.nullif(F.col("p.language"), F.lit("")).alias("language"), token_count(F.col("p.content")).cast("int").alias("token_count"), "pos")


def subtree_tokens(sections: DataFrame) -> DataFrame:
    """Adds ``end_seq`` (the next section of the same or a higher level) and ``cumulative`` tokens up to it; null without subsections.

    ``file, seq, level, tokens``. Running sums per file; per level the next heading of at most that level is the
    least following one, so no section is joined with its descendants.
    """
    w = Window.partitionBy("file").orderBy("seq")
    after = w.rowsBetween(1, Window.unboundedFollowing)
    out = sections
    for n in range(1, 7):
        out = out.withColumn(f"__n{n}", F.min(F.when(F.col("level") <= n, F.col("seq"))).over(after))
    end = F.coalesce(*[F.when(F.col("level") == n, F.col(f"__n{n}")) for n in range(1, 7)])
    out = out.withColumn("end_seq", end).drop(*[f"__n{n}" for n in range(1, 7)])
    out = out.withColumn("__run", F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("__next", F.lead("level").over(w))
    ends = out.select(F.col("file").alias("__f"), F.col("seq").alias("__s"), (F.col("__run") - F.col("tokens")).alias("__until"))
    total = F.sum("tokens").over(Window.partitionBy("file"))
    out = out.withColumn("__all", total).join(ends, (F.col("file") == F.col("__f")) & (F.col("end_seq") == F.col("__s")), "left")
    cumulative = F.coalesce("__until", "__all") - F.col("__run") + F.col("tokens")
    return out.withColumn("cumulative", F.when(F.col("__next") > F.col("level"), cumulative)).select(*sections.columns, "end_seq", "cumulative")


def duplicate_headings(blocks: DataFrame) -> DataFrame:
    """Headings that occur more than once under one parent: ``file, parent_seq, heading, level, places``; top headings have a null parent."""
    return blocks.groupBy("file", "parent_seq", "heading", "level").agg(F.sort_array(F.collect_list("seq")).alias("places")).where(F.size("places") > 1)


def _toc_norm(s: str) -> str:
    s = unicodedata.normalize("NFKC", s).lower()
    s = re.sub(r"^\s*(?:\d+(?:\.\d+)*|[ivxlc]+|[a-z])[.)]?\s+", "", s)
    return " ".join(re.sub(r"[^\w\s]", " ", s).split())


def headings_from_toc(text: str, toc: list[tuple[int, str]], cutoff: float = 0.9, longest: int = 180, max_level: int = 6, preserve: bool = False) -> str:
    """Headings rebuilt from a table of contents: entries are sought in order, equal after normalisation or alike by at least ``cutoff``.

    Matched lines take the entry's title without numbering; other headings lose their marks unless ``preserve``.
    """
    entries, at = [(n, t, _toc_norm(t)) for n, t in toc], 0
    out, lines = [], text.split("\n")
    for line, fenced in zip(lines, fence_lines(lines), strict=True):
        m = _INDENTED.match(line)
        bare = m.group(2) if m else line.strip()
        key = _toc_norm(bare) if bare and not fenced and len(bare) <= longest else ""
        hit = None
        if key:
            for k in range(at, len(entries)):
                if entries[k][2] == key or difflib.SequenceMatcher(None, entries[k][2], key).ratio() >= cutoff:
                    hit = k
                    break
        if hit is not None:
            level, title, _ = entries[hit]
            at = hit + 1
            out.append("#" * min(level, max_level) + " " + re.sub(r"^\s*(?:\d+(?:\.\d+)*)[.)]?\s+", "", title))
        elif m and not fenced and not preserve:
            out.append(m.group(2))
        else:
            out.append(line)
    return "\n".join(out)


def kept_pages(pages: DataFrame, front: int = 0, back: int = 0, drop: list[tuple[int, int]] | None = None) -> DataFrame:
    """``document, page`` rows without the first and last pages and without the ranges."""
    last = F.max("page").over(Window.partitionBy("document"))
    out = pages.withColumn("__last", last).where((F.col("page") > front) & (F.col("page") <= F.col("__last") - back)).drop("__last")
    for lo, hi in drop or []:
        out = out.where(~F.col("page").between(lo, hi))
    return out


def reduce_scores(column, how: str = "max"):
    """Column: per row of a score matrix its greatest, least or mean value, then the mean over rows."""
    inner = {"max": F.array_max, "min": F.array_min, "mean": lambda r: F.aggregate(r, F.lit(0.0), lambda a, x: a + x) / F.size(r)}[how]
    rows = F.transform(column, inner)
    return F.aggregate(rows, F.lit(0.0), lambda a, x: a + x) / F.size(rows)
