"""Column functions on text, paths, URLs and identifiers. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_SEP = " > "
#: Texts that count as no content.
PLACEHOLDERS = ("", "n/a", "none", "null")


def strip(c: Column) -> Column:
    """Without outer white space of any kind, like Python's ``strip`` over ASCII."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def sentinel_to_null(c: Column) -> Column:
    """Null for null, empty and the string "false" that stands for a missing summary or vector."""
    s = strip(c)
    return F.when((s != "") & (F.lower(s) != "false"), c)


def tokens(c: Column) -> Column:
    """Lower-cased pieces between white space; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s+"), lambda t: t != "")


def token_count(c: Column) -> Column:
    return F.size(tokens(c)).cast("bigint")


def category(c: Column) -> Column:
    return F.lower(F.coalesce(blank_to_null(c), F.lit("unknown")))


def segments(path: Column, sep: str = PATH_SEP) -> Column:
    """Lower-cased, trimmed, non-empty parts of a heading path."""
    return F.filter(F.transform(F.split(F.lower(F.coalesce(path, F.lit(""))), r"\Q" + sep + r"\E"), lambda s: strip(s)), lambda s: s != "")


def relative_path(path: Column, root: str) -> Column:
    """A file path below ``root``, with forward slashes; null raises."""
    flat = F.regexp_replace(F.coalesce(path, F.raise_error(F.lit("a document without path"))), r"\\", "/")
    return F.regexp_replace(flat, r"^\Q" + root.rstrip("/") + r"\E/", "")


def top_heading(path: Column, heading: Column, sep: str = PATH_SEP) -> Column:
    return F.coalesce(F.try_element_at(segments(path, sep), F.lit(1)), F.lower(blank_to_null(heading)), F.lit(""))


def length_bucket(n: Column) -> Column:
    return F.when(n < 200, "short").when(n < 800, "medium").otherwise("long")


def human_size(n: Column) -> Column:
    """Bytes as B, KB, MB, GB or TB with one digit."""
    out = F.format_string("%d B", n.cast("bigint"))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB"), (4, "TB")):
        out = F.when(n >= 1024.0**power, F.format_string(f"%.1f {unit}", n / 1024.0**power)).otherwise(out)
    return out


def url_slug(url: Column) -> Column:
    """Last path segment of a URL without fragment, query and extension; ``index`` where there is none."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")
    last = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.coalesce(F.nullif(F.regexp_replace(last, r"\.[^.]*$", ""), F.lit("")), F.lit("index"))


def url_authority(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def repo_parts(url: Column) -> Column:
    """Owner, repository, branch (``main`` unless stated) and sub-path of a hosted repository's URL."""
    p = F.filter(F.split(F.regexp_replace(url, r"^[a-z]+://[^/]*/?", ""), "/"), lambda s: s != "")
    tree = F.try_element_at(p, F.lit(3)) == "tree"
    return F.struct(
        F.try_element_at(p, F.lit(1)).alias("owner"), F.regexp_replace(F.try_element_at(p, F.lit(2)), r"\.git$", "").alias("repo"),
        F.when(tree, F.try_element_at(p, F.lit(4))).otherwise("main").alias("branch"), F.when(tree, F.array_join(F.slice(p, 5, 1000), "/")).otherwise("").alias("subpath"))


def strip_numbering(c: Column) -> Column:
    """A heading without leading numbers, roman numerals or single letters that number it."""
    return F.regexp_replace(c, r"^\s*(?:(?:\d+(?:\.\d+)*|[IVXLC]+|[A-Za-z])[.)]\s+|\d+(?:\.\d+)+\s+|\d+\s+)", "")


def chunk_kind(kind: Column, content: Column) -> Column:
    body = F.ltrim(content)
    return F.coalesce(blank_to_null(kind), F.when(body.startswith("```"), "example").when(body.startswith("<!-- Data Table -->"), "table").otherwise("heading"))


def chunk_id(level: Column, file: Column, pos: Column, kind: Column) -> Column:
    """``h{level}_{8 hex}`` with ``_exa`` or ``_tab``; a hash of file and position instead of a random number."""
    suffix = F.when(kind == "example", "_exa").when(kind == "table", "_tab").otherwise("")
    return F.concat(F.lit("h"), level.cast("string"), F.lit("_"), F.substring(F.md5(F.concat_ws(":", file, pos.cast("string"))), 1, 8), suffix)


def embedding_text(path: Column, summary: Column, content: Column) -> Column:
    s, c = sentinel_to_null(summary), F.coalesce(content, F.lit(""))
    return F.when(F.length(strip(s)) > 20, F.concat_ws(": ", path, s)).when(F.length(strip(c)) > 100, F.concat_ws(": ", path, c)).otherwise(c)


def model_parts(c: Column, default: str = "openai") -> Column:
    at = F.instr(c, ":")
    return F.struct(F.when(at > 0, F.substring_index(c, ":", 1)).otherwise(default).alias("backend"), F.when(at > 0, F.substr(c, at + 1)).otherwise(c).alias("model"))


def fill_template(template: str, **values: Column) -> Column:
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def normalise_header(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"\\_", "_"), r"\s+", " "))


#: Fence tags and the language they stand for.
TAGS = {"py": "python", "python3": "python", "js": "javascript", "node": "javascript", "ts": "typescript", "sh": "bash", "shell": "bash", "zsh": "bash", "console": "bash", "yml": "yaml", "md": "markdown", "c++": "cpp", "cs": "csharp", "htm": "html"}


def fence_language(tag: Column) -> Column:
    low = F.lower(strip(tag))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in TAGS.items() for x in p]), low), low)


def format_value(v: Column, digits: int = 4) -> Column:
    """A number with fixed digits, an empty string for null."""
    return F.coalesce(F.format_string(f"%.{digits}f", v.cast("double")), F.lit(""))


def format_seconds(v: Column) -> Column:
    s = F.round(v).cast("bigint")
    return F.when(v < 60, F.format_string("%.1fs", v.cast("double"))).otherwise(F.format_string("%dm %02ds", F.floor(s / 60).cast("bigint"), s % 60))


def matches_spec(text: Column, contains: str | None = None, contains_all: tuple[str, ...] = (), contains_any: tuple[str, ...] = ()) -> Column:
    """Case-insensitive filter clause; false if it states nothing, null text counts as empty."""
    low = F.lower(F.coalesce(text, F.lit("")))
    parts = [low.contains(w.lower()) for w in ([contains] if contains else []) + list(contains_all)]
    if contains_any:
        some = F.lit(False)
        for w in contains_any:
            some = some | low.contains(w.lower())
        parts.append(some)
    out = F.lit(bool(parts))
    for p in parts:
        out = out & p
    return out


#: Other names of chunk fields.
FIELD_ALIASES = {"path": "concat_header_path", "header_path": "concat_header_path", "file": "filename", "text": "content", "summary": "chunk_summary"}


def field_value(name: str) -> Column:
    return F.coalesce(F.col(FIELD_ALIASES.get(name.lower(), name)).cast("string"), F.lit(""))


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def shares_scope(anchor: Column, other: Column) -> Column:
    """Whether a path lies in an anchor's scope: its first two segments, its only one, or any where it has none."""
    n = F.least(F.size(anchor), F.lit(2))
    return F.slice(anchor, F.lit(1), n) == F.slice(other, F.lit(1), n)
