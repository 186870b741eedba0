"""Code fences: language guesses, pretty printing, and splits at function starts."""

from __future__ import annotations

import ast
import json
import re
import xml.dom.minidom

FENCE = re.compile(r"^([ \t]*)```([A-Za-z0-9_+\-.#]*)[ \t]*\r?\n(.*?)^[ \t]*```[ \t]*\r?$", re.M | re.S)


def _json(code: str) -> object | None:
    try:
        value = json.loads(code)
    except ValueError:
        return None
    return value if isinstance(value, (dict, list)) else None


def _xml(code: str) -> bool:
    if not code.lstrip().startswith("<"):
        return False
    try:
        xml.dom.minidom.parseString(code.strip())
    except Exception:
        return bool(re.match(r"\s*<(!doctype|html|head|body|div|table|p|ul|a)\b", code, re.I))
    return True


#: Signs of a language, tried in order.
SIGNS = (
    ("bash", r"^#!.*\b(ba|z)?sh\b|^\s*(\$ |export\s+\w+=|sudo\s|curl\s|cd\s|grep\s|echo\s|cat\s|pip3?\s+install|npm\s|git\s)"),
    ("typescript", r"\binterface\s+\w+\s*\{|:\s*(string|number|boolean)\b.*[;,)=]"),
    ("javascript", r"\b(const|let|var)\s+\w+\s*=|\bfunction\s*\w*\s*\(|=>|\bconsole\.log\("),
    ("css", r"^[^{}\n]+\{\s*[\w-]+\s*:[^{}]*;?\s*\}"),
    ("java", r"\bpublic\s+(static\s+)?(class|void|int|String)\b"),
    ("csharp", r"\busing\s+System\b|\bnamespace\s+\w+"),
    ("cpp", r"#include\s*<\w+>|\bstd::\w+"),
    ("c", r"#include\s*[<\"]\w+\.h|\bint\s+main\s*\("),
    ("python", r"^\s*(def|class)\s+\w+.*:\s*$|^\s*(from\s+[\w.]+\s+)?import\s+\w+\s*$|^\s*print\("),
    ("sql", r"^\s*(select\b.+\bfrom|insert\s+into|update\s+\w+\s+set|create\s+(table|view)|delete\s+from)\b"),
    ("rust", r"\bfn\s+\w+\s*(<[^>]*>)?\([^)]*\)\s*(->|\{)|\blet\s+mut\b|\bimpl\b.*\{|\buse\s+std::"),
)
_SIGNS = tuple((name, re.compile(p, re.M | re.I if name in ("sql",) else re.M)) for name, p in SIGNS)


def detect_language(code: str) -> str:
    """JSON, then interchange files and markup, then shell, script, style and C-like languages, then others by their signs; ``text`` if none."""
    if _json(code.strip()) is not None:
        return "json"
    if re.search(r"^\s*<MIFFile\b", code, re.M):
        return "mif"
    if _xml(code):
        return "html" if re.match(r"\s*<(!doctype html|html|head|body|div|p|ul|table|a)\b", code, re.I) else "xml"
    return next((name for name, rx in _SIGNS if rx.search(code)), "text")


def _tag_for(tag: str, code: str) -> str:
    tag = tag.lower()
    found = detect_language(code)
    if not tag or (tag == "json" and found != "json" and found != "text") or (tag in ("text", "txt", "plain") and found != "text"):
        return found if found != "text" else tag
    return tag


def annotate_fences(text: str) -> str:
    """Names the language of untagged fences and corrects those tagged JSON or plain that are clearly something else."""
    return FENCE.sub(lambda m: f"{m.group(1)}```{_tag_for(m.group(2), m.group(3))}\n{m.group(3)}{m.group(1)}```", text)


def pretty_json(code: str) -> str | None:
    value = _json(code.strip())
    if value is None:
        body = code.strip().rstrip(",")
        for opened, closed in (("{", "}"), ("[", "]")):
            value = _json(opened + body + closed)
            if value is not None:
                inner = json.dumps(value, indent=2, ensure_ascii=False).split("\n")[1:-1]
                return "\n".join(x[2:] for x in inner)
        return None
    return json.dumps(value, indent=2, ensure_ascii=False)


def pretty_xml(code: str) -> str | None:
    try:
        doc = xml.dom.minidom.parseString(re.sub(r">\s+<", "><", code.strip()))
    except Exception:
        return None
    return "\n".join(x for x in doc.documentElement.toprettyxml(indent="  ").split("\n") if x.strip())


def pretty_braces(code: str) -> str | None:
    """Re-indents brace languages line by line; strings are not parsed, so code whose braces don't balance is left alone."""
    if code.count("{") != code.count("}") or code.count("{") == 0:
        return None
    depth, out = 0, []
    for line in code.split("\n"):
        bare = line.strip()
        depth -= len(re.match(r"^[})\]]*", bare).group().replace(")", "").replace("]", ""))
        out.append("  " * max(depth, 0) + bare if bare else "")
        depth += bare.count("{") - bare.count("}") + len(re.match(r"^}*", bare).group())
    return "\n".join(out)


def pretty_python(code: str) -> str | None:
    try:
        ast.parse(code)
    except (SyntaxError, ValueError):
        return None
    return re.sub(r"[ \t]+$", "", code.expandtabs(4), flags=re.M)


FORMATTERS = {"json": pretty_json, "xml": pretty_xml, "html": pretty_xml, "javascript": pretty_braces, "typescript": pretty_braces, "css": pretty_braces, "java": pretty_braces, "c": pretty_braces, "cpp": pretty_braces, "csharp": pretty_braces, "python": pretty_python}


def format_fences(text: str) -> str:
    """Every fence detected and formatted; it stays as it is where that fails."""

    def one(m: re.Match) -> str:
        lang = _tag_for(m.group(2), m.group(3))
        done = FORMATTERS.get(lang, lambda _: None)(m.group(3))
        return m.group() if done is None else f"{m.group(1)}```{lang}\n{done.rstrip(chr(10))}\n{m.group(1)}```"

    return FENCE.sub(one, text)


def code_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, tag, code)`` of closed fences."""
    return [(m.start(), m.end(), m.group(2), m.group(3)) for m in FENCE.finditer(text)]


_PY_START = re.compile(r"^(async\s+)?def\s+\w+")
_JS_START = re.compile(r"^\s*(export\s+)?(default\s+)?(async\s+)?function\b|^\s*(export\s+)?(const|let|var)\s+\w+\s*=\s*(async\s*)?(\([^)]*\)|\w+)\s*=>|^\s*(export\s+)?(const|let|var)\s+\w+\s*=\s*(async\s+)?function\b|^\s*\w+\s*\([^)]*\)\s*\{\s*$")


def _split_at(code: str, start: re.Pattern, comment: str | tuple[str, ...], keep_head: bool) -> list[str]:
    lines = code.split("\n")
    cuts = []
    for i, line in enumerate(lines):
        if start.match(line) and not re.match(r"^\s*(if|for|while|switch|catch)\b", line):
            while i and lines[i - 1].lstrip().startswith(comment):
                i -= 1
            cuts.append(i)
    if not cuts:
        return [code]
    if keep_head and cuts[0] and "".join(lines[: cuts[0]]).strip():
        cuts.insert(0, 0)
    return ["\n".join(lines[a:b]).strip("\n") for a, b in zip(cuts, [*cuts[1:], len(lines)], strict=True)]


def split_code(code: str, language: str = "", keep_head: bool = False) -> list[str]:
    """Parts that begin at function starts, with the comments right above them. Code before the first goes unless ``keep_head``."""
    lang = language.lower() or detect_language(code)
    if lang in ("python", "py"):
        return _split_at(code, _PY_START, "#", keep_head)
    if lang in ("javascript", "typescript", "js", "ts"):
        return _split_at(code, _JS_START, ("//", "/*", "*"), keep_head)
    return [code]
