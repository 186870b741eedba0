"""Problem 10: text decoded with the wrong character set, found and restored through a table of garbled word forms."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.llm.bits import salted_join
from quarryloom.runtime import cut

#: Single-byte character sets taken as the wrong reading, and as the true one of single-byte text.
READ_AS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "iso8859-15", "cp1251", "koi8-r", "cp866", "cp437", "cp850", "mac-roman")
TRUE_SINGLE = ("cp1252", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "cp437", "cp850", "mac-roman")
#: Wrong readings in a row that the table of forms covers; words read wrongly more often are taken back from their own bytes.
TABLE_DEPTH = 3
LOST = "�"

#: A word that holds a character beyond ASCII, with the ASCII letters and digits it is joined to.
#: The lookbehind keeps a long ASCII run from being tried from each of its characters.
_WORD = re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z]*[^\x00-\x7f](?:[0-9A-Za-z]|[^\x00-\x7f])*")
_RUN = re.compile(r"[^\x00-\x7f]+")


def _table(name: str) -> tuple[dict[int, str], dict[str, int]]:
    """Bytes 128-255 of a character set to characters and back; bytes it leaves open stand for themselves, as in browsers."""
    there = {}
    for b in range(128, 256):
        try:
            there[b] = bytes([b]).decode(name)
        except UnicodeDecodeError:
            there[b] = chr(b)
    return there, {c: b for b, c in there.items()}


_TABLES = {name: _table(name) for name in READ_AS}
_TRUE = {name: _table(name) for name in TRUE_SINGLE}


def encode_as(text: str, name: str) -> bytes | None:
    back = _TABLES[name][1] if name in _TABLES else _TRUE[name][1]
    out = bytearray()
    for c in text:
        o = ord(c)
        if o < 128:
            out.append(o)
        else:
            b = back.get(c)
            if b is None:
                return None
            out.append(b)
    return bytes(out)


def decode_as(raw: bytes, name: str) -> str:
    there = _TABLES[name][0]
    return "".join(chr(b) if b < 128 else there[b] for b in raw)


#: Blocks whose characters a restored word may hold without further proof: Latin to Extended-A, Greek, Russian-type Cyrillic, punctuation, currency, symbols.
_EVERYDAY = re.compile(r"[\x00-\x7f\xa0-ſƒȘ-țˆ˜Ͱ-ϿЀ-џҐґẞ‐-‧‰-⁞₠-₿℀-⅏←-⏿①-➿ﬁﬂ]*")
#: Scripts that one word may mix.
_EAST = frozenset({"CJK", "HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA", "HALFWIDTH", "FULLWIDTH", "IDEOGRAPHIC"})


def _script(c: str) -> str:
    name = unicodedata.name(c, "?").partition(" ")[0]
    return "EAST" if name in _EAST else name


def plausible(original: str, garbled: str) -> bool:
    """Whether a word can be what was garbled: of everyday characters; else of assigned ones, letters of one script only,
    while the garbled word looks like none: symbols or control characters among its letters, or capitals after small ones."""
    if _EVERYDAY.fullmatch(original):
        return True
    high = [c for c in original if c > "\x7f"]
    if any(unicodedata.category(c) in ("Cc", "Cn", "Co", "Cs") for c in high) or LOST in original:
        return False
    scripts = {_script(c) for c in high if c.isalpha()}
    return len(scripts) <= 1 and (_c1(garbled) or oddness(garbled) > 0) and oddness(original) <= oddness(garbled)


def _lone_cyrillic(text: str) -> bool:
    """A chance reading: one Cyrillic letter among Latin ones, or alone."""
    return sum("Ѐ" <= c <= "ӿ" for c in text) == 1 and (len(text) == 1 or any(c.isalpha() and c < "ɐ" for c in text))


def ungarble(word: str) -> tuple[str, str] | None:
    """``(original, chain)`` where a word's bytes in one character set are whole UTF-8, taken back as often as that is so; else None.

    Each step has fewer bytes than the last, so it ends. The last plausible reading counts.
    """
    best = None
    for name in READ_AS:
        text, depth = word, 0
        while not text.isascii():
            raw = encode_as(text, name)
            if raw is None:
                break
            try:
                back = raw.decode("utf-8")
            except UnicodeDecodeError:
                break
            if back == text or not back:
                break
            text, depth = back, depth + 1
            if not text.isascii() and plausible(text, word) and not _lone_cyrillic(text) and (best is None or depth > best[2]):
                best = (text, f"utf-8>{name}" + (f" x{depth}" if depth > 1 else ""), depth)
    return best and best[:2]


def garbled_forms(word: str) -> dict[str, str]:
    """Every wrong reading of a clean word -> its chain: UTF-8 read as single bytes (up to ``TABLE_DEPTH`` times), single-byte sets read as others, lost characters."""
    out: dict[str, str] = {}
    for name in READ_AS:
        text = word
        for depth in range(1, TABLE_DEPTH + 1):
            text = decode_as(text.encode("utf-8"), name)
            out.setdefault(text, f"utf-8>{name}" + (f" x{depth}" if depth > 1 else ""))
    if len(word) > 2 and any(c.isalpha() for c in word if c > "\x7f"):
        for true in TRUE_SINGLE:
            raw = encode_as(word, true)
            if raw is not None:
                for name in READ_AS:
                    if name != true:
                        out.setdefault(decode_as(raw, name), f"{true}>{name}")
    out.setdefault("".join(LOST if c > "\x7f" else c for c in word), "lost")
    out.setdefault("".join(LOST * len(c.encode("utf-8")) if c > "\x7f" else c for c in word), "lost bytes")
    out.pop(word, None)
    return out


def oddness(word: str) -> int:
    """How unlike a word it looks: symbols among letters, capitals after small letters, mixed scripts."""
    letters = [c for c in word if c.isalpha()]
    core = word.strip("“”„‘’«»‹›–—…\"'\xa0\u2009\u202f")
    symbols = sum(not (c.isalnum() or c in "’'") and c > "\x7f" for c in core) if letters else 0
    turns = sum(a.islower() and b.isupper() for a, b in zip(word, word[1:], strict=False))
    scripts = len({"c" if "Ѐ" <= c <= "ӿ" else "g" if "Ͱ" <= c <= "Ͽ" else "l" for c in letters})
    return symbols + turns + max(0, scripts - 1)


def _c1(word: str) -> bool:
    return any("\x80" <= c <= "\x9f" and c != "\x85" for c in word)


def _doc_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [sorted(set(_WORD.findall(t))) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], ["doc_id", "words"])


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        form, orig, chain, df = [], [], [], []
        for w, n in zip(b.column("word").to_pylist(), b.column("df").to_pylist(), strict=True):
            if LOST in w or _c1(w):
                continue
            clean = ungarble(w) is None
            for f, c in garbled_forms(w).items():
                if clean or not c.startswith(("utf-8", "lost")):  # a garbled word is no original of these
                    form.append(f)
                    orig.append(w)
                    chain.append(c)
                    df.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(form, pa.string()), pa.array(orig, pa.string()), pa.array(chain, pa.string()), pa.array(df, pa.int64())], ["form", "original", "chain", "odf"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word, the table's verified original, else what its own bytes show; words that are no case are left out."""
    for b in batches:
        bad, orig, chain = [], [], []
        for w, n, cands in zip(*(b.column(c).to_pylist() for c in ("word", "df", "cands")), strict=True):
            own = None if LOST in w else ungarble(w)
            good = []
            for c in cands or []:
                if LOST in w:
                    ok = True
                elif c["chain"].startswith("utf-8"):
                    ok = plausible(c["original"], w)
                else:
                    a, z = oddness(c["original"]), oddness(w)
                    ok = a < z or (a == z and c["odf"] > n)
                if ok:
                    good.append(c)
            utf = [c for c in good if c["chain"].startswith("utf-8")]
            if own and not any(c["original"] == own[0] for c in utf):
                found = own
            elif good:
                top = max(utf or good, key=lambda c: (c["odf"], c["original"]))
                found = (top["original"], top["chain"])
            elif LOST in w:
                found = (None, "lost")
            elif _c1(w):
                found = (None, "control characters")
            else:
                continue
            bad.append(w)
            orig.append(found[0])
            chain.append(found[1])
        yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string()), pa.array(orig, pa.string()), pa.array(chain, pa.string())], ["word", "original", "chain"])


def word_repairs(doc_words: DataFrame) -> DataFrame:
    """``word, original, chain`` of every garbled word of the corpus; ``original`` null where it can't be recovered.

    Every distinct word is garbled under all chains; the forms meet the corpus's words in a hash join. A met form is
    verified: UTF-8 chains by taking the bytes back, single-byte chains by looking less like a word than its original
    or as much but rarer. Words without an original in the corpus are taken back from their own bytes.
    """
    words = cut(doc_words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    forms = words.mapInArrow(_forms, "form string, original string, chain string, odf bigint")
    met = words.select(F.col("word").alias("form")).join(forms, "form")
    # A form has few originals by any other chain; of the many words that lost characters make alike, the commonest is taken.
    lost = F.col("chain").startswith("lost")
    best = met.where(lost).groupBy("form").agg(F.max(F.struct("odf", "original", "chain")).alias("b")).select("form", F.struct("b.original", "b.chain", "b.odf").alias("c"))
    cands = met.where(~lost).select("form", F.struct("original", "chain", "odf").alias("c")).unionByName(best).groupBy(F.col("form").alias("word")).agg(F.collect_list("c").alias("cands"))
    return words.join(cands, "word", "left").mapInArrow(_verify, "word string, original string, chain string")


def garbled_words(documents: DataFrame) -> DataFrame:
    """``doc_id, word, original, chain``: each garbled word of each document once."""
    some = documents.select("doc_id", "text").where(F.length("text") != F.octet_length("text"))
    doc_words = cut(some.mapInArrow(_doc_words, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, words array<string>"))
    repairs = word_repairs(doc_words)
    return salted_join(doc_words.select("doc_id", F.explode("words").alias("word")), repairs, ["word"], "doc_id").select("doc_id", "word", "original", "chain")


def garbled_documents(documents: DataFrame) -> DataFrame:
    """``doc_id`` of documents with text decoded by a wrong character set, or with characters lost by it. Null texts are none."""
    return garbled_words(documents).select("doc_id").distinct()


def restored_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, text, restored, unrecovered``: affected documents with every recoverable word put back, and both numbers of words."""
    fixes = garbled_words(documents).groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("original").isNotNull(), F.struct("word", "original")))).alias("fixes"), F.count_if(F.col("original").isNull()).alias("unrecovered"))

    def put_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t, pairs in zip(b.column("text").to_pylist(), b.column("fixes").to_pylist(), strict=True):
                table = dict(pairs)
                texts.append(_WORD.sub(lambda m, table=table: table.get(m.group(), m.group()), t))
                counts.append(len(table))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int32()), b.column("unrecovered")], ["doc_id", "text", "restored", "unrecovered"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").join(fixes, "doc_id").mapInArrow(put_back, f"doc_id {kind}, text string, restored int, unrecovered bigint")
