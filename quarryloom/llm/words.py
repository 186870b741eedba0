"""Word-level text normalisation that several operators of this subpackage share (worker-side Python, no Spark)."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")
_APOSTROPHES = dict.fromkeys(map(ord, "'’ʼ‘`´"), None)


def fold(text: str) -> str:
    """Lower case, normal letter width, no accents, no apostrophes."""
    if text.isascii():
        return text.lower().translate(_APOSTROPHES)
    text = unicodedata.normalize("NFKC", text).translate(_APOSTROPHES).casefold()
    text = unicodedata.normalize("NFD", text)
    return "".join(c for c in text if not unicodedata.combining(c))


def words(text: str | None) -> list[str]:
    """The folded words of a text: maximal runs of letters and digits."""
    return _WORD.findall(fold(text)) if text else []


def plain_words(text: str | None) -> list[str]:
    """Words without regard to letter case, width, punctuation and spacing; accents stay."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _WORD.findall(text.lower().translate(_APOSTROPHES))


class WordIds(dict):
    """Word -> 64-bit hash, computed once for each distinct word a worker meets; emptied when it grows large."""

    limit = 500_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value


def word_hashes(tokens: list[str], ids: WordIds) -> np.ndarray:
    return np.array([ids[w] for w in tokens], dtype=np.uint64)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent 64-bit hash of each run of ``n`` consecutive words, as signed integers."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        acc = hashes[:count].copy()
        for k in range(1, n):
            acc = (acc ^ (acc >> np.uint64(29))) * _MIX + hashes[k : k + count]
        acc ^= acc >> np.uint64(32)
    return acc.view(np.int64)
