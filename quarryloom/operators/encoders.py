"""Pluggable encoders and pair scorers. A backend is made once per worker and maps a series of texts to vectors."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ENCODERS: dict[str, Callable[[int], Callable[[pd.Series], list[np.ndarray]]]] = {}


def register_encoder(name: str, factory: Callable[[int], Callable[[pd.Series], list[np.ndarray]]]) -> None:
    _ENCODERS[name] = factory


def _hashed_words(dim: int) -> Callable[[pd.Series], list[np.ndarray]]:
    """The offline default: signed hashed bags of words of unit length."""

    def run(texts: pd.Series) -> list[np.ndarray]:
        out = []
        for t in texts:
            v = np.zeros(dim, np.float32)
            for w in (t or "").lower().split():
                h = xxhash.xxh64_intdigest(w)
                v[h % dim] += 1.0 if h >> 63 else -1.0
            n = np.linalg.norm(v)
            out.append(v / n if n else v)
        return out

    return run


register_encoder("hashed_words", _hashed_words)


def encode(df: DataFrame, text: str, into: str, encoder: str = "hashed_words", dim: int = 256) -> DataFrame:
    """Adds the vector of a text column. Each distinct text is encoded once; unknown encoders raise."""
    if encoder not in _ENCODERS:
        raise ValueError(f"unknown encoder: {encoder}")
    factory = _ENCODERS[encoder]

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory(dim)
        for s in batches:
            yield pd.Series(model(s))

    coded = df.where(F.col(text).isNotNull()).select(text).distinct().withColumn(into, run(F.col(text)))
    return df.join(coded, text, "left")


_SCORERS: dict[str, Callable[[], Callable[[pd.Series, pd.Series], list[float]]]] = {}


def register_scorer(name: str, factory: Callable[[], Callable[[pd.Series, pd.Series], list[float]]]) -> None:
    _SCORERS[name] = factory


def _word_overlap() -> Callable[[pd.Series, pd.Series], list[float]]:
    """The offline default: the share of the query's distinct words that the candidate has."""

    def run(queries: pd.Series, candidates: pd.Series) -> list[float]:
        out = []
        for q, c in zip(queries, candidates, strict=True):
            wanted = {w for w in _SPACE.split((q or "").lower()) if w}
            has = {w for w in _SPACE.split((c or "").lower()) if w}
            out.append(len(wanted & has) / len(wanted) if wanted else 0.0)
        return out

    return run


#: As ``functions.text.tokens`` splits.
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
register_scorer("word_overlap", _word_overlap)


def score_pairs(pairs: DataFrame, query: str, candidate: str, into: str, scorer: str = "word_overlap") -> DataFrame:
    """Adds a scorer's value for each pair of texts, in Arrow batches; null texts count as empty, unknown scorers raise."""
    if scorer not in _SCORERS:
        raise ValueError(f"unknown scorer: {scorer}")
    factory = _SCORERS[scorer]

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for q, c in batches:
            yield pd.Series(model(q, c), dtype=float)

    return pairs.withColumn(into, run(F.col(query), F.col(candidate)))
