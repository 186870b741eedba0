"""Problem 5: token totals per slice. Distinct pieces are tokenized once; documents then join the cached lengths."""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.runtime import cut

#: The pieces with the most postings whose lengths every worker holds; a fixed bound, whatever the corpus.
HOT_PIECES = 20_000


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer by its parts: ``normalise`` a text, ``split`` it into pieces, and the token count of each of many distinct pieces.

    Token counts must add up over the pieces, as with every tokenizer that never merges across its pre-split.
    """

    name: str
    split: Callable[[str], list[str]]
    lengths: Callable[[list[str]], list[int]]
    normalise: Callable[[str], str] | None = None


#: The project's test tokenizer: one token per maximal run without white space.
WHITESPACE = Tokenizer("whitespace", str.split, lambda pieces: [1] * len(pieces))


def byte_bpe(rank_file: str, pattern: str, normal_form: str | None = None) -> Tokenizer:
    """A byte-level BPE from a rank file ("base64 rank" lines) and its pre-split pattern. The file is read on each worker once."""
    state: dict[str, object] = {}

    def split(text: str) -> list[str]:
        import regex

        if "re" not in state:
            state["re"] = regex.compile(pattern)
        return state["re"].findall(text)

    def lengths(pieces: list[str]) -> list[int]:
        import tiktoken

        if "bpe" not in state:
            with open(rank_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            state["bpe"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return [len(x) for x in state["bpe"].encode_ordinary_batch(pieces, num_threads=1)]

    normalise = (lambda t: unicodedata.normalize(normal_form, t)) if normal_form else None
    return Tokenizer("byte_bpe", split, lengths, normalise)


def _pieces(tokenizer: Tokenizer, text: str | None) -> Counter:
    if not text:
        return Counter()
    return Counter(tokenizer.split(tokenizer.normalise(text) if tokenizer.normalise else text))


def distinct_pieces(docs: DataFrame, text: str, tokenizer: Tokenizer = WHITESPACE) -> DataFrame:
    """Every distinct piece of the corpus with its number of documents: ``piece, df``. Counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total.update(_pieces(tokenizer, t).keys())
            if len(total) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["piece", "df"])
                total = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["piece", "df"])

    return docs.select(F.col(text).alias("t")).mapInArrow(count, "piece string, df bigint").groupBy("piece").agg(F.sum("df").alias("df"))


def piece_lengths(pieces: DataFrame, tokenizer: Tokenizer = WHITESPACE) -> DataFrame:
    """Tokenizes each distinct piece once: ``piece_hash, df, n_tokens, piece``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("piece").to_pylist()
            hashes = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), batch.column("df"), pa.array(tokenizer.lengths(texts), pa.int32()), batch.column("piece")], ["piece_hash", "df", "n_tokens", "piece"])

    return pieces.mapInArrow(measure, "piece_hash bigint, df bigint, n_tokens int, piece string")


def _hot_from(lengths: DataFrame, most: int) -> int:
    """The least document frequency that at most ``most`` pieces reach, from a histogram of some hundred steps."""
    step = F.floor(F.log2("df") * 8)
    total = 0
    least = 1 << 62
    for r in lengths.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("df").alias("least")).orderBy(F.desc("step")).collect():
        total += r["n"]
        if total > most:
            break
        least = r["least"]
    return least


def token_counts(docs: DataFrame, key: str, text: str, keep: list[str], tokenizer: Tokenizer = WHITESPACE, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """Exact tokens of every row: ``key, *keep, tokens``. Null and empty texts have 0.

    Lengths of at most ``hot_pieces`` of the most frequent pieces go through the driver to every worker, so a piece that is in a
    third of all rows never becomes one join key's group. All other pieces leave as (row, piece, frequency) and meet
    the length table in a shuffle join; rows are numbered by content of ``key`` and ``keep``, and equal rows count once.
    """
    lengths = cut(piece_lengths(distinct_pieces(docs, text, tokenizer), tokenizer))
    least = _hot_from(lengths, hot_pieces)
    hot = {r["piece"]: r["n_tokens"] for r in lengths.where(F.col("df") >= least).select("piece", "n_tokens").collect()}
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hot)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        tail = pa.list_(pa.struct([("h", pa.int64()), ("f", pa.int32())]))
        for batch in batches:
            sums, rest = [], []
            for t in batch.column("__text").to_pylist():
                total, cold = 0, []
                for piece, n in _pieces(tokenizer, t).items():
                    length = known.get(piece)
                    if length is None:
                        cold.append({"h": xxhash.xxh64_intdigest(piece) - (1 << 63), "f": n})
                    else:
                        total += n * length
                sums.append(total)
                rest.append(cold)
            index = batch.schema.get_field_index("__text")
            cols = [c for i, c in enumerate(batch.columns) if i != index]
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sums, pa.int64()), pa.array(rest, tail)], [*names, "__hot", "__tail"])

    ids = [key, *keep]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids)
    counted = docs.select(*ids, F.col(text).alias("__text")).mapInArrow(measure, f"{schema}, __hot bigint, __tail array<struct<h:bigint,f:int>>")
    done = counted.where(F.size("__tail") == 0).select(*ids, F.col("__hot").alias("tokens")).distinct()
    cold = counted.where(F.size("__tail") > 0).dropDuplicates(ids).select(*ids, "__hot", F.explode("__tail").alias("__p"))
    cold = cold.select(*ids, "__hot", F.col("__p.h").alias("piece_hash"), F.col("__p.f").alias("__f"))
    cold = cold.join(lengths.select("piece_hash", "n_tokens"), "piece_hash").groupBy(*ids, "__hot").agg(F.sum(F.col("__f") * F.col("n_tokens")).alias("__cold"))
    return done.unionByName(cold.select(*ids, (F.col("__hot") + F.col("__cold")).alias("tokens")))


#: Names, three-letter codes and aliases of natural languages (ISO 639) by their two-letter code.
LANGUAGES = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french français francais", "es": "es spa spanish español espanol castilian",
    "pt": "pt por portuguese português portugues", "it": "it ita italian italiano", "nl": "nl nld dut dutch nederlands", "pl": "pl pol polish polski",
    "ru": "ru rus russian русский", "uk": "uk ukr ukrainian", "cs": "cs ces cze czech", "sv": "sv swe swedish", "da": "da dan danish", "fi": "fi fin finnish",
    "no": "no nor norwegian nb nob nn nno", "tr": "tr tur turkish", "el": "el ell gre greek", "hu": "hu hun hungarian", "ro": "ro ron rum romanian",
    "ja": "ja jpn japanese", "zh": "zh zho chi chinese", "ko": "ko kor korean", "ar": "ar ara arabic", "he": "he heb hebrew", "hi": "hi hin hindi", "vi": "vi vie vietnamese",
}
#: Code languages and their aliases.
CODE_LANGUAGES = {"python": "python py python3", "javascript": "javascript js", "bash": "bash sh shell", "json": "json", "sql": "sql"}


def language_code(column):
    """Column: the two-letter code of a natural language, a code language's name, ``und`` for missing or empty.

    Regions and scripts after ``-`` or ``_`` are dropped. Unknown names stay as they are, lower-cased.
    """
    table = {alias: code for group in (LANGUAGES, CODE_LANGUAGES) for code, names in group.items() for alias in names.split()}
    low = F.lower(F.trim(column))
    base = F.regexp_extract(low, r"^([^\-_]*)", 1)
    mapping = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.when(low.isNull() | (low == ""), "und").otherwise(F.coalesce(F.try_element_at(mapping, low), F.try_element_at(mapping, base), low))


def category_name(column):
    low = F.lower(F.trim(column))
    return F.when(low.isNull() | (low == ""), "unknown").otherwise(low)


def chunk_tokens(chunks: DataFrame, tokenizer: Tokenizer = WHITESPACE) -> DataFrame:
    """``id, category, language, token_count, tokens`` of every chunk, redelivered rows once."""
    rows = chunks.select("id", F.col("token_count").cast("bigint").alias("token_count"), category_name(F.col("category")).alias("category"), language_code(F.col("language")).alias("language"), "content")
    return token_counts(rows, "id", "content", ["category", "language", "token_count"], tokenizer)


def stale_token_counts(chunks: DataFrame, tokenizer: Tokenizer = WHITESPACE) -> DataFrame:
    """Chunks whose stored ``token_count`` is null or wrong: ``id, category, language``."""
    counted = chunk_tokens(chunks, tokenizer)
    return counted.where(F.col("token_count").isNull() | (F.col("token_count") != F.col("tokens"))).select("id", "category", "language").distinct()


def token_budget(rows: DataFrame, by: list[str]) -> DataFrame:
    """Totals per slice: ``*by, rows, tokens``."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("tokens"))
