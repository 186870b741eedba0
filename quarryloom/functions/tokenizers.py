"""Token counts of public byte-level tokenizers, as an alternative to white space."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: how such tokenizers usually split a text before merging.
PATTERN = r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"


def bpe_counts(rank_file: str, pattern: str = PATTERN) -> Callable[[Column], Column]:
    """A function of a text column that counts its tokens; null has none. ``rank_file`` holds "base64 rank" lines.

    The file goes to the workers with the job, so they need no copy of their own; each reads it once.
    """
    from pyspark import SparkFiles
    from pyspark.sql import SparkSession

    SparkSession.active().sparkContext.addFile(rank_file)
    name = rank_file.rsplit("/", 1)[-1]

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for s in batches:
            yield s.map(lambda t: len(bpe.encode_ordinary(t)) if isinstance(t, str) else 0)

    return count
