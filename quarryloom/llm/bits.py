"""A bit table of fixed size over 64-bit keys, so that map tasks can discard most rows that a join would not match."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a table: 4 MB at every worker and at most ``BITS / 64`` rows at the driver, whatever the number of keys.
BITS = 1 << 25


def bit_table(keys: DataFrame, column: str):
    """A broadcast table with two bits set for every key. It passes all keys and few others; full, it passes everything.

    The bits are put together in a group by word, so neither the driver nor a worker ever sees the keys themselves.
    """
    key = F.col(column)
    slots = F.explode(F.array(key.bitwiseAND(BITS - 1), F.shiftrightunsigned(key, 32).bitwiseAND(BITS - 1)))
    words = keys.select(slots.alias("slot")).select(F.shiftright("slot", 6).cast("int").alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    table = np.zeros(BITS // 64, dtype=np.int64)
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).collect()
    if found:
        table[[r[0] for r in found]] = [r[1] for r in found]
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint8))


def maybe(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that the table passes."""
    low = keys & (BITS - 1)
    at = np.flatnonzero(table[low >> 3] >> (low & 7).astype(np.uint8) & 1)
    if not len(at):
        return at
    high = (keys[at].view(np.uint64) >> np.uint64(32)).astype(np.int64) & (BITS - 1)
    return at[(table[high >> 3] >> (high & 7).astype(np.uint8) & 1).astype(bool)]


def only_maybe(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``column`` (never null) is not among that column of ``keys``; none of the others is lost."""
    held = bit_table(keys.select(F.xxhash64(column).alias("h")), "h")
    schema = rows.schema

    def work(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            keep[maybe(held.value, b.column(0).to_numpy())] = True
            if keep.any():
                yield pa.RecordBatch.from_arrays(b.columns[1:], names=b.schema.names[1:]).filter(pa.array(keep))

    return rows.select(F.xxhash64(column).alias("__h"), *rows.columns).mapInArrow(work, schema)


SALTS = 16


def salted_join(many: DataFrame, few: DataFrame, on: list[str], by: str) -> DataFrame:
    """Inner join on keys of which one may be in a third of the rows of ``many``: its rows go to ``SALTS`` places by the hash
    of their column ``by``, and every row of ``few`` to each of them."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    everywhere = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("__salt", salt).join(everywhere, [*on, "__salt"]).drop("__salt")
