"""Problem 8: evaluation texts leaking into training text. Rare n-gram seeds, then Smith-Waterman over words."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryloom.llm.bits import bit_table, maybe, only_maybe, salted_join
from quarryloom.llm.words import WordIds, ngram_hashes, plain_words, word_hashes
from quarryloom.runtime import cut, spread

SEED_WORDS = 5
#: Consecutive words of an item that make a document a case.
RUN_WORDS = 12
#: An n-gram is rare for its item while no more than so many times as frequent as the item's middle n-gram that the corpus holds.
COMMON = 4
#: The rarest n-grams that each window of ``RUN_WORDS`` words gives as seeds in any case.
PER_WINDOW = 2
#: Seeds count together whose places in document and item differ by this many words or less: what an edited copy may add or drop between them.
BAND = 16
#: Words of an item that a document must hold in such a band in whole n-grams to be aligned with it: two thirds of ``RUN_WORDS``.
COVER = 8
#: Pairs that one task aligns.
PAIRS_PER_TASK = 1000

MATCH, MISMATCH, GAP = 2, -1, -1


def item_grams(items: DataFrame, n: int = SEED_WORDS) -> DataFrame:
    """``item_id, pos, gram`` of every n-gram of every item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for b in batches:
            item, pos, gram = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                g = ngram_hashes(word_hashes(plain_words(t), ids), n)
                item.extend([i] * len(g))
                pos.extend(range(len(g)))
                gram.append(g)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(pos, pa.int32()), pa.array(np.concatenate(gram) if gram else [], pa.int64())], ["item_id", "pos", "gram"])

    return items.select(F.col("item_id").cast("bigint"), "text").where(F.col("text").isNotNull()).mapInArrow(work, "item_id bigint, pos int, gram bigint")


def gram_hits(documents: DataFrame, grams: DataFrame, n: int = SEED_WORDS) -> DataFrame:
    """``doc_id, gram, dpos``: every occurrence of an item's n-gram in a document, ``dpos`` being its place in words.

    The one pass of words over the corpus: frequencies and seeds' places both come from its result. A bit table of
    fixed size discards nearly all other n-grams on the way; the few that slip through meet no item in the join.
    """
    held = bit_table(grams, "gram")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, table = WordIds(), held.value
        for b in batches:
            hashes = [word_hashes(plain_words(t), ids) for t in b.column(1).to_pylist()]
            ends = np.cumsum([len(h) for h in hashes], dtype=np.int64)
            # All texts of the batch at once; n-grams that reach into the next text are dropped.
            g = ngram_hashes(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), n)
            at = maybe(table, g)
            owner = np.searchsorted(ends, at, side="right")
            inside = at + n <= ends[owner] if len(at) else np.empty(0, bool)
            at, owner = at[inside], owner[inside]
            first = np.append(0, ends)[owner]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner)), pa.array(g[at]), pa.array((at - first).astype(np.int32))], ["doc_id", "gram", "dpos"])

    docs = documents.select(F.col("doc_id").cast("bigint"), "text").where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    found = docs.mapInArrow(work, "doc_id bigint, gram bigint, dpos int")
    return salted_join(found, grams.select("gram").distinct(), ["gram"], "doc_id").select("doc_id", "gram", "dpos").distinct()


def rare_seeds(grams: DataFrame, frequencies: DataFrame, run: int = RUN_WORDS, n: int = SEED_WORDS) -> DataFrame:
    """``item_id, pos, gram, weight``: the n-grams of each item that count as rare, among those that some document holds.

    These are of each window of ``run`` words the ``PER_WINDOW`` rarest, so a document that holds a whole window holds
    these of it however common its parts are; and all that are at most ``COMMON`` times as frequent as the item's middle
    one, so that an edited copy is met by whatever it left whole. ``weight`` is 1, or ``PER_WINDOW`` for the n-gram of a
    window that has no other. N-grams that no document holds can't be seeds; items of fewer than ``n`` words have none.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, own in zip(b.column("item_id").to_pylist(), b.column("own").to_pylist(), strict=True):
                own.sort(key=lambda x: x["pos"])
                df = {x["gram"]: x["df"] for x in own}
                most = COMMON * sorted(x["df"] for x in own)[len(own) // 2]
                chosen = {g: 1 for g, d in df.items() if d <= most}
                lo = 0
                for hi, x in enumerate(own):
                    while own[lo]["pos"] < x["pos"] - (run - n):
                        lo += 1
                    window = {y["gram"] for y in own[lo : hi + 1]}
                    for g in heapq.nsmallest(PER_WINDOW, window, key=lambda g: (df[g], g)):
                        chosen[g] = max(chosen.get(g, 1), PER_WINDOW if len(window) == 1 and hi - lo == run - n else 1)
                out.extend((i, x["pos"], x["gram"], chosen[x["gram"]]) for x in own if x["gram"] in chosen)
            cols = zip(*out, strict=True) if out else [[]] * 4
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["item_id", "pos", "gram", "weight"])

    own = grams.join(frequencies, "gram").groupBy("item_id").agg(F.collect_list(F.struct("pos", "gram", "df")).alias("own"))
    return own.mapInArrow(pick, "item_id bigint, pos int, gram bigint, weight int")


def seeded_pairs(hits: DataFrame, seeds: DataFrame, grams: DataFrame, n: int = SEED_WORDS) -> DataFrame:
    """``doc_id, item_id, places``: pairs worth an alignment, and the places in the document that it has to pass.

    First the pairs with seeds of weight ``PER_WINDOW`` in one band of diagonals; of these, such as have in that band
    n-grams of the item, rare or not, that cover ``COVER`` of its words. A whole window of ``RUN_WORDS`` words does
    both. Bands overlap by half, so n-grams within ``BAND`` words of one diagonal always share one.
    """
    diagonal = F.floor((F.col("dpos") - F.col("pos")) / BAND)

    def bands():
        return F.explode(F.array(diagonal, diagonal + 1)).alias("band")

    met = salted_join(hits, seeds, ["gram"], "doc_id").select("doc_id", "item_id", "gram", "weight", bands()).distinct()
    met = met.groupBy("doc_id", "item_id", "band").agg(F.sum("weight").alias("weight")).where(F.col("weight") >= PER_WINDOW).select("doc_id", "item_id", "band")
    own = salted_join(met.select("doc_id", "item_id").distinct().join(hits, "doc_id"), grams, ["item_id", "gram"], "doc_id").select("doc_id", "item_id", "pos", "dpos", bands())
    own = own.join(met, ["doc_id", "item_id", "band"]).groupBy("doc_id", "item_id", "band").agg(
        F.array_sort(F.collect_set("pos")).alias("held"), F.collect_set("dpos").alias("at"))
    steps = F.transform(F.sequence(F.lit(1), F.size("held") - 1), lambda i: F.least(F.get("held", i) - F.get("held", i - 1), F.lit(n)))
    covered = F.lit(n) + F.when(F.size("held") > 1, F.aggregate(steps, F.lit(0), lambda x, y: x + y)).otherwise(0)
    return own.where(covered >= COVER).groupBy("doc_id", "item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("places"))


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over word ids with linear gaps: ``(best score, identical words on the best path, longest common run)``.

    Row by row with vectorised columns; horizontal gaps are resolved by a running maximum.
    """
    m = len(b)
    if not len(a) or not m:
        return 0, 0, 0
    steps = np.arange(m + 1, dtype=np.int64)
    h, same = np.zeros(m + 1, dtype=np.int64), np.zeros(m + 1, dtype=np.int64)
    run = np.zeros(m + 1, dtype=np.int64)
    best = ident = longest = 0
    for x in a:
        eq = b == x
        diag = h[:-1] + np.where(eq, MATCH, MISMATCH)
        up = h[1:] + GAP
        cell = np.maximum(np.maximum(diag, up), 0)
        hits = np.where(diag >= up, same[:-1] + eq, same[1:])
        hits[cell == 0] = 0
        # left gaps: cell[j] = max over k<=j of cell[k] - (j-k), found with a running maximum of cell + j
        lifted = np.concatenate(([0], cell)) + steps
        reach = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == reach, steps, 0))
        new = reach - steps
        h, same = np.maximum(new, 0), np.concatenate(([0], hits))[source]
        run[1:] = np.where(eq, run[:-1] + 1, 0)
        longest = max(longest, int(run.max()))
        top = int(h.argmax())
        if h[top] > best:
            best, ident = int(h[top]), int(same[top])
    return best, ident, longest


def _near(words: np.ndarray, places: list[int], size: int) -> np.ndarray:
    """The words that an alignment of ``size`` item words through one of the places can reach, other stretches as one gap.

    A local alignment never has more gaps than its matches pay for, so it stays within three times the item's length.
    """
    reach = 3 * size
    mask = np.zeros(len(words) + 1, np.int32)
    at = np.asarray(places)
    np.add.at(mask, np.maximum(at - reach, 0), 1)
    np.add.at(mask, np.minimum(at + reach + 1, len(words)), -1)
    inside = np.cumsum(mask[:-1]) > 0
    if inside.all():
        return words
    left_out = np.append(False, inside[1:] < inside[:-1])
    out = words.copy()
    out[left_out] = 0  # no word hashes to 0 but by a chance of 2^-64
    return out[inside | left_out]


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = WordIds()
    for b in batches:
        out = []
        cache: tuple[int | None, np.ndarray] = (None, np.empty(0))
        for doc, item, dt, it, places in zip(*(b.column(c).to_pylist() for c in ("doc_id", "item_id", "text", "item_text", "places")), strict=True):
            if cache[0] != doc:
                cache = (doc, word_hashes(plain_words(dt), ids))
            w = word_hashes(plain_words(it), ids)
            score, ident, longest = align(w, _near(cache[1], places, len(w)))
            out.append((doc, item, len(w), score, ident, longest))
        cols = zip(*out, strict=True) if out else [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "item_words", "score", "matched", "longest_run"])


def leaks(documents: DataFrame, items: DataFrame, run: int = RUN_WORDS, n: int = SEED_WORDS) -> DataFrame:
    """Alignments of every document with every item of which it holds a rare seed, from a score of ``run`` identical words on.

    ``doc_id, item_id, item_words, score, matched, longest_run, share``: Smith-Waterman score over words, identical
    words on the best local alignment, the longest run of consecutive words of the item along any alignment, and
    score / (2 x words). Edited copies show as a high score with a short run. Letter case, width, punctuation and
    spacing do not matter. Null texts take no part; equal documents and items under other ids are reported under each.
    """
    grams = cut(item_grams(items, n))
    hits = cut(gram_hits(documents, grams, n))
    frequencies = hits.select("doc_id", "gram").distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    pairs = cut(seeded_pairs(hits, rare_seeds(grams, frequencies, run, n), grams, n))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    texts = items.select(F.col("item_id").cast("bigint"), F.col("text").alias("item_text"))
    width = spread(pairs, pairs.count(), PAIRS_PER_TASK)
    scored = pairs.join(only_maybe(docs, "doc_id", pairs), "doc_id").join(texts, "item_id").repartition(width, "doc_id").mapInArrow(
        _score, "doc_id bigint, item_id bigint, item_words int, score int, matched int, longest_run int")
    return scored.where(F.col("score") >= MATCH * run).withColumn("share", F.try_divide(F.col("score").cast("double"), F.lit(float(MATCH)) * F.col("item_words")))


def leaked_documents(documents: DataFrame, items: DataFrame, run: int = RUN_WORDS) -> DataFrame:
    """``doc_id, item_id`` of documents with at least ``run`` consecutive words of the item: an alignment whose score
    such a run gives, then the exact check of its runs."""
    return leaks(documents, items, run).where(F.col("longest_run") >= run).select("doc_id", "item_id").distinct()
