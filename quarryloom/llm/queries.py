"""The registered queries of this subpackage: name -> function of (session, folder of tables)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryloom.llm import boilerplate, budget, encoding, leakage, markup, mixing, neighbours, overlap, splitting
from quarryloom.runtime import read_table

#: Folder of public tokenizer files; a parameter of the BPE query.
TOKENIZERS = os.environ.get("QUARRYLOOM_TOKENIZERS", "/opt/tokenizers")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "chunks")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents")


def p1_found(spark, d):
    return markup.markup_kinds(_chunks(spark, d))


def p1_nodes(spark, d):
    return markup.markup_nodes(_chunks(spark, d))


def p1_clean(spark, d):
    return markup.cleaned_chunks(_chunks(spark, d))


def p2_found(spark, d):
    return neighbours.similar_pairs(_chunks(spark, d)).select("field", "id_a", "id_b")


def p2_neighbours(spark, d):
    """The 10 most similar vectors of every valid vector, however similar they are."""
    return neighbours.nearest(_chunks(spark, d))


def p3_found(spark, d):
    return splitting.oversized_boundaries(_chunks(spark, d))


def p3_pieces(spark, d):
    return splitting.split_oversized(_chunks(spark, d))


def p4_found(spark, d):
    return boilerplate.furniture(_chunks(spark, d))


def p4_main_text(spark, d):
    return boilerplate.main_text(_chunks(spark, d))


def p5_found(spark, d):
    return budget.stale_token_counts(_chunks(spark, d))


def p5_totals(spark, d):
    """Token totals per category and language over distinct chunks."""
    return budget.token_budget(budget.chunk_tokens(_chunks(spark, d)), ["category", "language"])


def p5_document_totals(spark, d):
    """Exact totals of a public byte-level BPE by source and language of documents; the domain of chunks is their category, see ``p5_totals``."""
    import public_tokenizers

    bpe = budget.byte_bpe(os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = _docs(spark, d).select("doc_id", F.lower(F.trim("source")).alias("source"), budget.language_code(F.col("lang")).alias("language"), "text")
    counted = budget.token_counts(docs, "doc_id", "text", ["source", "language"], bpe)
    return budget.token_budget(counted, ["source", "language"])


def p7_found(spark, d):
    return overlap.overlapping_pairs(read_table(spark, d, "queries"))


def p7_report(spark, d):
    return overlap.overlap_report(read_table(spark, d, "queries"))


def p8_found(spark, d):
    return leakage.leaked_documents(_docs(spark, d), read_table(spark, d, "eval_items"))


def p8_alignments(spark, d):
    return leakage.leaks(_docs(spark, d), read_table(spark, d, "eval_items"))


def p9_found(spark, d):
    return mixing.repeated_sources(_docs(spark, d), read_table(spark, d, "mix_targets"))


def p9_report(spark, d):
    return mixing.mix_sources(_docs(spark, d), read_table(spark, d, "mix_targets"))[1]


def p9_mix(spark, d):
    return mixing.mix_sources(_docs(spark, d), read_table(spark, d, "mix_targets"))[0]


def p10_found(spark, d):
    return encoding.garbled_documents(_docs(spark, d))


def p10_restored(spark, d):
    return encoding.restored_documents(_docs(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_nodes, p1_clean, p2_found, p2_neighbours, p3_found, p3_pieces, p4_found, p4_main_text, p5_found, p5_totals, p5_document_totals,
                            p7_found, p7_report, p8_found, p8_alignments, p9_found, p9_report, p9_mix, p10_found, p10_restored)}
