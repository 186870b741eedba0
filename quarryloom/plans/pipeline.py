"""Stages over DataFrames in one session, with timing, dry runs and a stop at the first failure."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Stage:
    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]


@dataclass
class Result:
    ok: bool = True
    seconds: dict[str, float] = field(default_factory=dict)
    error: str = ""
    tables: dict[str, DataFrame] = field(default_factory=dict)


def run_stages(spark: SparkSession, stages: list[Stage], tables: dict[str, DataFrame], only: list[str] | None = None, dry_run: bool = False) -> Result:
    """Runs the stages in order; each gets all tables so far and adds to them. A failure ends the run and is reported."""
    out = Result(tables=dict(tables))
    for stage in stages:
        if only is not None and stage.name not in only:
            continue
        began = time.perf_counter()
        try:
            if not dry_run:
                out.tables.update(stage.run(spark, out.tables))
        except Exception as e:  # reported to the caller with the stage's name
            return Result(False, out.seconds, f"{stage.name}: {e}", out.tables)
        out.seconds[stage.name] = time.perf_counter() - began
    return out


def ingestion_stages(limit: int = 500, backend: str = "extractive", dim: int = 48) -> list[Stage]:
    """Documents (``path, text``) to chunks with summaries and vectors."""
    from quarryloom.operators.encoders import encode
    from quarryloom.operators.markdown import clean_documents
    from quarryloom.operators.sections import build_chunks
    from quarryloom.operators.summaries import summarise

    return [
        Stage("clean", lambda s, t: {"documents": clean_documents(t["documents"])}),
        Stage("chunk", lambda s, t: {"chunks": build_chunks(t["documents"], limit=limit)}),
        Stage("summarise", lambda s, t: {"chunks": summarise(t["chunks"].withColumn("chunk_summary", F.lit("")), backend)}),
        Stage("embed", lambda s, t: {"chunks": encode(t["chunks"], "content", "embedding", dim=dim)}),
    ]
