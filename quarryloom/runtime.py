"""Session set-up, cut points in a lineage, and the small driver-side helpers that all operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one task may hold at once in an operator that needs its whole partition in memory.
ROWS_PER_TASK = 200_000


def build_session(app: str = "quarryloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine is tuned for; on a cluster, the submitted session is used as it is."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in {**base, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; in a local session without one, a temporary folder that is removed at exit.

    Raises on a cluster that names none: a folder of one machine would be lost with it.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    target = named
    if not target:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        target = tempfile.mkdtemp(prefix="quarryloom-checkpoints-")
        atexit.register(shutil.rmtree, target, ignore_errors=True)
    sc.setCheckpointDir(target)
    return target


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so later stages neither recompute it nor depend on an executor's disk."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df: DataFrame, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    """Number of partitions that keeps ``rows`` within ``per_task`` a task, at least the session's shuffle width."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-rows // per_task))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per ``key``: that with the greatest ``order`` (nulls last), remaining ties by the whole row's hash.

    Rows whose key is null are dropped, as they can't be told apart. Aggregates map-side, so a key that is
    delivered very often reaches one task only once per map task.
    """
    cols = df.columns
    rank = F.struct(F.col(order).isNotNull(), F.col(order), F.xxhash64(*[F.col(c) for c in cols]))
    best = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("__row"))
    return best.select(*[F.col("__row").getField(c).alias(c) for c in cols])
