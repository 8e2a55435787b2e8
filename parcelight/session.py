"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan in this package relies on.  AQE splits skewed
# shuffle partitions even where that costs one more exchange, because a hot
# order, seller or product may hold a large share of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(
    app_name: str = "parcelight",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC time, AQE and checkpoint files that are cleaned up."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Largest partition, as shuffled, that a join may hold as a hash table.
_HASHED_PARTITION = "64MB"


@contextmanager
def hash_joins(spark: SparkSession) -> Iterator[None]:
    """Shuffled joins that start in here hash their smaller side where all its partitions are
    small, as AQE finds at run time; sorting both sides is left for the others."""
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, _HASHED_PARTITION)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made in here leave no shuffle files behind when their job ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a folder of its own and a
    cluster session is refused: a machine-local folder would be lost with its
    executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors"
            )
        configured = tempfile.mkdtemp(prefix="parcelight-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
