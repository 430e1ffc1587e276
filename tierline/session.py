"""Session helpers: a tuned session, the shared work folder, per-session settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK_CONF = "tierline.rowsPerTask"
ROWS_PER_TASK = 5_000_000
HISTORY_BUCKETS_CONF = "tierline.historyBuckets"
HISTORY_BUCKETS = 16

# SQL settings every job here counts on; all can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(master: str | None = None, app: str = "tierline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def rows_per_task(spark: SparkSession) -> int:
    """Rows of one key a single task may hold before the key is split."""
    return int(spark.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK)))


def history_buckets(spark: SparkSession) -> int:
    """Key buckets of a new history: the unit of its compaction, so more of them for larger dimensions."""
    return int(spark.conf.get(HISTORY_BUCKETS_CONF, str(HISTORY_BUCKETS)))


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. A temporary one is made on a local master only; elsewhere it must be named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if named is None and not on_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tierline-"))
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder; nothing is deleted or reused."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder and go on from there.

    The table outlives lost executors, is read by column, and its size is known to the planner.
    """
    path = work_dir(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
