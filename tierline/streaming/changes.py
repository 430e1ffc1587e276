"""Change feeds and history kept up to date from them.

The feed is stored by key bucket. A micro-batch writes its rows into the feed, then rebuilds the
histories of the keys it changed from all their rows in the feed and adds them as a delta; other
histories are neither read nor copied. History is a function of the feed, so late, repeated and
unordered changes come out right without a special case, and doing a batch again changes nothing.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from queue import Queue

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from tierline.operators.history import END, START, scd2
from tierline.operators.shaping import typed_select
from tierline.session import HISTORY_BUCKETS, materialize
from tierline.sources.deltas import DeltaTable
from tierline.sources.lake import files, read_or_empty


def change_feed(raw: DataFrame, columns, strict: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed feed, one row per observed state; works on a stream as on a table."""
    return typed_select(raw, columns, strict, extra)


class _RowCounter(StreamingQueryListener):
    """Rows per run of a query. What a query itself remembers goes back 100 batches only."""

    def __init__(self):
        self.rows, self.ended = Counter(), Queue()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.put(str(event.runId))


def run_to_end(spark: SparkSession, writer: DataStreamWriter, patience: float = 300.0) -> int:
    """Run a query until its source is used up; rows taken. Its events arrive in order, the end last."""
    counter = _RowCounter()
    spark.streams.addListener(counter)
    try:
        query = writer.start()
        query.awaitTermination()
        while counter.ended.get(timeout=patience) != str(query.runId):
            pass
        return counter.rows[str(query.runId)]
    finally:
        spark.streams.removeListener(counter)


def run_feed(feed: DataFrame, path: str, checkpoint: str) -> int:
    """Append a streaming feed to a table until its source is used up; rows taken."""
    writer = feed.writeStream.format("parquet").outputMode("append").option("path", path)
    return run_to_end(feed.sparkSession, writer.option("checkpointLocation", checkpoint).trigger(availableNow=True))


@dataclass(frozen=True)
class HistoryTable:
    """A history fed by changes. A batch costs what it changes: it adds the new histories of its keys as a delta."""

    spark: SparkSession
    path: str
    feed_schema: T.StructType
    keys: tuple[str, ...]
    seq: str
    tracked: tuple[str, ...]
    carried: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = ()
    audit: tuple[str, ...] = ()
    buckets: int = HISTORY_BUCKETS
    max_deltas: int = 8

    @property
    def feed_path(self) -> str:
        return f"{self.path}/feed"

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    @property
    def versions(self) -> DeltaTable:
        return DeltaTable(self.spark, f"{self.path}/dim", self.dim_schema(), self.keys, self.buckets, self.max_deltas)

    def build(self, feed: DataFrame) -> DataFrame:
        return scd2(feed, self.keys, self.seq, self.tracked, self.carried, self.tiebreak, self.audit)

    def dim_schema(self) -> T.StructType:
        kinds = {f.name: f.dataType for f in self.feed_schema}
        out = T.StructType([T.StructField(c, kinds[c]) for c in (*self.keys, *self.tracked, *self.carried)])
        out = out.add(START, kinds[self.seq]).add(END, kinds[self.seq])
        for who in ("created_by", "closed_by"):
            for c in self.audit:
                out = out.add(f"{who}_{c}", kinds[c])
        return out

    def feed(self) -> DataFrame:
        stored = T.StructType(list(self.feed_schema.fields))
        return read_or_empty(self.spark, self.feed_path, stored.add("_bucket", T.IntegerType()).add("_batch", T.LongType()))

    def read(self) -> DataFrame:
        return self.versions.read()

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Take one batch. Taking the same batch again changes nothing."""
        rows = changes.select(*self.feed_schema.names)
        for k in (*self.keys, self.seq):
            rows = rows.where(F.col(k).isNotNull())
        # only the partitions of this batch are replaced, so a repeated batch is not doubled
        (
            rows.withColumn("_bucket", self.versions.bucket())
            .withColumn("_batch", F.lit(batch_id).cast("long"))
            .hint("rebalance", "_bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_bucket", "_batch")
            .parquet(self.feed_path)
        )
        # at most ``buckets`` numbers, from the names of the folders just written
        written = files(self.spark, f"{self.feed_path}/_bucket=*/_batch={batch_id}/*")
        touched = sorted({int(f.path.rsplit("/_bucket=", 1)[1].split("/")[0]) for f in written})
        if not touched:
            return
        mine = self.feed().where((F.col("_batch") == batch_id) & F.col("_bucket").isin(touched))
        changed = materialize(self.spark, mine.select(*self.keys).distinct())
        feed = self.feed().where(F.col("_bucket").isin(touched)).drop("_batch", "_bucket")
        self.versions.write(self.build(feed.join(changed, list(self.keys), "left_semi")), changed)

    def run(self, stream: DataFrame, checkpoint: str | None = None) -> int:
        """Apply everything a streaming feed holds, then stop; rows taken."""
        writer = stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint or self.checkpoint)
        return run_to_end(self.spark, writer.trigger(availableNow=True))
