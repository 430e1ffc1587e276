"""Run log, quality results, source registry, health and alerts, as append-only tables.

A run is two events, OPEN and CLOSE; its state is what the newest events say. Nothing is updated
in place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import event_metric
from tierline.registry import Settings, batch_rules
from tierline.sources.lake import Lake, read_or_empty

# Run states.
RUNNING, SUCCESS, NO_OP, FAILED = "RUNNING", "SUCCESS", "NO_OP", "FAILED"

RUN_EVENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("env", T.StringType()),
        T.StructField("trigger", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("batch_ids", T.ArrayType(T.StringType())),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("error_class", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
DQ_RESULTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("rows_evaluated", T.LongType()),
        T.StructField("rows_passed", T.LongType()),
        T.StructField("rows_failed", T.LongType()),
        T.StructField("pass_rate", T.DoubleType()),
        T.StructField("evaluated_at", T.TimestampType()),
    ]
)
PIPELINE_EVENTS = T.StructType(
    [
        T.StructField("origin", T.StructType([T.StructField("update_id", T.StringType())])),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)


def run_state(events: DataFrame) -> DataFrame:
    """One row per run from its events, combined before the shuffle."""
    opened = F.col("event") == "OPEN"

    def newest(c: str, when: Column) -> Column:
        return F.max_by(c, F.when(when, F.col("at"))).alias(c)

    closed = ~opened
    state = events.groupBy("run_id").agg(
        newest("pipeline_name", opened),
        newest("env", opened),
        newest("trigger", opened),
        F.max(F.when(opened, F.col("at"))).alias("started_at"),
        F.max_by(
            F.struct("status", "batch_ids", "rows_read", "rows_written", "error_class", "error_message", "at"),
            F.when(closed, F.col("at")),
        ).alias("close"),
    )
    # a run opened again after its last close is running
    done = F.when(F.col("close.at") >= F.col("started_at"), F.col("close"))
    return state.withColumn("close", done).select(
        "run_id",
        "pipeline_name",
        "env",
        F.coalesce("close.status", F.lit(RUNNING)).alias("status"),
        "trigger",
        F.coalesce("close.batch_ids", F.array().cast("array<string>")).alias("batch_ids"),
        F.col("close.rows_read").alias("rows_read"),
        F.col("close.rows_written").alias("rows_written"),
        "started_at",
        F.col("close.at").alias("ended_at"),
        F.col("close.error_class").alias("error_class"),
        F.col("close.error_message").alias("error_message"),
    )


def with_duration(runs: DataFrame) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    return runs.withColumn("duration_seconds", seconds)


def health(runs: DataFrame, results: DataFrame, settings: Settings) -> DataFrame:
    """Runs, newest first, each with the rules it tripped or let fall below the pass rate."""
    low = (F.col("severity") == "WARN") & (F.col("pass_rate") < settings.warn_pass_rate_threshold)
    tripped = (F.col("severity") == "FATAL") & (F.col("rows_failed") > 0)
    # rules are few per run however many batches ran, so the set stays small
    failing = results.where(low | tripped).groupBy("run_id").agg(
        F.array_sort(F.collect_set("rule_name")).alias("failing_rules"),
        F.max(tripped).alias("fatal_tripped"),
    )
    joined = with_duration(runs).join(failing, "run_id", "left")
    return joined.withColumn("fatal_tripped", F.coalesce("fatal_tripped", F.lit(False)))


def alerts(health_rows: DataFrame, settings: Settings, now: Column) -> DataFrame:
    """Newest run per pipeline and why somebody should look at it."""
    newest = health_rows.groupBy("pipeline_name").agg(
        F.max_by(F.struct("run_id", "status", "started_at", "ended_at", "fatal_tripped", "failing_rules"), "started_at").alias("r")
    )
    r = newest.select("pipeline_name", "r.*")
    hours = F.timestamp_diff("HOUR", F.coalesce("ended_at", "started_at"), now)
    rules = F.coalesce(F.size("failing_rules"), F.lit(0))
    reason = (
        F.when(F.col("status") == FAILED, "run failed")
        .when(F.col("fatal_tripped"), "fatal rule tripped")
        .when(rules > 0, "pass rate below limit")
        .when(hours > settings.freshness_hours, "stale")
    )
    return r.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        "pipeline_name", "run_id", "status", "reason"
    )


def batch_trace(fact: DataFrame, registry: DataFrame) -> DataFrame:
    """Facts with the provenance of the batch that brought them."""
    return fact.join(registry, "batch_id")


def rows_written_by_latest(events: DataFrame) -> DataFrame:
    """Newest update and the rows its flows wrote, from the JSON of the pipeline's events."""
    flow = events.where(F.col("event_type") == "flow_progress")
    per_update = flow.groupBy(F.col("origin.update_id").alias("update_id")).agg(
        F.max("timestamp").alias("last_at"),
        F.coalesce(F.sum(event_metric("details")), F.lit(0)).alias("rows_written"),
    )
    return per_update.agg(F.max_by(F.struct("update_id", "rows_written"), "last_at").alias("r")).select("r.*")


def flow_order(events: DataFrame, *parts: str) -> DataFrame:
    """When the flows of some tables made progress, oldest first."""
    match = F.lit(False)
    for p in parts:
        match = match | F.col("message").like(f"%{p}%")
    return (
        events.where((F.col("event_type") == "flow_progress") & match)
        .orderBy("timestamp")
        .select(F.date_format("timestamp", "HH:mm:ss.SSS").alias("ts"), "message")
    )


@dataclass(frozen=True)
class RunLog:
    """Writer and reader of the run tables of one lake."""

    lake: Lake

    def _append(self, rows: list[tuple], schema: T.StructType, table: str) -> None:
        spark = self.lake.spark
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self.lake.path("metadata", table))

    def open(self, run_id: str, pipeline: str, env: str, trigger: str) -> None:
        now = datetime.now(timezone.utc)
        row = (run_id, "OPEN", now, pipeline, env, trigger, RUNNING, [], None, None, None, None)
        self._append([row], RUN_EVENTS, "run_events")

    def close(self, run_id: str, status: str, batch_ids=(), rows_read: int = 0, rows_written: int = 0,
              error_class: str | None = None, error_message: str | None = None) -> None:
        now = datetime.now(timezone.utc)
        row = (run_id, "CLOSE", now, None, None, None, status, list(batch_ids), rows_read, rows_written, error_class, error_message)
        self._append([row], RUN_EVENTS, "run_events")

    def record_quality(self, run_id: str, loads: list[tuple]) -> None:
        """Quality results of (entity, counts, results per delivered batch). Rules on whole tables have no
        batch; a minimum of rows is one thing to judge, whatever the number of rows."""
        now, rows = datetime.now(timezone.utc), []
        for e, counts, by_batch in loads:
            by_batch.withColumns(
                {"run_id": F.lit(run_id), "entity": F.lit(e.name), "evaluated_at": F.lit(now)}
            ).select(*DQ_RESULTS.names).write.mode("append").parquet(self.lake.path("metadata", "dq_results"))
            for r in batch_rules(e.rules):
                n = 1 if r.type == "row_count_min" else counts["n_whole"]
                failed = counts[f"failed__{r.name}"]
                rate = (n - failed) / n if n else None
                rows.append((run_id, None, e.name, r.name, r.severity, n, n - failed, failed, rate, now))
        if rows:
            self._append(rows, DQ_RESULTS, "dq_results")

    def record_flows(self, run_id: str, rows: dict[str, int]) -> None:
        """Pipeline events: rows written per table."""
        now = datetime.now(timezone.utc)
        events = [
            ((run_id,), "flow_progress", now, f"Completed flow {table}",
             json.dumps({"flow_progress": {"metrics": {"num_output_rows": n}}}))
            for table, n in rows.items()
        ]
        self._append(events, PIPELINE_EVENTS, "pipeline_events")

    def runs(self) -> DataFrame:
        return run_state(read_or_empty(self.lake.spark, self.lake.path("metadata", "run_events"), RUN_EVENTS))

    def dq_results(self) -> DataFrame:
        return read_or_empty(self.lake.spark, self.lake.path("metadata", "dq_results"), DQ_RESULTS)

    def events(self) -> DataFrame:
        return read_or_empty(self.lake.spark, self.lake.path("metadata", "pipeline_events"), PIPELINE_EVENTS)

    def health(self, settings: Settings) -> DataFrame:
        return health(self.runs(), self.dq_results(), settings).orderBy(F.col("started_at").desc())
