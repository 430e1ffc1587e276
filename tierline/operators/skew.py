"""Ordered work on keys that may hold a large share of all rows.

A window over a key puts the key's rows into one task. Where a key has more rows than a task
should hold, its rows are cut into contiguous segments by a range shuffle on (key, order), the
window runs per segment, and a small per-segment summary carries the value across the cuts.
The results are the same as those of the plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import materialize, rows_per_task

SEGMENT = "_segment"
# a list of keys longer than this is joined without a broadcast hint
MAX_BROADCAST_KEYS = 100_000
# segments for as many rows as a task may hold: each is sorted in memory, and more tasks share one key
SEGMENTS_PER_LIMIT = 4


def hot_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> tuple[DataFrame | None, int]:
    """Keys with more than ``limit`` rows and their number of rows, or (None, 0).

    Counts are combined before the shuffle and read the key columns only. There cannot be more
    than rows / limit such keys.
    """
    spark = df.sparkSession
    limit = limit or rows_per_task(spark)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)
    if hot.isEmpty():
        return None, 0
    hot = materialize(spark, hot)
    n, rows = hot.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    named = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    return (F.broadcast(named) if n <= MAX_BROADCAST_KEYS else named), rows


def split_hot(
    df: DataFrame, keys: list[str], order: list[str], limit: int | None = None, hot=None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys with a ``_segment`` column (or None).

    The hot part is written to the checkpoint folder once: its segments are the partitions of
    a sampled range shuffle and must not move between two uses.
    """
    names, rows = hot if hot is not None else hot_keys(df, keys, limit)
    if names is None:
        return df, None
    cold, hot_rows = apart(df, names, keys)
    return cold, cut(hot_rows, keys, order, rows, limit)


def apart(df: DataFrame, names: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, rows of the named keys."""
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(names[f"_hot_{k}"]) for k in keys])
    return df.join(names, match, "left_anti"), df.join(names, match, "left_semi")


def cut(df: DataFrame, keys: list[str], order: list[str], rows: int, limit: int | None = None) -> DataFrame:
    """Number the rows' contiguous (key, order) ranges of about ``limit / SEGMENTS_PER_LIMIT`` rows."""
    spark = df.sparkSession
    tasks = max(2, -(-rows * SEGMENTS_PER_LIMIT // (limit or rows_per_task(spark))))
    ranged = df.repartitionByRange(tasks, *[F.col(c).asc_nulls_first() for c in (*keys, *order)])
    return materialize(spark, ranged.withColumn(SEGMENT, F.spark_partition_id()))


def _order(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def _position(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _edges(df: DataFrame, keys: list[str], order: list[str], value: Column, last: bool, known: bool = False) -> DataFrame:
    """Per key and segment the ``value`` of the last (or first) row, as ``_edge``; ``known`` looks at non-NULL values only.

    The extreme of the first order column is found by a hash aggregate; only rows that have it are compared by their
    whole position, which needs a sort. There are at most as many groups as hot keys and segments.
    """
    part, at = [*keys, SEGMENT], F.col(order[0])
    df = df.withColumn("_value", value)
    there = F.col("_value").isNotNull() if known else F.lit(True)
    # NULL comes first
    least = F.when(F.count_if(there & at.isNull()) == 0, F.min(F.when(there, at)))
    far = df.groupBy(*part).agg((F.max(F.when(there, at)) if last else least).alias("_far"))
    far = far.withColumnsRenamed({c: f"_f_{c}" for c in part})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in part])
    near = df.where(there).join(F.broadcast(far), same & at.eqNullSafe(F.col("_far")))
    pick = F.max_by if last else F.min_by
    found = near.groupBy(*part).agg(pick("_value", _position(order)).alias("_edge"))
    same = reduce(lambda a, b: a & b, [F.col(f"_f_{c}").eqNullSafe(F.col(c)) for c in part])
    return far.join(found, same, "left").select(*[F.col(f"_f_{c}").alias(c) for c in part], "_edge")


def _with_edges(df: DataFrame, edges: DataFrame, keys: list[str], name: str) -> DataFrame:
    part = [*keys, SEGMENT]
    renamed = edges.select(*[F.col(c).alias(f"_e_{c}") for c in part], name)
    match = reduce(lambda a, b: a & b, [df[c].eqNullSafe(renamed[f"_e_{c}"]) for c in part])
    # as few as hot keys and segments; the rows stay where they are
    return df.join(F.broadcast(renamed), match, "left").drop(*[f"_e_{c}" for c in part])


def lag_across(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """``value`` of the key's previous row (give a struct: NULL means there is no such row)."""
    inner = Window.partitionBy(*keys, SEGMENT).orderBy(*_order(order))
    across = Window.partitionBy(*keys).orderBy(SEGMENT)
    edges = (
        _edges(df, keys, order, value, last=True)
        .withColumn("_carried", F.lag("_edge").over(across))
        .drop("_edge")
    )
    df = _with_edges(df.withColumn("_inner", F.lag(value).over(inner)), edges, keys, "_carried")
    return df.withColumn(out, F.coalesce("_inner", "_carried")).drop("_inner", "_carried")


def lead_across(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """``value`` of the key's next row (give a struct: NULL means there is no such row)."""
    inner = Window.partitionBy(*keys, SEGMENT).orderBy(*_order(order))
    across = Window.partitionBy(*keys).orderBy(SEGMENT)
    edges = (
        _edges(df, keys, order, value, last=False)
        .withColumn("_carried", F.lead("_edge").over(across))
        .drop("_edge")
    )
    df = _with_edges(df.withColumn("_inner", F.lead(value).over(inner)), edges, keys, "_carried")
    return df.withColumn(out, F.coalesce("_inner", "_carried")).drop("_inner", "_carried")


def around(df: DataFrame, keys: list[str], order: list[str], columns: list[str], before: str, after: str) -> DataFrame:
    """These columns of the key's previous and of its next row as structs, by one shuffle of the rows."""
    value = F.struct(*columns)
    inner = Window.partitionBy(*keys, SEGMENT).orderBy(*_order(order))
    across = Window.partitionBy(*keys).orderBy(SEGMENT)
    ends = {
        before: (F.lag, _edges(df, keys, order, value, last=True)),
        after: (F.lead, _edges(df, keys, order, value, last=False)),
    }
    # column by column: a struct would be moved beside the columns it is made of
    beside = {
        name: F.when(step(F.lit(True)).over(inner), F.struct(*[step(c).over(inner).alias(c) for c in columns]))
        for name, (step, _) in ends.items()
    }
    out = df.withColumns(beside)
    for name, (step, edges) in ends.items():
        carried = edges.withColumn("_carried", step("_edge").over(across)).drop("_edge")
        out = _with_edges(out, carried, keys, "_carried").withColumn(name, F.coalesce(name, "_carried")).drop("_carried")
    return out


def last_known_across(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """The newest non-NULL ``value`` of the key up to and including each row."""
    inner = (
        Window.partitionBy(*keys, SEGMENT).orderBy(*_order(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = (
        _edges(df, keys, order, value, last=True, known=True)
        .withColumn("_carried", F.last("_edge", ignorenulls=True).over(before))
        .drop("_edge")
    )
    seen = df.withColumn("_inner", F.last(value, ignorenulls=True).over(inner))
    df = _with_edges(seen, edges, keys, "_carried")
    return df.withColumn(out, F.coalesce("_inner", "_carried")).drop("_inner", "_carried")
