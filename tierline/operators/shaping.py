"""Typing, deduplication and reshaping of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import LINEAGE
from tierline.registry import cast_plan


def _typed(name: str, kind: str, strict: bool) -> Column:
    c = F.col(name)
    return (c.cast(kind) if strict else c.try_cast(kind)).alias(name)


def cast_to(df: DataFrame, columns, strict: bool = False) -> DataFrame:
    """The configured columns, in configured order and type; everything else is left out."""
    return df.select(*[_typed(c, t, strict) for c, t in cast_plan(columns)])


def typed_select(df: DataFrame, columns, strict: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """``cast_to`` plus the lineage columns that are present and not already configured."""
    plan = cast_plan(columns)
    named = {c for c, _ in plan}
    carried = [c for c in (*LINEAGE, *extra) if c in df.columns and c not in named]
    return df.select(*[_typed(c, t, strict) for c, t in plan], *[F.col(c) for c in carried])


def cast_failures(df: DataFrame, columns) -> list[Column]:
    """One count per column: values present before typing, absent after it."""
    return [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"cast_failed__{c}")
        for c, t in cast_plan(columns)
        if t != "string"
    ]


def failed_casts(columns) -> Column:
    """For each row the names ``cast_failed__<column>`` of the values that typing would lose."""
    lost = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"cast_failed__{c}"))
        for c, t in cast_plan(columns)
        if t != "string"
    ]
    if not lost:
        return F.array().cast("array<string>")
    return F.filter(F.array(*lost), lambda x: x.isNotNull())


def dedup_latest(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the greatest by ``order``, first column first. NULL keys form one group.

    Spark turns ``row_number() = 1`` into a group limit before and after the shuffle, so a group
    of any size leaves one row per task before anything is moved.
    """
    desc = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*desc))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def unpivot(df: DataFrame, ids: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Wide to long in one scan; ``columns`` maps a column to its label."""
    labelled = df.select(*ids, *[F.col(c).alias(label) for c, label in columns.items()])
    return labelled.unpivot(ids, list(columns.values()), name, value)


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).dropDuplicates()


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
