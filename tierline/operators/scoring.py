"""Scores and growth over report rows. Global extremes are scalar subqueries, never a window
without partitions (which would put all rows into one task)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import exact_round, ratio, thousands


@dataclass(frozen=True)
class Mode:
    """One transport mode: its columns, its reference frequency and its weight."""

    count: str
    frequency: str
    coverage: str
    reference: float
    weight: float


@dataclass(frozen=True)
class Factor:
    """One part of a composite score; ``inverted`` where less is better."""

    label: str
    column: str
    inverted: bool = False


def extremes(df: DataFrame, columns: list[str]) -> Column:
    """One struct with ``min_<c>`` and ``max_<c>`` of the whole table."""
    parts = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.struct(*parts).alias("x")).scalar()


def latest(df: DataFrame, year: str = "year", of: DataFrame | None = None) -> DataFrame:
    """Rows of the newest year (that of ``of``, where given)."""
    return df.where(F.col(year) == (of if of is not None else df).agg(F.max(year)).scalar())


def connectivity(df: DataFrame, modes: list[Mode]) -> DataFrame:
    """Weighted service supply per row, and the same as a share of the best row's (0-100)."""
    raw = F.lit(0.0)
    for m in modes:
        supply = F.col(m.count) * (F.col(m.frequency) / F.lit(m.reference)) * F.col(m.coverage)
        raw = raw + supply * F.lit(m.weight)
    total = sum((F.col(m.count) for m in modes[1:]), F.col(modes[0].count))
    scored = df.withColumn("stops_total", total).withColumn("_raw", raw)
    best = scored.agg(F.max("_raw")).scalar()
    return (
        scored.withColumn("connectivity_raw", exact_round("_raw", 2).cast("double"))
        .withColumn("connectivity_index", exact_round(F.lit(100) * ratio("_raw", best), 1).cast("double"))
        .drop("_raw")
    )


def min_max(df: DataFrame, factors: list[Factor], scale: float, digits: int = 1) -> DataFrame:
    """Each factor's column scaled to 0..``scale`` over the whole table, under the factor's label."""
    x = extremes(df, [f.column for f in factors])
    out = df
    for f in factors:
        low, high = x.getField(f"min_{f.column}"), x.getField(f"max_{f.column}")
        share = ratio(F.col(f.column) - low, high - low)
        share = F.lit(1) - share if f.inverted else share
        out = out.withColumn(f.label, exact_round(F.lit(scale) * share, digits).cast("double"))
    return out


def composite(df: DataFrame, ids: list[str], factors: list[Factor], total: float = 100.0) -> DataFrame:
    """Equally weighted factors, one row per entity and factor, adding up to at most ``total``."""
    scored = min_max(df, factors, total / len(factors))
    return scored.unpivot(ids, [f.label for f in factors], "factor", "score")


def growth(df: DataFrame, key: str, labels: list[str], value: str, year: str = "year") -> DataFrame:
    """First against last year of the whole table, in one pass over the rows.

    An entity without a row in either year drops out.
    """
    x = extremes(df, [year])
    first, last = x.getField(f"min_{year}"), x.getField(f"max_{year}")
    at_last = F.struct(F.col(value).alias("value"), *[F.col(c) for c in labels])
    ends = df.where((F.col(year) == first) | (F.col(year) == last))
    pair = ends.groupBy(key).agg(
        F.max(F.when(F.col(year) == last, at_last)).alias("_cur"),
        F.max(F.when(F.col(year) == first, F.struct(F.col(value).alias("value")))).alias("_old"),
    )
    cur, old = F.col("_cur.value"), F.col("_old.value")
    span = F.nullif(last - first, F.lit(0))
    return pair.where("_cur IS NOT NULL AND _old IS NOT NULL").select(
        key,
        *[F.col(f"_cur.{c}").alias(c) for c in labels],
        cur.alias("current_median"),
        thousands(cur).alias("current_median_fmt"),
        old.alias("earliest_median"),
        thousands(old).alias("earliest_median_fmt"),
        exact_round(ratio(cur - old, old) * 100, 1).cast("double").alias("pct_growth"),
        exact_round((F.pow(ratio(cur, old), F.lit(1.0) / span) - 1) * 100, 1).cast("double").alias("cagr_pct"),
    )


def newest_value(df: DataFrame, key: str, value: str, year: str = "year") -> DataFrame:
    """The value of each entity's own newest year, combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, year).alias(value))


def enrich(df: DataFrame, newest: DataFrame, key: str) -> DataFrame:
    return df.join(newest, key, "left")


# ---- linked filters -------------------------------------------------------------------------


def chosen(selection: dict[str, list]) -> Column:
    """All non-empty selections hold; an empty one asks for nothing."""
    out = F.lit(True)
    for field, values in selection.items():
        if values:
            out = out & F.col(field).isin(*values)
    return out


def linked(df: DataFrame, selection: dict[str, list]) -> DataFrame:
    return df.where(chosen({f: v for f, v in selection.items() if f in df.columns}))


def options(df: DataFrame, field: str, selection: dict[str, list], weight: str | None = None) -> DataFrame:
    """Every value of a field with the number of rows the *other* selections leave it.

    Where ``df`` is already counted per combination of fields, ``weight`` names the count.
    """
    others = {f: v for f, v in selection.items() if f != field and f in df.columns}
    each = F.col(weight) if weight else F.lit(1)
    n = F.sum(F.when(chosen(others), each).otherwise(F.lit(0)))
    return df.groupBy(field).agg(n.cast("long").alias("associated_rows"))
