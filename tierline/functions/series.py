"""Projections of yearly series: grids, back-casts, ramps, apportionment, binned medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import col, exact_round

# Capped coverage, urbanisation density, smallest area, smallest band share.
COVERAGE_CAP = 0.98
URBAN_DENSITY = 8000.0
MIN_AREA = 0.1
MIN_SHARE = 0.01


def year_grid(entities: DataFrame, first: int | Column, last: int | Column, step: int = 1) -> DataFrame:
    """Every entity x every ``step``-th year, counted back from the last year."""
    lo, hi = (F.lit(v) if isinstance(v, int) else v for v in (first, last))
    aligned = hi - F.floor((hi - lo) / step).cast("int") * step
    return entities.withColumn("period", F.explode(F.sequence(aligned, hi, F.lit(step))))


def backcast(base: str | Column, growth: str | Column, years_back: str | Column) -> Column:
    """The value ``years_back`` years earlier at a constant yearly growth, never negative."""
    return F.greatest(col(base) / F.pow(F.lit(1.0) + col(growth), col(years_back)), F.lit(0.0))


def linear_ramp(base: str | Column, low: float, at: Column, first: Column, last: Column) -> Column:
    """``base`` scaled from ``low`` in the first year to 1 in the last, as a whole number."""
    share = (at - first) / F.greatest(F.lit(1), last - first)
    return exact_round(col(base) * (F.lit(low) + F.lit(1 - low) * share), 0).cast("int")


def coverage(count: str | Column, catchment: float, area: str | Column) -> Column:
    """Share of an area within reach of ``count`` stops, capped."""
    floored = F.greatest(col(area), F.lit(MIN_AREA))
    return exact_round(F.least(F.lit(COVERAGE_CAP), col(count) * F.lit(catchment) / floored), 3)


def urbanisation(population: str | Column, area: str | Column) -> Column:
    floored = F.greatest(col(area), F.lit(MIN_AREA))
    return F.least(F.lit(1.0), (col(population) / floored) / F.lit(URBAN_DENSITY))


def shares(weights: list[Column]) -> list[Column]:
    """Weights floored and scaled to sum to one."""
    floored = [F.greatest(w, F.lit(MIN_SHARE)) for w in weights]
    total = sum(floored[1:], floored[0])
    return [w / total for w in floored]


def apportion(df: DataFrame, total: str, weights: list[str], names: list[str]) -> DataFrame:
    """Whole-number bands that sum to ``total`` exactly: the last takes what rounding leaves."""
    parts = shares([F.col(w) for w in weights])
    head = [exact_round(p * F.col(total), 0).cast("long").alias(n) for p, n in zip(parts[:-1], names)]
    df = df.select("*", *head)
    used = sum((F.col(n) for n in names[1:-1]), F.col(names[0]))
    return df.withColumn(names[-1], F.col(total).cast("long") - used)


def binned_median(counts: list[str], edges: list[float]) -> Column:
    """Median of binned data, linear inside the bin in which the cumulative share passes one half.

    A row holds its bins as columns, so this is a fold over a handful of expressions.
    """
    total = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    half = total * F.lit(0.5)
    out, before = F.lit(None).cast("double"), F.lit(0.0)
    picks = []
    for c, lo, hi in zip(counts, edges, edges[1:]):
        after = before + F.col(c)
        inside = F.lit(float(lo)) + (half - before) / F.nullif(F.col(c), F.lit(0)) * F.lit(float(hi - lo))
        picks.append(F.when((F.col(c) > 0) & (half <= after), inside))
        before = after
    return F.when(total > 0, F.coalesce(*picks, out))


def latest_period(df: DataFrame, period: str = "period") -> DataFrame:
    """Rows of the newest period. The maximum is a scalar subquery, so no window and no join."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def roll_forward(df: DataFrame, factor: float, period: str = "period", keep: tuple[str, ...] = ()) -> DataFrame:
    """The newest period moved on by one: numbers times ``factor``, whole numbers stay whole."""
    out = []
    for f in latest_period(df, period).schema.fields:
        kind = f.dataType.simpleString()
        if f.name == period:
            out.append((F.col(period) + 1).cast(kind).alias(period))
        elif f.name in keep or kind not in ("int", "bigint", "double", "float"):
            out.append(F.col(f.name))
        elif kind in ("int", "bigint"):
            out.append(exact_round(F.col(f.name) * F.lit(factor), 0).cast(kind).alias(f.name))
        else:
            out.append(exact_round(F.col(f.name) * F.lit(factor), 2).cast("double").alias(f.name))
    return latest_period(df, period).select(*out)


def restatement(df: DataFrame, column: str, factor: float, chosen: Column, period: str = "period", digits: int = -3) -> DataFrame:
    """Rows of the newest period that ``chosen`` picks, restated and rounded to thousands."""
    picked = latest_period(df, period).where(chosen)
    scaled = F.round((F.col(column) * F.lit(factor)).cast("decimal(38,10)"), digits).cast("double")
    return picked.withColumn(column, scaled)
