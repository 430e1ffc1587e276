"""Column expressions shared by the layers. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unknown member, the open end of an interval, the lineage columns.
UNKNOWN_SK = -1
OPEN_END = "9999-12-31"
LINEAGE = ("source_system", "batch_id", "ingested_at", "effective_ts")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_round(c: str | Column, digits: int) -> Column:
    """Half-up rounding through a decimal, so a double's binary tail cannot flip the digit."""
    return F.round(col(c).cast("decimal(38,10)"), digits)


def thousands(c: str | Column) -> Column:
    """Display form: no decimals, thousands separators."""
    return F.format_number(col(c), 0)


def hundredths(c: str | Column) -> Column:
    """An amount with two decimals as a whole number: sums of it do not depend on their order,
    cannot overflow, and cost far less than turning every double into a decimal."""
    return F.floor(col(c) * 100 + 0.5).cast("decimal(20,0)")


def scaled(total: str | Column, digits: int = 2) -> Column:
    """A sum of whole hundredths (or finer parts) back as a double."""
    unit = "0." + "0" * (digits - 1) + "1"
    return (col(total) * F.lit(unit).cast(f"decimal({digits},{digits})")).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that gives NULL, not an error, on zero."""
    return col(num) / F.nullif(col(den), F.lit(0))


def surrogate_key(keys: list[str], start: str | Column) -> Column:
    """Key of one version: hash of the business key and the version's start, both as text."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys], col(start).cast("string"))


def period_date(period: str | Column) -> Column:
    """The middle of a year; NULL (hence the unknown member) for a NULL period."""
    return F.make_date(col(period).cast("int"), F.lit(7), F.lit(1))


def interval_holds(at: Column, start: Column, end: Column) -> Column:
    """``at`` in [start, end), an absent end being open."""
    return (at >= start) & (end.isNull() | (at < end))


def event_metric(details: str | Column, path: str = "$.flow_progress.metrics.num_output_rows") -> Column:
    return F.get_json_object(col(details), path).cast("long")
