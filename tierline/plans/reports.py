"""Question-shaped reports over a star schema, and the datasets charts bind to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import thousands
from tierline.operators import scoring
from tierline.operators.scoring import Factor, Mode
from tierline.operators.shaping import unpivot
from tierline.operators.star import group_label, star_rows


def labelled(fact: DataFrame, dim: DataFrame, groups: DataFrame, years: DataFrame, sk: str,
             entity: list[str], group: str, label: str) -> DataFrame:
    """Fact rows with the entity's columns as of the fact's year, and its group's label."""
    rows = star_rows(fact, dim, years, sk, [*entity, group])
    return rows.join(group_label(groups, group, label), group)


def trend(rows: DataFrame, ids: list[str], measures: list[str], formatted: list[str] = ()) -> DataFrame:
    """Measures of all years; money and large counts a second time, for display."""
    out: list[Column] = [F.col(c) for c in ids]
    for m in measures:
        out.append(F.col(m))
        if m in formatted:
            out.append(thousands(m).alias(f"{m}_fmt"))
    return rows.select(*out)


def newest(rows: DataFrame, ids: list[str], measures: list[str], year: str = "year", of: DataFrame | None = None) -> DataFrame:
    return scoring.latest(rows, year, of).select(*ids, *measures)


def connectivity(rows: DataFrame, ids: list[str], modes: list[Mode], of: DataFrame | None = None) -> DataFrame:
    scored = scoring.connectivity(scoring.latest(rows, of=of), modes)
    return scored.select(
        *ids,
        *[m.count for m in modes],
        "stops_total",
        *[m.frequency for m in modes],
        *[m.coverage for m in modes],
        "connectivity_raw",
        "connectivity_index",
    )


def modes_long(rows: DataFrame, ids: list[str], labels: dict[str, str]) -> DataFrame:
    return unpivot(rows, ids, labels, "mode", "stops")


def with_newest(rows: DataFrame, history: DataFrame, key: str, value: str) -> DataFrame:
    """Attach each entity's newest value of a trend. ``key`` is the business key, not a name."""
    return scoring.enrich(rows, scoring.newest_value(history, key, value), key)


def all_round(base: DataFrame, parts: list[tuple[DataFrame, str]], key: str, ids: list[str], factors: list[Factor]) -> DataFrame:
    """Composite score in long form. ``parts`` are (one row per entity, value column)."""
    for df, value in parts:
        base = base.join(df.select(key, value), key, "left")
    return scoring.composite(base, ids, factors)


def kpi(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct counts, one row."""
    return rows.agg(*[F.count_distinct(c).alias(name) for name, c in columns.items()])


def series(rows: DataFrame, x: str, by: str, value: str) -> DataFrame:
    return rows.groupBy(x, by).agg(F.sum(value).alias(value))
