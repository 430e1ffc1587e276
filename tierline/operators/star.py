"""Star schema: year dimension, facts with an unknown member, upsert, key checks, label joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.columns import UNKNOWN_SK
from tierline.operators.asof import temporal_join

# First and last year of the year dimension, and the census rhythm.
FIRST_YEAR, LAST_YEAR = 1971, 2030
CENSUS_STEP, CENSUS_OFFSET = 5, 1
# columns a fact never takes over from its measure table
NOT_MEASURES = ("suburb", "postcode", "source_system", "batch_id", "ingested_at", "effective_ts")


def dim_year(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    year = F.col("id").cast("int")
    return spark.range(first, last + 1).select(
        year.alias("year_sk"),
        year.alias("year"),
        (F.floor(year / 10) * 10).cast("int").alias("decade"),
        (year % CENSUS_STEP == CENSUS_OFFSET).alias("is_census_year"),
    )


def build_fact(
    measures: DataFrame,
    dim: DataFrame,
    years: DataFrame,
    key: str,
    at: Column,
    year: Column,
    sk: str,
    dim_key: str | None = None,
    attrs: tuple[str, ...] = (),
    leave_out: tuple[str, ...] = (),
    method: str = "auto",
) -> DataFrame:
    """Measures with the surrogate key of the version valid at ``at`` and that of the year.

    Keys that resolve to nothing become the unknown member. ``attrs`` are further columns to
    take from the version. ``years`` has one row per calendar year, hence is broadcast.
    """
    excluded = {key, *NOT_MEASURES, *leave_out}
    kept = [c for c in measures.columns if c not in excluded]
    lineage = [c for c in ("source_system", "batch_id") if c in measures.columns]
    # date and year are derived on both sides of the shuffle instead of being moved with the rows
    bound = temporal_join(measures, dim, key, at, [sk, *attrs], dim_key, method)
    calendar = years.select(F.col("year_sk"), F.col("year").alias("_calendar_year"))
    bound = bound.join(F.broadcast(calendar), year == F.col("_calendar_year"), "left")
    unknown = F.lit(UNKNOWN_SK)
    return bound.select(
        F.coalesce(F.col(sk), unknown).alias(sk),
        F.coalesce(F.col("year_sk"), unknown).alias("year_sk"),
        *attrs,
        *kept,
        *lineage,
    )


def upsert(existing: DataFrame, incoming: DataFrame, grain: list[str], replaced: DataFrame | None = None) -> DataFrame:
    """Rows of ``incoming`` replace those of ``existing`` with the same grain; the rest stays.

    ``replaced`` names the grains that go, if they are more than those of ``incoming``.
    """
    replaced = incoming if replaced is None else replaced
    return without(existing, replaced, grain).unionByName(incoming)


def without(rows: DataFrame, grains: DataFrame, grain: list[str], how: str = "left_anti") -> DataFrame:
    """Rows whose grain is not (``left_semi``: is) among the given ones, NULL being a value like any other.

    Grains that are given more than once change nothing, so they are not made distinct.
    """
    renamed = grains.select(*[F.col(c).alias(f"_g_{c}") for c in grain])
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(renamed[f"_g_{c}"]) for c in grain])
    return rows.join(renamed, same, how)


def group_label(dim: DataFrame, code: str, name: str) -> DataFrame:
    """One label per code: the greatest name over all versions."""
    return dim.groupBy(code).agg(F.max(name).alias(name))


def star_rows(fact: DataFrame, dim: DataFrame, years: DataFrame, sk: str, take: list[str]) -> DataFrame:
    """Fact ⋈ dimension ⋈ year on surrogate keys; the unknown member drops out."""
    d = dim.select(F.col(sk).alias("_sk"), *take)
    y = F.broadcast(years.select(F.col("year_sk").alias("_year_sk"), "year"))
    return (
        fact.join(d, F.col(sk) == F.col("_sk"))
        .join(y, F.col("year_sk") == F.col("_year_sk"))
        .drop("_sk", "_year_sk")
    )


def drill_across(facts: dict[str, DataFrame], grain: list[str], measures: dict[str, list[Column]]) -> DataFrame:
    """Facts side by side at a shared grain.

    Each is aggregated to the grain first, so that rows sharing a key (above all the unknown
    member's) are never multiplied with each other.
    """
    out = None
    for name, fact in facts.items():
        part = fact.groupBy(*grain).agg(*measures[name])
        out = part if out is None else out.join(part, grain)
    return out


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Known-member keys of a fact that no dimension row has, with their number of rows.

    Rows are counted per key before the join, so a key on very many rows is one row in it.
    """
    used = fact.where(F.col(key) != UNKNOWN_SK).groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return used.join(dim.select(F.col(dim_key or key).alias("_d")), F.col(key) == F.col("_d"), "left_anti")


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``key NOT IN (SELECT right_key ...)`` with SQL's NULL rules, without a broadcast.

    An empty right side keeps everything; otherwise a NULL on the right keeps nothing and a NULL
    on the left is never kept.
    """
    shape = right.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count(right_key).alias("known")).alias("s")
    ).scalar()
    values = right.select(F.col(right_key).alias("_r")).where("_r IS NOT NULL").dropDuplicates()
    empty = shape.getField("n") == 0
    complete = shape.getField("n") == shape.getField("known")
    return left.join(values, F.col(key) == F.col("_r"), "left_anti").where(
        empty | (F.col(key).isNotNull() & complete)
    )
