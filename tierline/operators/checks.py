"""Can the result be trusted: row flow, unique keys, grains, orphans, coverage, tallies.

Every check is an aggregate with a partial step before its shuffle; a table is read once for
all counts taken from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import OPEN_END, UNKNOWN_SK, exact_round
from tierline.operators.history import END, START

UNKNOWN_LIMIT_PCT = 50.0  # fixed value: share of unknown members that raises a warning


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def row_flow(layers: dict[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Rows per entity in the raw, typed and fact layer, the share lost on the way, a status."""
    return flow_of_summaries(summaries({}, {}, {}, layers)).drop("at")


def with_flow(rows: DataFrame) -> DataFrame:
    """Share lost and status of (idx, entity, bronze, silver, fact); further columns stay."""
    b, s, f = F.col("bronze"), F.col("silver"), F.col("fact")
    status = (
        F.when((b > 0) & (s == 0), "FAIL").when((s > 0) & (f == 0), "FAIL").when(f > 0, "OK").otherwise("EMPTY")
    )
    return rows.withColumns({
        "dropped": b - s,
        "drop_pct": exact_round(F.lit(100.0) * (b - s) / F.nullif(b, F.lit(0)), 1).cast("double"),
        "status": status,
    })


def dim_sanity(dim: DataFrame, sk: str, keys: list[str]) -> DataFrame:
    """Duplicated surrogate keys, and business keys with more than one open version: one scan, one shuffle."""
    key = F.to_json(F.struct(*keys)) if len(keys) > 1 else F.col(keys[0]).cast("string")
    ids = dim.select(F.inline(F.array(
        F.struct(F.lit(True).alias("of_sk"), F.col(sk).cast("string").alias("id"), F.lit(1).alias("n")),
        F.struct(F.lit(False).alias("of_sk"), key.alias("id"), F.col(END).isNull().cast("int").alias("n")),
    )))
    per_id = ids.groupBy("of_sk", "id").agg(F.sum("n").alias("n")).where("n > 1")
    return per_id.agg(F.count_if("of_sk").alias("duplicated_keys"), F.count_if(~F.col("of_sk")).alias("keys_with_two_open"))


def dim_coverage(dim: DataFrame, keys: list[str]) -> DataFrame:
    end = F.coalesce(F.col(END), F.lit(OPEN_END).cast(dict(dim.dtypes)[END]))
    return dim.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct(*keys).alias("entities"),
        F.min(START).alias("earliest_start"),
        F.max(end).alias("latest_end"),
    )


def resolution_by_year(fact: DataFrame, years: DataFrame, sk: str) -> DataFrame:
    known = F.col(sk) != UNKNOWN_SK
    # counted per year key first; the calendar then joins a handful of rows
    counted = fact.groupBy("year_sk").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(known).alias("resolved")
    )
    return (
        counted.join(F.broadcast(years.select("year_sk", "year")), "year_sk", "left")
        .groupBy("year")
        .agg(F.sum("rows").alias("rows"), F.sum("resolved").alias("resolved"))
        .select(
            "year",
            "rows",
            "resolved",
            (F.col("rows") - F.col("resolved")).alias("unknown"),
            exact_round(F.lit(100) * F.col("resolved") / F.col("rows"), 1).cast("double").alias("pct_resolved"),
        )
    )


def unknown_rate(fact: DataFrame, sk: str, limit: float = UNKNOWN_LIMIT_PCT) -> DataFrame:
    counted = fact.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(sk) == UNKNOWN_SK).alias("unknown")
    )
    pct = exact_round(F.lit(100) * F.col("unknown") / F.nullif(F.col("rows"), F.lit(0)), 1).cast("double")
    return counted.select(
        "rows", "unknown", pct.alias("unknown_pct"),
        F.when(pct > limit, "WARN").otherwise("PASS").alias("result"),
    )


def key_health(raw: DataFrame, key: str, grain: list[str]) -> DataFrame:
    """Rows, rows without a key, and grains on more than one row, from one aggregation."""
    per_grain = raw.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys")
    )
    return per_grain.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum("null_keys"), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("rows") > 1).alias("duplicated_grains"),
    )


# ---- checks as rows -------------------------------------------------------------------------
# Every table is summed up in one row by one grouped pass over it; its checks are read off that row.
# `summaries` computes all these rows in one query, so each table is scanned once, however many checks it has.


def fact_summary(fact: DataFrame, dim: DataFrame, years: DataFrame, sk: str, grain: list[str]) -> DataFrame:
    """One row: rows, doubled grains, rows whose key or year no dimension has, rows on the unknown member.

    The grain holds both keys, so a row per grain is all that meets the dimensions.
    """
    if not {sk, "year_sk"} <= set(grain):
        raise ValueError(f"the grain {grain} lacks {sk} or year_sk")
    per_grain = fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(F.col(sk).alias("_sk")).distinct().withColumn("_there", F.lit(True))
    calendar = years.select(F.col("year_sk").alias("_year")).distinct().withColumn("_dated", F.lit(True))
    met = per_grain.join(known, F.col(sk) == F.col("_sk"), "left").join(F.broadcast(calendar), F.col("year_sk") == F.col("_year"), "left")
    known_member, known_year = F.col(sk) != UNKNOWN_SK, F.col("year_sk") != UNKNOWN_SK

    def rows(when: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("rows"))), F.lit(0)).alias(name)

    return met.agg(
        rows(F.lit(True), "rows"),
        F.count_if(F.col("rows") > 1).alias("doubled"),
        rows(known_member & F.col("_there").isNull(), "no_member"),
        rows(known_year & F.col("_dated").isNull(), "no_year"),
        rows(~known_member, "unknown"),
    )


FACT, DIM, VIEW, LAYERS = "fact", "dimension", "view", "layers"
MEASURED = ("rows", "doubled", "no_member", "no_year", "unknown", "twice_open", "bronze", "silver")


def _measured(rows: DataFrame, kind: str, at: int, name: str) -> DataFrame:
    held = [F.col(c).cast("long").alias(c) if c in rows.columns else F.lit(None).cast("long").alias(c) for c in MEASURED]
    return rows.select(F.lit(kind).alias("kind"), F.lit(at).alias("at"), F.lit(name).alias("name"), *held)


def summaries(facts: dict[str, tuple], dims: dict[str, tuple], views: dict[str, DataFrame], layers: dict[str, tuple]) -> DataFrame:
    """One row per table: facts are (fact, dimension, years, key, grain), dimensions (rows, key, business key),
    layers the raw and the typed rows of an entity, with its fact's rows where they are not among `facts`."""
    parts = [_measured(fact_summary(*f), FACT, i, n) for i, (n, f) in enumerate(facts.items())]
    for i, (name, (dim, sk, key)) in enumerate(dims.items()):
        sane = dim_sanity(dim, sk, [key]).withColumnsRenamed({"duplicated_keys": "doubled", "keys_with_two_open": "twice_open"})
        parts.append(_measured(sane, DIM, i, name))
    parts += [_measured(_count(v).withColumnRenamed("n", "rows"), VIEW, i, n) for i, (n, v) in enumerate(views.items())]
    for i, (name, tables) in enumerate(layers.items()):
        for column, t in zip(("bronze", "silver", "rows"), tables):
            parts.append(_measured(_count(t).withColumnRenamed("n", column), LAYERS, i, name))
    return combine(parts)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _verdict(stage: int, part: int, name: Column, ok: Column, detail: Column, otherwise: str = "FAIL") -> Column:
    result = F.when(ok, "PASS").otherwise(otherwise)
    return F.struct(F.lit(stage).alias("stage"), F.lit(part).alias("part"), name.alias("check"), result.alias("result"), detail.alias("detail"))


def run_checks(runs: DataFrame) -> DataFrame:
    """How the newest run ended and what it wrote. A run that found nothing new is as good as a success."""
    run = runs.agg(F.max_by(F.struct("status", "rows_written"), "started_at").alias("r"))
    state, rows = F.coalesce("r.status", F.lit("no run yet")), F.coalesce("r.rows_written", F.lit(0))
    return run.select(F.inline(F.array(
        _verdict(0, 0, F.lit("newest run ended well"), state.isin("SUCCESS", "NO_OP"), state),
        _verdict(0, 1, F.lit("newest run wrote rows"), (rows > 0) | (state == "NO_OP"), _text(rows), "WARN"),
    ))).withColumn("at", F.lit(0))


def table_checks(measured: DataFrame, unknown_limit: float = UNKNOWN_LIMIT_PCT) -> DataFrame:
    """The checks of all tables, from their summaries."""
    n, name = F.col, F.col("name")
    pct = exact_round(F.lit(100) * n("unknown") / F.nullif(n("rows"), F.lit(0)), 1).cast("double")
    of_fact = F.array(
        _verdict(3, 0, F.concat(name, F.lit(" has one row per grain")), n("doubled") == 0, F.concat(F.lit("doubled: "), _text("doubled"))),
        _verdict(3, 1, F.concat(name, F.lit(" refers to members and years that exist")), (n("no_member") == 0) & (n("no_year") == 0),
                 F.concat(F.lit("rows without member: "), _text("no_member"), F.lit(", without year: "), _text("no_year"))),
        _verdict(3, 2, F.concat(name, F.lit(" knows its members")), ~F.coalesce(pct > unknown_limit, F.lit(False)),
                 F.concat(F.lit("unknown %: "), F.coalesce(_text(pct), F.lit("-"))), "WARN"),
    )
    of_dim = F.array(
        _verdict(2, 0, F.concat(name, F.lit(" has one row per surrogate key")), n("doubled") == 0, F.concat(F.lit("doubled: "), _text("doubled"))),
        _verdict(2, 1, F.concat(name, F.lit(" has one open version per key")), n("twice_open") == 0, F.concat(F.lit("open twice: "), _text("twice_open"))),
    )
    of_view = F.array(_verdict(4, 0, F.concat(name, F.lit(" answers")), n("rows") > 0, F.concat(F.lit("rows: "), _text("rows")), "WARN"))
    alone = measured.where(F.col("kind") != LAYERS)
    found = alone.select("at", F.inline(F.when(F.col("kind") == FACT, of_fact).when(F.col("kind") == DIM, of_dim).otherwise(of_view)))
    flow = flow_of_summaries(measured).drop("at")
    return found.unionByName(flow_checks(flow).withColumnRenamed("idx", "at"))


def flow_of_summaries(measured: DataFrame) -> DataFrame:
    """The row flow of the measured entities; an entity's fact is called ``fact_<entity>``."""
    layers = measured.where(F.col("kind") == LAYERS).groupBy("name").agg(
        F.max("at").alias("at"), F.max("bronze").alias("bronze"), F.max("silver").alias("silver"), F.max("rows").alias("own"))
    facts = measured.where(F.col("kind") == FACT).select(F.col("name").alias("_fact"), "rows")
    rows = layers.join(facts, F.col("_fact") == F.concat(F.lit("fact_"), "name"), "left")
    return with_flow(rows.select("at", (F.col("at") + 1).alias("idx"), F.col("name").alias("entity"), "bronze", "silver", F.coalesce("own", "rows", F.lit(0)).alias("fact")))


def flow_checks(flow: DataFrame) -> DataFrame:
    """The row flow as checks: one per entity."""
    result = F.when(F.col("status") == "OK", "PASS").when(F.col("status") == "FAIL", "FAIL").otherwise("WARN")
    detail = F.concat(_text("bronze"), F.lit(" > "), _text("silver"), F.lit(" > "), _text("fact"))
    return flow.select("idx", F.lit(1).alias("stage"), F.lit(0).alias("part"), F.concat("entity", F.lit(" flows through all layers")).alias("check"),
                       result.alias("result"), detail.alias("detail"))


def report(runs: DataFrame, measured: DataFrame, unknown_limit: float = UNKNOWN_LIMIT_PCT) -> DataFrame:
    """All checks, by stage (run, flow, dimensions, facts, views), table and part."""
    return run_checks(runs).unionByName(table_checks(measured, unknown_limit))


def combine(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def tally(checks: DataFrame) -> DataFrame:
    return checks.groupBy("result").agg(F.count(F.lit(1)).alias("n"))


class VerificationError(RuntimeError):
    """At least one check failed."""


def require_clean(checks: DataFrame) -> None:
    failed = checks.where(F.col("result") == "FAIL").count()
    if failed:
        raise VerificationError(f"{failed} check(s) failed")
