"""Point-in-time lookup: bind a row to the version of its key that held at its date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import interval_holds
from tierline.operators import skew
from tierline.operators.history import END, START
from tierline.session import materialize

# A key with at most this many versions is resolved by an equi join with an interval condition;
# beyond it, every row would be compared with too many versions of its key.
MAX_VERSIONS_TO_COMPARE = 64


def long_keys(versions: DataFrame, key: str, most: int) -> DataFrame | None:
    """Keys with more than ``most`` versions, or None. Versions are counted per key before they are shuffled."""
    found = versions.groupBy(F.col(key).alias("_long")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    found = materialize(versions.sparkSession, found.where(F.col("_long").isNotNull()).select("_long"))
    n = found.count()
    return None if not n else F.broadcast(found) if n <= skew.MAX_BROADCAST_KEYS else found


def _interval(facts, versions, key, at, version_key, attrs, few: bool = False) -> DataFrame:
    """``few``: no key has many versions, so those of a partition fit into a hash table and the rows need no sort."""
    v = versions.select(
        F.col(version_key).alias("_v_key"),
        F.col(START).alias("_v_start"),
        F.col(END).alias("_v_end"),
        *[F.col(a).alias(f"_v_{a}") for a in attrs],
    )
    holds = (F.col(key) == F.col("_v_key")) & interval_holds(at, F.col("_v_start"), F.col("_v_end"))
    joined = facts.join(v.hint("shuffle_hash") if few else v, holds, "left")
    return joined.select(*facts.columns, *[F.col(f"_v_{a}").alias(a) for a in attrs])


def _merge(facts, versions, key, at, version_key, attrs, limit) -> DataFrame:
    """Versions and rows in one stream per key; a row takes the newest version before it.

    Intervals of a key do not overlap, so this equals the interval condition while touching
    each row once, however many versions the key has.
    """
    clock = dict(versions.dtypes)[START]
    v = versions.select(
        F.col(version_key).alias("_key"),
        F.col(START).alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_spread"),
        F.struct(F.col(END).alias("_end"), *[F.col(a).alias(a) for a in attrs]).alias("_version"),
        F.lit(None).cast(facts.select(F.struct(*facts.columns)).schema[0].dataType).alias("_row"),
    )
    f = facts.select(
        F.col(key).alias("_key"),
        at.cast(clock).alias("_at"),
        F.lit(1).alias("_kind"),
        # rows of one key and date have no order of their own; a number lets them be cut apart
        F.monotonically_increasing_id().alias("_spread"),
        F.lit(None).cast(v.schema["_version"].dataType).alias("_version"),
        F.struct(*[F.col(c) for c in facts.columns]).alias("_row"),
    )
    # rows without a key or a date match nothing and need no shuffle
    loose = f.where(F.col("_key").isNull() | F.col("_at").isNull())
    stream = v.unionByName(f.where(F.col("_key").isNotNull() & F.col("_at").isNotNull()))

    order = ["_at", "_kind"]
    cold, hot = skew.split_hot(stream, ["_key"], [*order, "_spread"], limit)
    w = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = cold.withColumn("_found", F.last("_version", ignorenulls=True).over(w))
    if hot is not None:
        seen = skew.last_known_across(hot, ["_key"], [*order, "_spread"], F.col("_version"), "_found")
        found = found.unionByName(seen.drop(skew.SEGMENT))
    found = found.unionByName(loose.withColumn("_found", F.col("_version")))
    holds = F.col("_found._end").isNull() | (F.col("_at") < F.col("_found._end"))
    return found.where(F.col("_kind") == 1).select(
        "_row.*", *[F.when(holds, F.col(f"_found.{a}")).alias(a) for a in attrs]
    )


def temporal_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: Column,
    attrs: list[str],
    version_key: str | None = None,
    method: str = "auto",
    limit: int | None = None,
    most: int = MAX_VERSIONS_TO_COMPARE,
) -> DataFrame:
    """Left lookup of ``attrs`` from the version of ``key`` valid at ``at``; NULL where none is.

    ``auto`` counts the versions of each key and sends every key its own way: with few versions an equi join
    with an interval condition (a hot key on the row side is then split by adaptive execution), with more
    than ``most`` of them an ordered merge. One key with a long history costs the others nothing.
    """
    version_key = version_key or key
    if method == "auto":
        long = long_keys(versions, version_key, most)
        if long is None:
            return _interval(facts, versions, key, at, version_key, attrs, few=True)
        # computed once: they are read by both ways, and several times to cut the rows of long keys
        facts = materialize(facts.sparkSession, facts)
        of_fact, of_version = F.col(key) == F.col("_long"), F.col(version_key) == F.col("_long")
        short = _interval(facts.join(long, of_fact, "left_anti"), versions.join(long, of_version, "left_anti"), key, at, version_key, attrs, few=True)
        return short.unionByName(
            _merge(facts.join(long, of_fact, "left_semi"), versions.join(long, of_version, "left_semi"), key, at, version_key, attrs, limit))
    if method == "interval":
        return _interval(facts, versions, key, at, version_key, attrs)
    if method == "merge":
        return _merge(facts, versions, key, at, version_key, attrs, limit)
    raise ValueError(f"unknown method {method!r}")
