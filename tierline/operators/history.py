"""Type 2 history from a feed of observed states.

A feed holds one row per observed state of a key, ordered by a sequence column. Consecutive
states with equal tracked columns make one version; untracked columns take the value of the
version's last row. The result depends on the feed only, so late, repeated and unordered
arrivals need no path of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import surrogate_key
from tierline.operators import skew
from tierline.operators.shaping import dedup_latest
from tierline.session import materialize

# Names of the validity columns.
START, END = "__START_AT", "__END_AT"


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _plain(feed: DataFrame, keys, seq, tracked, last_cols, first_cols, tiebreak) -> DataFrame:
    """One shuffle and one sort: every window below shares partitioning and ordering."""
    ties = [F.col(c).asc_nulls_first() for c in tiebreak]
    by_row = Window.partitionBy(*keys).orderBy(F.col(seq).asc_nulls_first(), *ties)
    by_seq = Window.partitionBy(*keys).orderBy(F.col(seq).asc_nulls_first())
    state = F.struct(*[F.col(c) for c in tracked])

    rows = feed.withColumn("_next_seq", F.lead(seq).over(by_row))
    rows = rows.where(F.col("_next_seq").isNull() | (F.col("_next_seq") != F.col(seq))).drop("_next_seq")
    rows = rows.withColumn("_before", F.lag(state).over(by_seq))
    rows = rows.withColumn("_opens", F.col("_before").isNull() | ~_same(F.col("_before"), state)).drop("_before")
    rows = rows.withColumn("_closes", F.coalesce(F.lead("_opens").over(by_seq), F.lit(True)))

    # only the first and the last row of each version are left; a next row is then either this
    # version's last one or the next version's first one
    rows = rows.where(F.col("_opens") | F.col("_closes"))
    last = F.struct(*[F.col(c) for c in last_cols], F.lit(True).alias("_there"))
    first = F.struct(F.col(seq).alias("seq"), *[F.col(c) for c in first_cols])
    rows = (
        rows.withColumn("_last_next", F.lead(last).over(by_seq))
        .withColumn("_first_next", F.lead(first).over(by_seq))
        .withColumn("_first_after", F.lead(first, 2).over(by_seq))
        .where("_opens")
    )
    rows = rows.withColumn("_last", F.when(F.col("_closes"), last).otherwise(F.col("_last_next")))
    rows = rows.withColumn("_next", F.when(F.col("_closes"), F.col("_first_next")).otherwise(F.col("_first_after")))
    return rows.select(
        *keys,
        *tracked,
        *[F.col(f"_last.{c}").alias(c) for c in last_cols],
        F.col(seq).alias(START),
        F.col("_next.seq").alias(END),
        *[F.col(c).alias(f"created_by_{c}") for c in first_cols],
        *[F.col(f"_next.{c}").alias(f"closed_by_{c}") for c in first_cols],
    )


def _segmented(rows: DataFrame, keys, seq, tracked, last_cols, first_cols) -> DataFrame:
    """The same history for keys cut into segments. ``rows`` is unique on (keys, seq)."""
    rows = skew.around(rows, keys, [seq], list(dict.fromkeys((*tracked, seq, *first_cols))), "_before", "_after")

    def another(row: str) -> Column:
        same = _same(F.struct(*[F.col(f"{row}.{c}") for c in tracked]), F.struct(*[F.col(c) for c in tracked]))
        return F.col(row).isNull() | ~same

    opens, closes = another("_before"), another("_after")
    # the row after a version's last one is the first of the next version; rows between first and last are left out
    ends = [
        F.col(f"_after.{seq}").alias(END),
        *[F.col(f"_after.{c}").alias(f"closed_by_{c}") for c in first_cols],
    ]
    kept = rows.withColumns({"_opens": opens, "_closes": closes}).where("_opens OR _closes").select(
        *keys, *tracked, *last_cols, F.col(seq).alias(START), skew.SEGMENT, "_opens", "_closes",
        *[F.col(c).alias(f"created_by_{c}") for c in first_cols], *ends,
    )
    kept = materialize(rows.sparkSession, kept)
    closing = [*last_cols, END, *[f"closed_by_{c}" for c in first_cols]]
    columns = [*keys, *tracked, *last_cols, START, END, *[f"{who}_{c}" for who in ("created_by", "closed_by") for c in first_cols]]
    # a version of one row is complete; of the others two rows are left, and the second comes right after the first
    pairs = skew.lead_across(kept.where("NOT (_opens AND _closes)"), keys, [START], F.struct(*closing), "_last").where("_opens")
    longer = pairs.withColumns({c: F.col(f"_last.{c}") for c in closing})
    return kept.where("_opens AND _closes").select(*columns).unionByName(longer.select(*columns))


def scd2(
    feed: DataFrame,
    keys: list[str],
    seq: str,
    tracked: list[str],
    carried: list[str] = (),
    tiebreak: list[str] = (),
    audit: list[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Versions of each key: keys, tracked, carried, ``__START_AT``, ``__END_AT``.

    ``tiebreak`` picks the row (the greatest) among rows of one key and sequence value. For each
    ``audit`` column, ``created_by_<c>`` is its value in the version's first row and
    ``closed_by_<c>`` that in the first row of the next version. Rows without a key or a
    sequence value have no place in a history and are left out.
    """
    keys, tracked, carried = list(keys), list(tracked), list(carried)
    tiebreak, audit = list(tiebreak), list(audit)
    needed = list(dict.fromkeys([*keys, seq, *tracked, *carried, *audit, *tiebreak]))
    feed = feed.select(*needed).where(F.col(seq).isNotNull())
    for k in keys:
        feed = feed.where(F.col(k).isNotNull())

    hot = skew.hot_keys(feed, keys, limit)
    if hot[0] is None:
        return _plain(feed, keys, seq, tracked, carried, audit, tiebreak)

    # hot keys: copies of one state are cut to one before anything else
    cold, hot_rows = skew.apart(feed, hot[0], keys)
    unique = dedup_latest(hot_rows, [*keys, seq], tiebreak or [seq])
    cut = skew.cut(unique, keys, [seq], hot[1], limit)
    return _plain(cold, keys, seq, tracked, carried, audit, tiebreak).unionByName(
        _segmented(cut, keys, seq, tracked, carried, audit)
    )


def with_surrogate_key(dim: DataFrame, keys: list[str], name: str) -> DataFrame:
    return dim.withColumn(name, surrogate_key(keys, START))


def current(dim: DataFrame) -> DataFrame:
    """Open versions under the names consumers use."""
    return aliases(dim).where("is_current")


def aliases(dim: DataFrame) -> DataFrame:
    return dim.withColumnsRenamed({START: "valid_from", END: "valid_to"}).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def overlaps(dim: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Versions that reach past the start of the key's next version, or stay open before it.

    Versions of a hot key are swept in contiguous segments; the first start of a segment is carried to
    the last version of the one before it.
    """
    order = [START, END]
    cold, hot = skew.split_hot(dim, list(keys), order, limit)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    swept = cold.withColumn("next_start", F.lead(START).over(w))
    if hot is not None:
        after = skew.lead_across(hot, list(keys), order, F.struct(START), "_next")
        swept = swept.unionByName(after.withColumn("next_start", F.col(f"_next.{START}")).drop("_next", skew.SEGMENT))
    return swept.where(F.col("next_start").isNotNull() & (F.col(END).isNull() | (F.col(END) > F.col("next_start"))))
