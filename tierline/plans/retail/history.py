"""Registered queries: history, point-in-time join, facts and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.functions.columns import UNKNOWN_SK, hundredths, scaled
from tierline.operators import checks, star
from tierline.operators import history as hist
from tierline.operators.asof import temporal_join
from tierline.operators.quality import duplicates
from tierline.plans.retail.base import FACT, H, bind, dimension, history, order_lines, query, sales_fact, table
from tierline.session import materialize, work_dir
from tierline.streaming.changes import HistoryTable

WITH_H = f"WITH {H} "
WITH_F = f"WITH {FACT} "
COLS = ["o_custkey", "o_orderpriority", "o_totalprice", hist.START, hist.END]


@query("scd2_build", WITH_H + "SELECT * FROM h")
def scd2_build(spark, sf):
    return history(spark, sf)


@query("scd2_untracked", WITH_H + 'SELECT o_custkey, "__START_AT", o_totalprice FROM h')
def scd2_untracked(spark, sf):
    """Untracked attribute: the value of the version's last row."""
    return history(spark, sf).select("o_custkey", hist.START, "o_totalprice")


@query("scd2_current", WITH_H + """SELECT o_custkey, o_orderpriority, o_totalprice, "__START_AT" AS valid_from,
  "__END_AT" AS valid_to, true AS is_current FROM h WHERE "__END_AT" IS NULL""")
def scd2_current(spark, sf):
    return hist.current(history(spark, sf))


@query("scd2_overlap", WITH_H + """, o AS (SELECT *, lead("__START_AT") OVER (PARTITION BY o_custkey ORDER BY "__START_AT") AS nx FROM h)
  SELECT count(*) AS versions, count(*) FILTER (nx IS NOT NULL AND ("__END_AT" IS NULL OR "__END_AT" > nx)) AS overlapping FROM o""")
def scd2_overlap(spark, sf):
    h = materialize(spark, history(spark, sf))
    return h.agg(F.count(F.lit(1)).alias("versions")).withColumn(
        "overlapping", hist.overlaps(h, ["o_custkey"]).agg(F.count(F.lit(1))).scalar()
    )


@query("scd2_audit", WITH_H + """SELECT o_custkey, "__START_AT", strftime("__START_AT", '%Y-%m') AS created_by_run_id,
  strftime("__END_AT", '%Y-%m') AS closed_by_run_id FROM h""")
def scd2_audit(spark, sf):
    """Which run opened and which closed a version; a run loads one month of orders."""
    feed = table(spark, sf, "orders").withColumn("run_id", F.date_format("o_orderdate", "yyyy-MM"))
    h = hist.scd2(feed, ["o_custkey"], "o_orderdate", ["o_orderpriority"], tiebreak=["o_orderkey"], audit=["run_id"])
    return h.select("o_custkey", hist.START, "created_by_run_id", "closed_by_run_id")


def _table(spark, label):
    feed = "o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double, o_orderkey bigint"
    return HistoryTable(
        spark, work_dir(spark, label), spark.createDataFrame([], feed).schema,
        ("o_custkey",), "o_orderdate", ("o_orderpriority",), ("o_totalprice",), ("o_orderkey",), buckets=8,
    )


def _feed_stream(spark, root, target):
    """The folders below `root` as a stream of states."""
    return spark.readStream.schema(target.feed_schema).parquet(root)


@query("scd2_incremental", WITH_H + "SELECT * FROM h")
def scd2_incremental(spark, sf):
    """Orders arrive by status, one micro-batch each, so every batch reaches back over the whole history."""
    orders, target, root = table(spark, sf, "orders"), _table(spark, "incremental"), work_dir(spark, "feed")
    status = F.coalesce("o_orderstatus", F.lit(""))
    for i, part in enumerate((status == "F", status != "F")):
        orders.where(part).select(*target.feed_schema.names).write.parquet(f"{root}/part={i}")
        target.run(_feed_stream(spark, root, target))
    return target.read().select(*COLS)


@query("scd2_late", WITH_H + "SELECT * FROM h")
def scd2_late(spark, sf):
    """The older half of the orders arrives after the newer half."""
    orders, target = table(spark, sf, "orders"), _table(spark, "late")
    newer = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    target.apply(orders.where(newer), 0)
    target.apply(orders.where(~newer), 1)
    return target.read().select(*COLS)


@query("scd2_replay", WITH_H + "SELECT * FROM h")
def scd2_replay(spark, sf):
    """A batch done twice, then delivered again under another number."""
    orders, target = table(spark, sf, "orders"), _table(spark, "replay")
    for batch in (0, 0, 1):
        target.apply(orders, batch)
    return target.read().select(*COLS)


@query("full_refresh", WITH_H + "SELECT * FROM h")
def full_refresh(spark, sf):
    """Everything replayed into a new table under a new checkpoint."""
    orders, first, root = table(spark, sf, "orders"), _table(spark, "before"), work_dir(spark, "feed")
    orders.select(*first.feed_schema.names).write.parquet(f"{root}/part=0")
    stream = _feed_stream(spark, root, first)
    first.run(stream)
    again = _table(spark, "refreshed")
    again.run(stream)
    return again.read().select(*COLS)


@query("surrogate_key", WITH_H + 'SELECT o_custkey, "__START_AT", count(*) AS sharing FROM h GROUP BY ALL')
def surrogate_key(spark, sf):
    """How many versions share a key: one each."""
    dim = hist.with_surrogate_key(history(spark, sf), ["o_custkey"], "customer_sk")
    per_key = dim.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("sharing"), F.max(F.struct("o_custkey", hist.START)).alias("v")
    )
    return per_key.select("v.o_custkey", F.col(f"v.{hist.START}"), "sharing")


@query("dim_year", """SELECT CAST(y AS INTEGER) AS year_sk, CAST(y AS INTEGER) AS year, CAST((y // 10) * 10 AS INTEGER) AS decade,
  y % 5 = 1 AS is_census_year, count(l_orderkey) AS lines
  FROM range(1971, 2031) t(y) LEFT JOIN lineitem ON year(l_shipdate) = y GROUP BY ALL""")
def dim_year(spark, sf):
    """The year dimension, with the lines shipped in each year."""
    shipped = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count("l_orderkey").alias("lines"))
    return star.dim_year(spark).join(shipped, "year", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


@query("temporal_join", WITH_F + """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice,
  coalesce(priority, 'UNKNOWN') AS priority, start_at FROM f""")
def temporal_join_lines(spark, sf):
    """Every order line with its customer's priority as of the ship date."""
    lines = order_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", "o_custkey"
    )
    h = materialize(spark, history(spark, sf))
    bound = temporal_join(lines, h, "o_custkey", F.col("l_shipdate"), ["o_orderpriority", hist.START])
    return bound.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice",
        F.coalesce("o_orderpriority", F.lit("UNKNOWN")).alias("priority"),
        F.col(hist.START).alias("start_at"),
    )


@query("temporal_join_long_history", WITH_F + """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
  coalesce(priority, 'UNKNOWN') AS priority, start_at FROM f""")
def temporal_join_merged(spark, sf):
    """The same lookup by merging rows and versions: for keys with very many versions."""
    lines = order_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "o_custkey")
    h = materialize(spark, history(spark, sf))
    bound = temporal_join(
        lines, h, "o_custkey", F.col("l_shipdate"), ["o_orderpriority", hist.START], method="merge"
    )
    return bound.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.coalesce("o_orderpriority", F.lit("UNKNOWN")).alias("priority"),
        F.col(hist.START).alias("start_at"),
    )


MIXED = WITH_H + """,
  account AS (SELECT o_orderpriority AS label, o_orderdate + to_microseconds(o_orderkey) AS s,
                lead(o_orderdate + to_microseconds(o_orderkey)) OVER (ORDER BY o_orderdate + to_microseconds(o_orderkey)) AS e FROM orders),
  l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CASE WHEN l_linenumber = 2 THEN -1 ELSE o_custkey END AS account
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  SELECT l.*, o_orderpriority AS label, "__START_AT" AS start_at FROM (SELECT * FROM l WHERE account <> -1) l
    LEFT JOIN h ON o_custkey = account AND l_shipdate >= "__START_AT" AND ("__END_AT" IS NULL OR l_shipdate < "__END_AT")
  UNION ALL SELECT l.*, label, s FROM (SELECT * FROM l WHERE account = -1) l ASOF LEFT JOIN account ON l_shipdate >= s"""


@query("temporal_join_mixed", MIXED)
def temporal_join_mixed(spark, sf):
    """One account that every order gives a new version, among customers with a few versions each: both ways in one plan."""
    orders = table(spark, sf, "orders")
    exact = F.timestamp_add("MICROSECOND", F.col("o_orderkey"), F.col("o_orderdate"))
    everything = hist.scd2(orders.select(F.lit(-1).cast("long").alias("o_custkey"), "o_orderkey", exact.alias("at"), "o_orderpriority"),
                           ["o_custkey"], "at", ["o_orderkey"], ["o_orderpriority"])
    wanted = ["o_custkey", "o_orderpriority", hist.START, hist.END]
    versions = materialize(spark, history(spark, sf).select(*wanted).unionByName(everything.select(*wanted)))
    lines = order_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.when(F.col("l_linenumber") == 2, -1).otherwise(F.col("o_custkey")).cast("long").alias("account"))
    bound = temporal_join(lines, versions, "account", F.col("l_shipdate"), ["o_orderpriority", hist.START], "o_custkey")
    return bound.withColumnsRenamed({"o_orderpriority": "label", hist.START: "start_at"})


@query("fact_build", WITH_F + """SELECT start_at IS NOT NULL AS known, start_at, year_sk, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM f""")
def fact_build(spark, sf):
    """The sales fact; the hashed key is shown as the version start it stands for."""
    fact = sales_fact(spark, sf, dimension(spark, sf), (hist.START,))
    return fact.select(
        (F.col("customer_sk") != UNKNOWN_SK).alias("known"), F.col(hist.START).alias("start_at"), "year_sk",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    )


@query("unknown_rate", WITH_F + """SELECT count(*) AS rows, count(*) FILTER (start_at IS NULL) AS unknown,
  CAST(round(CAST(100 * CAST(count(*) FILTER (start_at IS NULL) AS DOUBLE) / count(*) AS DECIMAL(38,10)), 1) AS DOUBLE) AS unknown_pct,
  CASE WHEN 100.0 * count(*) FILTER (start_at IS NULL) / count(*) > 50 THEN 'WARN' ELSE 'PASS' END AS result FROM f""")
def unknown_rate(spark, sf):
    return checks.unknown_rate(sales_fact(spark, sf, dimension(spark, sf)), "customer_sk")


@query("resolution_by_year", WITH_F + """SELECT year_sk AS year, count(*) AS rows, count(start_at) AS resolved,
  count(*) - count(start_at) AS unknown,
  CAST(round(CAST(100 * CAST(count(start_at) AS DOUBLE) / count(*) AS DECIMAL(38,10)), 1) AS DOUBLE) AS pct_resolved FROM f GROUP BY year_sk""")
def resolution_by_year(spark, sf):
    fact = sales_fact(spark, sf, dimension(spark, sf))
    return checks.resolution_by_year(fact, star.dim_year(spark), "customer_sk")


@query("dim_coverage", WITH_H + """SELECT count(*) AS versions, count(DISTINCT o_custkey) AS entities, min("__START_AT") AS earliest_start,
  max(coalesce("__END_AT", TIMESTAMP '9999-12-31')) AS latest_end FROM h""")
def dim_coverage(spark, sf):
    return checks.dim_coverage(history(spark, sf), ["o_custkey"])


def _customer_years(lines):
    return lines.groupBy("o_custkey", F.year("l_shipdate").alias("year_sk"), F.col("l_linestatus").alias("source_system")).agg(
        F.count(F.lit(1)).alias("lines"), scaled(F.sum(hundredths("l_quantity"))).alias("quantity")
    )


@query("fact_upsert", """WITH e AS (SELECT o_custkey, CAST(year(l_shipdate) AS INTEGER) AS year_sk, l_linestatus AS source_system, count(*) AS lines,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL),
  i AS (SELECT o_custkey, year_sk, source_system, lines + 1 AS lines, quantity * 2 AS quantity FROM e WHERE year_sk >= 2000)
  SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.o_custkey = e.o_custkey AND i.year_sk = e.year_sk AND i.source_system = e.source_system)
  UNION ALL SELECT * FROM i""")
def fact_upsert(spark, sf):
    """Restated periods replace what the fact held for the same grain."""
    existing = materialize(spark, _customer_years(order_lines(spark, sf)))
    incoming = existing.where("year_sk >= 2000").select(
        "o_custkey", "year_sk", "source_system", (F.col("lines") + 1).alias("lines"), (F.col("quantity") * 2).alias("quantity")
    )
    return star.upsert(existing, incoming, ["o_custkey", "year_sk", "source_system"])


@query("drill_across", WITH_F + """,
  fo AS (SELECT o.o_custkey AS k, h."__START_AT" AS start_at, CAST(year(o_orderdate) AS INTEGER) AS year_sk, o.o_totalprice AS total FROM orders o LEFT JOIN h ON h.o_custkey = o.o_custkey
         AND o_orderdate >= h."__START_AT" AND (h."__END_AT" IS NULL OR o_orderdate < h."__END_AT")),
  a AS (SELECT CASE WHEN start_at IS NULL THEN NULL ELSE o_custkey END AS k, start_at, year_sk, count(*) AS lines,
        CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM f GROUP BY ALL),
  b AS (SELECT CASE WHEN start_at IS NULL THEN NULL ELSE o_custkey END AS k, start_at, year_sk, count(*) AS returned_lines FROM f WHERE l_returnflag = 'R' GROUP BY ALL),
  c AS (SELECT CASE WHEN start_at IS NULL THEN NULL ELSE k END AS k, start_at, year_sk, count(*) AS orders,
        CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS total FROM fo GROUP BY ALL)
  SELECT a.k AS o_custkey, a.start_at, a.year_sk, lines, quantity, returned_lines, orders, total FROM a
  JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.start_at IS NOT DISTINCT FROM b.start_at AND a.year_sk = b.year_sk
  JOIN c ON a.k IS NOT DISTINCT FROM c.k AND a.start_at IS NOT DISTINCT FROM c.start_at AND a.year_sk = c.year_sk""")
def drill_across(spark, sf):
    """Sales, returns and orders side by side per version and year."""
    dim = dimension(spark, sf)
    # two of the three facts come from it
    sales = materialize(spark, sales_fact(spark, sf, dim).select("customer_sk", "year_sk", "l_quantity", "l_returnflag"))
    orders = bind(spark, table(spark, sf, "orders"), dim, "o_orderdate")
    n = F.count(F.lit(1))
    rows = star.drill_across(
        {"sales": sales, "returns": sales.where("l_returnflag = 'R'"), "orders": orders},
        ["customer_sk", "year_sk"],
        {
            "sales": [n.alias("lines"), scaled(F.sum(hundredths("l_quantity"))).alias("quantity")],
            "returns": [n.alias("returned_lines")],
            "orders": [n.alias("orders"), scaled(F.sum(hundredths("o_totalprice"))).alias("total")],
        },
    )
    names = dim.select("customer_sk", "o_custkey", F.col(hist.START).alias("start_at"))
    return rows.join(names, "customer_sk", "left").drop("customer_sk")


@query("orphan_keys", WITH_F + """SELECT count(DISTINCT (o_custkey, start_at)) AS orphan_keys, count(*) AS orphan_rows
  FROM f WHERE start_at IS NOT NULL AND priority = '5-LOW'""")
def orphan_keys(spark, sf):
    """Keys left dangling when the versions of one priority are missing from the dimension."""
    dim = dimension(spark, sf)
    lost = star.orphan_keys(sales_fact(spark, sf, dim), dim.where("o_orderpriority <> '5-LOW'"), "customer_sk")
    return lost.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("fact_rows"), F.lit(0)).alias("orphan_rows"))


@query("orphan_keys_not_in", """WITH g AS (SELECT nullif(s_suppkey, 7) AS k FROM supplier), p AS (SELECT s_suppkey AS k FROM supplier WHERE s_acctbal > 0),
  e AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey < 0), l AS (SELECT nullif(l_suppkey, 3) AS k FROM lineitem)
  SELECT 'plain' AS right_side, count(*) AS rows FROM l WHERE k NOT IN (SELECT k FROM p)
  UNION ALL SELECT 'with null', count(*) FROM l WHERE k NOT IN (SELECT k FROM g)
  UNION ALL SELECT 'empty', count(*) FROM l WHERE k NOT IN (SELECT k FROM e)""")
def orphan_keys_not_in(spark, sf):
    """NOT IN with NULLs on either side and with nothing on the right."""
    suppliers = table(spark, sf, "supplier")
    lines = table(spark, sf, "lineitem").select(F.nullif(F.col("l_suppkey"), F.lit(3)).alias("k"))
    sides = {
        "plain": suppliers.where("s_acctbal > 0").select(F.col("s_suppkey").alias("r")),
        "with null": suppliers.select(F.nullif(F.col("s_suppkey"), F.lit(7)).alias("r")),
        "empty": suppliers.where("s_suppkey < 0").select(F.col("s_suppkey").alias("r")),
    }
    return checks.combine([
        star.not_in(lines, "k", right, "r").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("right_side"), "rows")
        for name, right in sides.items()
    ])


@query("grain_duplicates", """WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1)
  SELECT * FROM d""")
def grain_duplicates(spark, sf):
    return duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dim_sanity", WITH_H + """SELECT (SELECT count(*) FROM (SELECT 1 FROM h GROUP BY o_custkey, "__START_AT" HAVING count(*) > 1)) AS duplicated_keys,
  (SELECT count(*) FROM (SELECT o_custkey FROM h WHERE "__END_AT" IS NULL GROUP BY 1 HAVING count(*) > 1)) AS keys_with_two_open""")
def dim_sanity(spark, sf):
    return checks.dim_sanity(dimension(spark, sf), "customer_sk", ["o_custkey"])
