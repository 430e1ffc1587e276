"""Registered queries: landing files, incremental ingest, typing, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline import registry
from tierline.functions.columns import UNKNOWN_SK, hundredths
from tierline.operators.checks import combine
from tierline.operators.history import END
from tierline.operators.shaping import dedup_latest, distinct_rows, typed_select
from tierline.plans.pipeline import Pipeline
from tierline.plans.retail.base import query, table
from tierline.session import materialize, work_dir
from tierline.sources.lake import Lake
from tierline.sources.landing import stamp, write_csv
from tierline.streaming.changes import change_feed, run_feed
from tierline.streaming.ingest import Bronze, ingest

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _land(spark, df, label):
    path = work_dir(spark, label)
    write_csv(df, path)
    return path, Bronze(spark, work_dir(spark, f"{label}-bronze"))


@query("bronze_ingest", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, 'SYNTHETIC' AS source_system, 'batch-' || c_mktsegment AS batch_id,
  true AS has_file, true AS has_time FROM customer""")
def bronze_ingest(spark, sf):
    """Headered CSV to the raw table through the file stream: every value as text, plus lineage."""
    batch = F.concat(F.lit("batch-"), F.col("c_mktsegment"))
    landing, bronze = _land(spark, stamp(table(spark, sf, "customer"), batch), "customer")
    ingest(spark, landing, bronze)
    raw = bronze.read()
    return raw.select(
        *CUSTOMER, "source_system", "batch_id",
        F.col("source_file").contains("/").alias("has_file"),
        F.col("ingested_at").isNotNull().alias("has_time"),
    )


@query("bronze_replay", """SELECT 1 AS run, (SELECT count(*) FROM customer) AS new_rows, (SELECT count(*) FROM customer) AS total_rows
  UNION ALL SELECT 2, 0, (SELECT count(*) FROM customer)""")
def bronze_replay(spark, sf):
    """A second run over the same files takes none of them again."""
    landing, bronze = _land(spark, table(spark, sf, "customer"), "replay")
    out = []
    for run in (1, 2):
        taken = ingest(spark, landing, bronze)
        out.append((run, taken.rows, bronze.read().count()))
    return spark.createDataFrame(out, "run int, new_rows long, total_rows long")


@query("bronze_schema_evolution", """SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS v,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS extra FROM customer""")
def bronze_schema_evolution(spark, sf):
    """Files without the new column, with it, and with another column order, in three runs."""
    c = table(spark, sf, "customer")
    k, v, seg = F.col("c_custkey").alias("k"), F.col("c_name").alias("v"), F.col("c_mktsegment")
    path, bronze = work_dir(spark, "evolving"), Bronze(spark, work_dir(spark, "evolving-bronze"))
    # a NULL segment belongs to the last part
    old, mid = (F.coalesce(x, F.lit(False)) for x in (seg == "BUILDING", seg.isin("MACHINERY", "FURNITURE")))
    for i, part in enumerate((
        c.where(old).select(k, v),
        c.where(mid).select(k, v, seg.alias("extra")),
        c.where(~old & ~mid).select(v, seg.alias("extra"), k),
    )):
        write_csv(part, f"{path}/{i}")
        ingest(spark, path, bronze)
    return bronze.read().select("k", "v", "extra")


@query("no_op_run", """SELECT 1 AS run, count(*) AS rows, 'SUCCESS' AS status FROM events UNION ALL SELECT 2, 0, 'NO_OP'
  UNION ALL SELECT 3, count(*), 'SUCCESS' FROM customer""")
def no_op_run(spark, sf):
    """A run with nothing new is a NO_OP; the next new file is picked up again."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    landing, bronze = _land(spark, events, "noop")
    runs = [ingest(spark, landing, bronze), ingest(spark, landing, bronze)]
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_name"), landing)
    runs.append(ingest(spark, landing, bronze))
    out = [(i, t.rows, "SUCCESS" if t.rows else "NO_OP") for i, t in enumerate(runs, 1)]
    return spark.createDataFrame(out, "run int, rows long, status string")


@query("landing_stamp", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS period, 'SYNTHETIC' AS source_system,
  'load-' || o_orderstatus AS batch_id, CAST(year(o_orderdate) AS VARCHAR) || '-07-01T00:00:00' AS effective_ts FROM orders""")
def landing_stamp(spark, sf):
    """Lineage columns and the mid-year effective time, written as headered CSV and read back."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("period"), "o_orderstatus")
    out = stamp(orders, F.concat(F.lit("load-"), F.col("o_orderstatus"))).drop("o_orderstatus")
    path = work_dir(spark, "stamped")
    write_csv(out, path)
    return spark.read.schema("o_orderkey string, period string, source_system string, batch_id string, effective_ts string").option(
        "header", True
    ).csv(path)


FEED = [("o_custkey", "bigint"), ("o_orderpriority", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp")]


@query("change_feed_stream", "SELECT o_custkey, o_orderpriority, o_totalprice, o_orderdate FROM orders")
def change_feed_stream(spark, sf):
    """The typed change feed as a stream, appended to a table in two runs; the second takes what the first has not."""
    orders, root = table(spark, sf, "orders"), work_dir(spark, "states")
    path = work_dir(spark, "changes")
    done = F.coalesce("o_orderstatus", F.lit("")) == "F"
    for i, part in enumerate((orders.where(done), orders.where(~done))):
        part.write.parquet(f"{root}/part={i}")
        stream = spark.readStream.schema(orders.schema).parquet(root)
        run_feed(change_feed(stream, FEED), f"{path}/data", f"{path}/checkpoint")
    feed = spark.read.parquet(f"{path}/data")
    return feed.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("typed_select", """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN NULL ELSE o_orderkey END AS flawed, CAST(o_orderkey AS VARCHAR) AS batch_id FROM orders""")
def typed_select_orders(spark, sf):
    """Text to configured types; what cannot be read as its type becomes NULL; lineage is kept."""
    o = table(spark, sf, "orders")
    text = o.select(
        *[F.col(c).cast("string").alias(c) for c in ("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")],
        F.when(F.col("o_orderstatus").isin("F", "O"), F.lit("x")).otherwise(F.col("o_orderkey").cast("string")).alias("flawed"),
        F.lit("dropped").alias("not_configured"),
        F.col("o_orderkey").cast("string").alias("batch_id"),
    )
    plan = [("o_custkey", "bigint"), ("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_orderdate", "timestamp"),
            ("o_orderpriority", "string"), ("flawed", "bigint")]
    typed = typed_select(text, plan)
    return typed.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


LATEST = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("dedup_latest", f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(c + ' DESC' for c in LATEST)}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_latest_lines(spark, sf):
    return dedup_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LATEST)


@query("distinct_ref", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_ref(spark, sf):
    return distinct_rows(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


ASSEMBLED = f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LATEST)}) AS rn FROM lineitem) WHERE rn = 1),
o AS (SELECT *, o_orderdate + to_microseconds(o_orderkey) AS seen FROM orders),
oc AS (SELECT *, CASE WHEN lag(o_orderkey) OVER w IS NULL OR o_orderpriority IS DISTINCT FROM lag(o_orderpriority) OVER w THEN 1 ELSE 0 END AS opens
       FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY seen)),
ov AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY seen ROWS UNBOUNDED PRECEDING) AS ver FROM oc),
dim AS (SELECT o_custkey, ver, min(seen) AS first_seen, arg_max(o_totalprice, seen) AS price FROM ov GROUP BY ALL),
born AS (SELECT o_custkey, min(first_seen) AS born_at FROM dim GROUP BY 1),
l AS (SELECT o_custkey, l_orderkey, year(l_shipdate) AS period, l_extendedprice AS price, l_returnflag AS flag, l_linenumber = 1 AND year(l_shipdate) = 1996 AS again,
        l_quantity + CASE WHEN l_linenumber = 1 AND year(l_shipdate) = 1996 THEN 1 ELSE 0 END AS quantity FROM d JOIN orders ON o_orderkey = l_orderkey),
j AS (SELECT *, coalesce(quantity BETWEEN 1 AND 45 AND flag IN ('A', 'N', 'R'), false) AS good FROM l),
f AS (SELECT j.*, born_at <= make_timestamp(period, 7, 1, 0, 0, 0) AS known FROM j LEFT JOIN born USING (o_custkey) WHERE good)
SELECT 'bronze' AS layer, 'raw_customer_ref' AS "table", count(*) AS rows, count(o_custkey) AS known, sum(o_orderkey)::BIGINT AS total FROM orders
UNION ALL SELECT 'bronze', 'raw_sales', count(*) + count(*) FILTER (again), count(*) + count(*) FILTER (again), (sum(l_orderkey) + coalesce(sum(l_orderkey) FILTER (again), 0))::BIGINT FROM l
UNION ALL SELECT 'silver', 'customer_ref_changes', count(*), count(o_custkey), sum(o_orderkey)::BIGINT FROM orders
UNION ALL SELECT 'silver', 'sales', count(*), count(o_custkey), sum(CAST(quantity AS DECIMAL(18,2)) * 100)::BIGINT FROM j WHERE good
UNION ALL SELECT 'metadata', 'dq_quarantine_sales', count(*), count(o_custkey), sum(CAST(quantity AS DECIMAL(18,2)) * 100)::BIGINT FROM j WHERE NOT good
UNION ALL SELECT 'gold', 'dim_customer_ref', count(*), count(DISTINCT o_custkey), sum(CAST(price AS DECIMAL(18,2)) * 100)::BIGINT FROM dim
UNION ALL SELECT 'gold', 'dim_year', count(*), count(*) FILTER (y % 5 = 1), sum(y)::BIGINT FROM range(1971, 2031) t(y)
UNION ALL SELECT 'gold', 'fact_sales', count(*), count(*) FILTER (known), sum(CAST(price AS DECIMAL(18,2)) * 100)::BIGINT FROM f
"""


@query("assembled_pipeline", ASSEMBLED)
def assembled_pipeline(spark, sf):
    """Files to facts from the packaged configuration, delivered in two parts, the second with restated lines. Of
    each published table: rows, those that resolve, and an exact sum that does not depend on their order."""
    root = work_dir(spark, "assembled")
    orders = table(spark, sf, "orders")
    refs = orders.select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("orderpriority"),
        F.col("o_totalprice").alias("totalprice"), F.col("o_orderkey").alias("orderkey"),
        # orders of one day get an order among them
        F.timestamp_add("MICROSECOND", F.col("o_orderkey"), F.col("o_orderdate")).alias("effective_ts"),
        (F.coalesce("o_orderstatus", F.lit("")) == "F").alias("early"),
    )
    # lines of one file tie, so each grain is landed once
    lines = dedup_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LATEST)
    lines = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    # once for both deliveries and the restated lines
    sales = materialize(spark, lines.select(
        F.col("o_custkey").alias("custkey"), F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
        F.year("l_shipdate").alias("period"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"), F.col("l_returnflag").alias("returnflag"),
    ))
    restated = sales.where("period = 1996 AND linenumber = 1").withColumn("quantity", F.col("quantity") + 1)
    lake = Lake(spark, f"{root}/lake")
    pipe = Pipeline(lake, registry.load(registry.PACKAGED / "retail.toml"), f"{root}/landing")
    late = F.coalesce(F.col("period") >= 1997, F.lit(True))
    for i, (r, s) in enumerate(((refs.where("early"), sales.where(~late)), (refs.where("NOT early"), sales.where(late).unionByName(restated))), 1):
        write_csv(stamp(r.drop("early"), f"refs-{i}"), f"{root}/landing/customer_ref")
        write_csv(stamp(s, f"sales-{i}"), f"{root}/landing/sales")
        pipe.run(f"run-{i}")

    read = lake.reader()
    number = F.col("orderkey").cast("long")
    known = F.count("custkey")
    return combine([
        _digest(pipe.bronze(pipe.registry["customer_ref"]).read(), "bronze", "raw_customer_ref", known, number),
        _digest(pipe.bronze(pipe.registry["sales"]).read(), "bronze", "raw_sales", known, number),
        _digest(read("silver", "customer_ref_changes"), "silver", "customer_ref_changes", known, number),
        _digest(read("silver", "sales"), "silver", "sales", known, hundredths("quantity")),
        _digest(read("metadata", "dq_quarantine_sales"), "metadata", "dq_quarantine_sales", known, hundredths("quantity")),
        _digest(read("gold", "dim_customer_ref"), "gold", "dim_customer_ref", F.count_if(F.col(END).isNull()), hundredths("totalprice")),
        _digest(read("gold", "dim_year"), "gold", "dim_year", F.count_if("is_census_year"), F.col("year")),
        _digest(read("gold", "fact_sales"), "gold", "fact_sales", F.count_if(F.col("customer_ref_sk") != UNKNOWN_SK), hundredths("extendedprice")),
    ])


def _digest(df, layer, name, known, value):
    found = df.agg(F.count(F.lit(1)).alias("rows"), known.alias("known"), F.sum(value).cast("long").alias("total"))
    return found.select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows", "known", "total")
