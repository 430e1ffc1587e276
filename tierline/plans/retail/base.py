"""Shared tables of the retail warehouse, and the register of queries."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.columns import exact_round, hundredths, ratio, scaled
from tierline.operators import history as hist
from tierline.operators.star import build_fact, dim_year
from tierline.session import shared_dir, tune
from tierline.sources.lake import Lake, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- history: an order is an observed state of its customer ----------------------------------


def history(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return hist.scd2(
        table(spark, sf_dir, "orders"),
        keys=["o_custkey"],
        seq="o_orderdate",
        tracked=["o_orderpriority"],
        carried=["o_totalprice"],
        tiebreak=["o_orderkey"],
        **kw,
    )


# ---- the star that reports read: built once, again when its input has changed ----------------

#: Changed when the tables of the star are computed in another way.
LAYOUT = 2


def star(spark: SparkSession) -> Lake:
    return Lake(spark, f"{shared_dir(spark).rstrip('/')}/retail-star")


def fingerprint(spark: SparkSession, sf_dir: str, tables: list[str]) -> dict:
    """What a table of the star is made from: the files of its input tables, from their listing."""
    found = [f for t in tables for f in (*files(spark, f"{sf_dir}/{t}.parquet"), *files(spark, f"{sf_dir}/{t}.parquet/*"))]
    return {"layout": LAYOUT, "files": [[f.path, f.size, f.modified] for f in found]}


def published(spark: SparkSession, sf_dir: str, name: str, tables: list[str], build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
    """A table of the star for one input folder."""
    place = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    return star(spark).materialized("gold", f"{name}-{place}", fingerprint(spark, sf_dir, tables), build, by)


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published dimension."""
    return published(spark, sf_dir, "dim_customer", ["orders"],
                     lambda: hist.with_surrogate_key(history(spark, sf_dir), ["o_custkey"], "customer_sk"))


H = """
hd AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders),
hc AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR o_orderpriority IS DISTINCT FROM lag(o_orderpriority) OVER w
                      THEN 1 ELSE 0 END AS opens
       FROM hd WHERE rn = 1 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
hv AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY o_orderdate ROWS UNBOUNDED PRECEDING) AS ver FROM hc),
hg AS (SELECT o_custkey, ver, max(o_orderpriority) AS o_orderpriority, arg_max(o_totalprice, o_orderdate) AS o_totalprice,
              min(o_orderdate) AS start_at, arg_min(o_orderdate, o_orderdate) AS first_row FROM hv GROUP BY o_custkey, ver),
h AS (SELECT o_custkey, o_orderpriority, o_totalprice, start_at AS "__START_AT",
             lead(start_at) OVER (PARTITION BY o_custkey ORDER BY ver) AS "__END_AT" FROM hg)
"""


# ---- fact: order lines bound to their customer's version at the ship date --------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their customer: merged by order at any size, which also lets the later shuffle of them compress better."""
    return table(spark, sf_dir, "lineitem").join(_orders(spark, sf_dir).hint("merge"), "l_orderkey")


def bind(spark: SparkSession, rows: DataFrame, dim: DataFrame, at: str, attrs: tuple[str, ...] = (), leave_out=()) -> DataFrame:
    return build_fact(
        rows, dim, dim_year(spark), "o_custkey", F.col(at), F.year(at), "customer_sk",
        attrs=attrs, leave_out=tuple(leave_out),
    )


def sales_fact(spark: SparkSession, sf_dir: str, dim: DataFrame, attrs: tuple[str, ...] = ()) -> DataFrame:
    return bind(spark, order_lines(spark, sf_dir), dim, "l_shipdate", attrs)


FACT = H + """,
f AS (SELECT l.*, o.o_custkey, h."__START_AT" AS start_at, h.o_orderpriority AS priority,
             CAST(year(l.l_shipdate) AS INTEGER) AS year_sk
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
      LEFT JOIN h ON h.o_custkey = o.o_custkey AND l.l_shipdate >= h."__START_AT"
                 AND (h."__END_AT" IS NULL OR l.l_shipdate < h."__END_AT"))
"""

FLAGS = ("R", "A", "N")


def _sums() -> list[Column]:
    """Counts and whole-number sums of lines whose amounts are whole hundredths; revenue counts ten-thousandths."""
    flag = F.col("l_returnflag")

    def exact(c: Column) -> Column:
        return c.cast("decimal(20,0)")

    quantity, price, discount = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    out = [
        F.count(F.lit(1)).alias("lines"),
        F.sum(exact(quantity)).alias("quantity"),
        F.sum(exact(price)).alias("price"),
        F.sum(exact(price * (100 - discount))).alias("revenue"),
    ]
    for f in FLAGS:
        out.append(F.count_if(flag == f).alias(f"lines_{f.lower()}"))
        mine = F.when(flag == f, exact(quantity))
        out.append(F.coalesce(F.sum(mine), F.lit(0)).alias(f"quantity_{f.lower()}"))
    return out


def nation_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per nation and year, of lines whose customer is known when they ship.

    Versions of a customer follow each other without a gap, so a line has one if the first has started. An order
    takes its customer's nation and that start along; lines are then moved once, by order, as whole numbers, and added up
    where they meet it. Sums per version would be nearly as many as the lines.
    """
    since = dimension(spark, sf_dir).groupBy("o_custkey").agg(F.min(hist.START).alias("_since"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation_sk")
    )
    orders = _orders(spark, sf_dir).join(since.hint("shuffle_hash"), "o_custkey").join(customers.hint("shuffle_hash"), "o_custkey")
    amounts = [F.floor(F.col(c) * 100 + 0.5).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount")]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", *amounts)
    known = lines.join(orders.hint("shuffle_hash"), "l_orderkey").where(F.col("l_shipdate") >= F.col("_since"))
    n = known.groupBy("nation_sk", F.year("l_shipdate").alias("year_sk")).agg(*_sums())
    flags = [f.lower() for f in FLAGS]
    return n.select(
        "nation_sk",
        "year_sk",
        F.col("lines").cast("long").alias("lines"),
        scaled("quantity").alias("quantity"),
        scaled("revenue", 4).alias("revenue"),
        (scaled("price") / F.col("lines")).alias("avg_price"),
        *[F.col(f"lines_{f}").cast("long").alias(f"lines_{f}") for f in flags],
        *[ratio(scaled(f"quantity_{f}"), f"lines_{f}").alias(f"freq_{f}") for f in flags],
        *[
            exact_round(F.least(F.lit(0.98), F.col(f"lines_{f}") / F.col("lines")), 3).cast("double").alias(f"coverage_{f}")
            for f in flags
        ],
    )


def _sql_flag(f: str) -> str:
    return f"""
       count(*) FILTER (l_returnflag = '{f.upper()}') AS lines_{f},
       CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_returnflag = '{f.upper()}'), 0) AS DOUBLE)
         / nullif(count(*) FILTER (l_returnflag = '{f.upper()}'), 0) AS freq_{f},
       CAST(round(CAST(least(0.98::DOUBLE, CAST(count(*) FILTER (l_returnflag = '{f.upper()}') AS DOUBLE) / count(*)) AS DECIMAL(38,10)), 3) AS DOUBLE)
         AS coverage_{f}"""


NATIONS = FACT + f""",
n AS (SELECT c_nationkey AS nation_sk, year_sk, count(*) AS lines,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price,
       {','.join(_sql_flag(f.lower()) for f in FLAGS)}
      FROM f JOIN customer ON c_custkey = o_custkey WHERE start_at IS NOT NULL GROUP BY ALL),
rl AS (SELECT r_regionkey AS n_regionkey, max(r_name) AS r_name FROM region GROUP BY r_regionkey),
s AS (SELECT n_nationkey, n_name, n_regionkey, r_name, year_sk AS year, n.*
      FROM n JOIN nation ON n_nationkey = nation_sk JOIN rl USING (n_regionkey))
"""


PLACE = ["n_nationkey", "n_name", "n_regionkey", "r_name", "year"]


def build_nation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart rows with nation, region label and year, from the input tables."""
    from tierline.plans.reports import labelled

    nation = table(spark, sf_dir, "nation").withColumn("nation_sk", F.col("n_nationkey"))
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return labelled(
        nation_years(spark, sf_dir), nation, region, dim_year(spark), "nation_sk",
        ["n_nationkey", "n_name"], "n_regionkey", "r_name",
    )


def nation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every report starts from: the mart as published, in one folder per year."""
    inputs = ["lineitem", "orders", "customer", "nation", "region"]
    return published(spark, sf_dir, "mart_nation_years", inputs, lambda: build_nation_rows(spark, sf_dir), "year")
