"""Registered queries: projections of yearly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.functions import series
from tierline.functions.columns import exact_round
from tierline.plans.retail.base import NATIONS, nation_rows, query, table

WITH_S = f"WITH {NATIONS} "


def _r(expr: str, digits: int, kind: str = "DOUBLE") -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS {kind})"


@query("roll_forward", WITH_S + f"""SELECT n_nationkey, CAST(year + 1 AS INTEGER) AS year, {_r('lines * 1.06::DOUBLE', 0, 'BIGINT')} AS lines,
  {_r('revenue * 1.06::DOUBLE', 2)} AS revenue FROM s WHERE year = (SELECT max(year) FROM s)""")
def roll_forward(spark, sf):
    """The newest year moved on by one with a uniform uplift."""
    rows = nation_rows(spark, sf).select("n_nationkey", "year", "lines", "revenue")
    return series.roll_forward(rows, 1.06, "year", keep=("n_nationkey",))


@query("restatement", WITH_S + f"""SELECT n_nationkey, n_regionkey, year, {_r('revenue * 1.12::DOUBLE', -3)} AS revenue FROM s
  WHERE year = (SELECT max(year) FROM s) AND n_regionkey IN (1, 3)""")
def restatement(spark, sf):
    """Newest rows of some regions, shocked and rounded to thousands."""
    rows = nation_rows(spark, sf).select("n_nationkey", "n_regionkey", "year", "revenue")
    return series.restatement(rows, "revenue", 1.12, F.col("n_regionkey").isin(1, 3), "year")


@query("year_scaffold", """WITH y AS (SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS lo, CAST(max(year(o_orderdate)) AS INTEGER) AS hi FROM orders GROUP BY 1)
  SELECT o_custkey, CAST(unnest(generate_series(hi - ((hi - lo) // 2) * 2, hi, 2)) AS INTEGER) AS period FROM y""")
def year_scaffold(spark, sf):
    """Every second year of a customer's active span, counted back from its last."""
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")
    )
    return series.year_grid(spans, F.col("lo"), F.col("hi"), 2).select("o_custkey", "period")


def _anchored(spark, sf):
    rows = nation_rows(spark, sf)
    last = series.latest_period(rows, "year").select("n_nationkey", F.col("year").alias("base_year"), "lines", "revenue")
    return series.year_grid(last, F.lit(1990), F.col("base_year"))


GRID = ", g AS (SELECT n_nationkey, year AS base_year, lines, revenue, CAST(unnest(generate_series(1990, year)) AS INTEGER) AS period FROM s WHERE year = (SELECT max(year) FROM s)) "


@query("backcast", WITH_S + GRID + f"SELECT n_nationkey, period, {_r('greatest(revenue / pow(1.0::DOUBLE + 0.06::DOUBLE, base_year - period), 0.0::DOUBLE)', 2)} AS revenue FROM g")
def backcast(spark, sf):
    """Revenue carried back from the newest year at a constant growth."""
    value = series.backcast("revenue", F.lit(0.06), F.col("base_year") - F.col("period"))
    return _anchored(spark, sf).select("n_nationkey", "period", exact_round(value, 2).cast("double").alias("revenue"))


@query("linear_ramp", WITH_S + GRID + f"SELECT n_nationkey, period, {_r('lines * (0.6::DOUBLE + 0.4::DOUBLE * (CAST(period - 1990 AS DOUBLE) / greatest(1, base_year - 1990)))', 0, 'INTEGER')} AS lines FROM g")
def linear_ramp(spark, sf):
    """Volume growing linearly from 60 % to its newest value."""
    ramp = series.linear_ramp("lines", 0.6, F.col("period"), F.lit(1990), F.col("base_year"))
    return _anchored(spark, sf).select("n_nationkey", "period", ramp.alias("lines"))


def _share(c: str) -> str:
    parts = [f"greatest(coverage_{x}, 0.01::DOUBLE)" for x in ("r", "a", "n")]
    return f"greatest(coverage_{c}, 0.01::DOUBLE) / ({' + '.join(parts)})"


@query("band_apportion", WITH_S + f""", b AS (SELECT n_nationkey, year, lines, {_r(_share('r') + ' * lines', 0, 'BIGINT')} AS band_r, {_r(_share('a') + ' * lines', 0, 'BIGINT')} AS band_a FROM s)
  SELECT *, lines - (band_r + band_a) AS band_n FROM b""")
def band_apportion(spark, sf):
    """A total cut into bands by weight; the bands always add up to it."""
    rows = nation_rows(spark, sf)
    out = series.apportion(rows, "lines", ["coverage_r", "coverage_a", "coverage_n"], ["band_r", "band_a", "band_n"])
    return out.select("n_nationkey", "year", "lines", "band_r", "band_a", "band_n")


EDGES = [0, 10, 20, 30, 40, 50]


def _median_sql() -> str:
    cases, before = [], "0.0::DOUBLE"
    for i, lo in enumerate(EDGES[:-1]):
        after = f"({before} + b{i})"
        cases.append(f"WHEN b{i} > 0 AND half <= {after} THEN {lo}.0::DOUBLE + (half - {before}) / nullif(b{i}, 0) * 10.0::DOUBLE")
        before = after
    return "CASE WHEN half > 0 THEN CASE " + " ".join(cases) + " END END"


@query("binned_median", "WITH c AS (SELECT l_suppkey, " + ", ".join(
    f"count(*) FILTER (l_quantity > {lo} AND l_quantity <= {hi}) AS b{i}" for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:]))
) + f" FROM lineitem GROUP BY 1), t AS (SELECT *, (b0 + b1 + b2 + b3 + b4) * 0.5::DOUBLE AS half FROM c) SELECT l_suppkey, {_median_sql()} AS median_quantity FROM t")
def binned_median(spark, sf):
    """Median quantity per supplier from five bins."""
    q = F.col("l_quantity")
    bins = [F.count_if((q > lo) & (q <= hi)).alias(f"b{i}") for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:]))]
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*bins)
    return counted.select("l_suppkey", series.binned_median([f"b{i}" for i in range(5)], EDGES).alias("median_quantity"))


@query("capped_ratio", f"""WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
  SELECT c_custkey, {_r('least(0.98::DOUBLE, n * 2.0::DOUBLE / greatest(abs(c_acctbal) / 100, 0.1::DOUBLE))', 3)} AS coverage,
    {_r('least(1.0::DOUBLE, (CAST(n * 1000 AS DOUBLE) / greatest(abs(c_acctbal) / 100, 0.1::DOUBLE)) / 8000.0::DOUBLE)', 6)} AS urbanisation
  FROM customer JOIN o ON o_custkey = c_custkey""")
def capped_ratio(spark, sf):
    """Capped coverage and density per customer."""
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    area = F.abs("c_acctbal") / 100
    return table(spark, sf, "customer").join(n, "c_custkey").select(
        "c_custkey",
        series.coverage("n", 2.0, area).cast("double").alias("coverage"),
        exact_round(series.urbanisation(F.col("n") * 1000, area), 6).cast("double").alias("urbanisation"),
    )
