"""Registered queries: question reports and chart datasets over nation x year."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.functions.columns import hundredths, scaled
from tierline.operators import scoring, star
from tierline.operators.checks import combine
from tierline.operators.scoring import Factor, Mode
from tierline.operators.shaping import top
from tierline.plans import reports
from tierline.plans.retail.base import NATIONS, PLACE, build_nation_rows, nation_rows, query, table
from tierline.session import materialize, work_dir
from tierline.sources.lake import Lake

WITH_S = f"WITH {NATIONS} "
PLACE_SQL = "n_nationkey, n_name, n_regionkey, r_name, year"

# Reference frequencies and weights of the three modes.
MODES = [
    Mode("lines_r", "freq_r", "coverage_r", 6.0, 1.0),
    Mode("lines_a", "freq_a", "coverage_a", 10.0, 0.7),
    Mode("lines_n", "freq_n", "coverage_n", 6.0, 0.4),
]
FACTORS = [
    Factor("Safety", "lines_r", inverted=True),
    Factor("Schools", "freq_a"),
    Factor("Transit", "connectivity_index"),
    Factor("Affordability", "avg_price", inverted=True),
]


def _r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _fmt(expr: str) -> str:
    return f"format('{{:,}}', CAST(round_even({expr}, 0) AS BIGINT))"


Q2_SQL = f""",
b2 AS (SELECT *, 0.0::DOUBLE + lines_r * (freq_r / 6.0::DOUBLE) * coverage_r * 1.0::DOUBLE + lines_a * (freq_a / 10.0::DOUBLE) * coverage_a * 0.7::DOUBLE
          + lines_n * (freq_n / 6.0::DOUBLE) * coverage_n * 0.4::DOUBLE AS raw FROM s WHERE year = (SELECT max(year) FROM s)),
q2 AS (SELECT {PLACE_SQL}, lines_r, lines_a, lines_n, lines_r + lines_a + lines_n AS stops_total, freq_r, freq_a, freq_n, coverage_r, coverage_a, coverage_n,
          {_r('raw', 2)} AS connectivity_raw, {_r('100 * raw / nullif((SELECT max(raw) FROM b2), 0)', 1)} AS connectivity_index FROM b2)
"""
Q5_SQL = f""",
y5 AS (SELECT min(year) AS lo, max(year) AS hi FROM s),
q5 AS (SELECT c.n_nationkey, c.n_name, c.n_regionkey, c.r_name, c.avg_price AS current_median, {_fmt('c.avg_price')} AS current_median_fmt,
         o.avg_price AS earliest_median, {_fmt('o.avg_price')} AS earliest_median_fmt,
         {_r('(c.avg_price - o.avg_price) / nullif(o.avg_price, 0) * 100', 1)} AS pct_growth,
         {_r('(pow(c.avg_price / nullif(o.avg_price, 0), 1.0::DOUBLE / nullif(y5.hi - y5.lo, 0)) - 1) * 100', 1)} AS cagr_pct
       FROM s c JOIN y5 ON c.year = y5.hi JOIN s o ON o.n_nationkey = c.n_nationkey AND o.year = y5.lo)
"""


MEASURES = ["lines", "quantity", "revenue", "avg_price", *(f"{m}_{f}" for m in ("lines", "freq", "coverage") for f in "ran")]


@query("star_build", WITH_S + f"SELECT {PLACE_SQL}, {', '.join(MEASURES)} FROM s")
def star_build(spark, sf):
    """The mart the reports read, built from the input tables and published in a lake of its own."""
    lake = Lake(spark, work_dir(spark, "star"))
    return lake.materialized("gold", "mart_nation_years", {}, lambda: build_nation_rows(spark, sf), "year").select(*PLACE, *MEASURES)


@query("q1", WITH_S + f"SELECT {PLACE_SQL}, lines, {_fmt('lines')} AS lines_fmt, quantity, revenue, {_fmt('revenue')} AS revenue_fmt FROM s")
def q1(spark, sf):
    """Volume profile over all years."""
    return reports.trend(nation_rows(spark, sf), PLACE, ["lines", "quantity", "revenue"], ["lines", "revenue"])


@query("q2", WITH_S + Q2_SQL + "SELECT * FROM q2 ORDER BY connectivity_index DESC")
def q2(spark, sf):
    """Weighted supply of three modes in the newest year, indexed to the best."""
    rows = reports.connectivity(nation_rows(spark, sf), PLACE, MODES)
    return rows.orderBy(F.col("connectivity_index").desc(), "n_nationkey")


@query("q3", WITH_S + f"SELECT {PLACE_SQL}, lines_r FROM s ORDER BY n_name, year")
def q3(spark, sf):
    return reports.trend(nation_rows(spark, sf), PLACE, ["lines_r"]).orderBy("n_name", "year")


@query("q4", WITH_S + f"SELECT {PLACE_SQL}, lines_a, freq_a FROM s WHERE year = (SELECT max(year) FROM s) ORDER BY freq_a DESC")
def q4(spark, sf):
    return reports.newest(nation_rows(spark, sf), PLACE, ["lines_a", "freq_a"]).orderBy(F.col("freq_a").desc())


@query("q5", WITH_S + Q5_SQL + "SELECT * FROM q5 ORDER BY current_median, cagr_pct DESC")
def q5(spark, sf):
    """Price now and its growth between the first and the last year of the data."""
    rows = scoring.growth(nation_rows(spark, sf), "n_nationkey", ["n_name", "n_regionkey", "r_name"], "avg_price")
    return rows.orderBy(F.col("current_median").asc(), F.col("cagr_pct").desc())


@query("q6", WITH_S + f"""SELECT {PLACE_SQL}, avg_price, {_fmt('avg_price')} AS avg_price_fmt, revenue, {_fmt('revenue')} AS revenue_fmt,
  quantity, {_fmt('quantity')} AS quantity_fmt FROM s ORDER BY n_name, year""")
def q6(spark, sf):
    money = ["avg_price", "revenue", "quantity"]
    return reports.trend(nation_rows(spark, sf), PLACE, money, money).orderBy("n_name", "year")


@query("trend_series", WITH_S + "SELECT year, r_name, sum(lines)::BIGINT AS lines FROM s GROUP BY ALL")
def trend_series(spark, sf):
    """Chart series: one measure by year and region."""
    return reports.series(nation_rows(spark, sf).select("r_name", "year", "lines"), "year", "r_name", "lines")


@query("topk", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 100""")
def topk(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return top(lines, [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 100)


@query("dim_label", """SELECT c_nationkey, n_name, max(c_name) AS c_name FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def dim_label(spark, sf):
    """One label per code from a table that has many."""
    label = star.group_label(table(spark, sf, "customer"), "c_nationkey", "c_name")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return label.join(nation, "c_nationkey")


@query("minmax_score", """WITH b AS (SELECT s_nationkey, count(*) AS suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS balance FROM supplier GROUP BY 1),
  x AS (SELECT min(suppliers) AS a, max(suppliers) AS b, min(balance) AS c, max(balance) AS d FROM b)
  SELECT s_nationkey, suppliers, balance,
    CAST(round(CAST(25 * (1 - CAST(suppliers - x.a AS DOUBLE) / nullif(x.b - x.a, 0)) AS DECIMAL(38,10)), 1) AS DOUBLE) AS few,
    CAST(round(CAST(25 * ((balance - x.c) / nullif(x.d - x.c, 0)) AS DECIMAL(38,10)), 1) AS DOUBLE) AS rich FROM b, x""")
def minmax_score(spark, sf):
    """Two factors scaled between the table's extremes, one of them inverted."""
    per = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers"),
        (scaled(F.sum(hundredths("s_acctbal"))) / F.count(F.lit(1))).alias("balance"),
    )
    return scoring.min_max(per, [Factor("few", "suppliers", inverted=True), Factor("rich", "balance")], 25.0)


def _score_sql(col: str, inverted: bool) -> str:
    share = f"(({col} - (SELECT min({col}) FROM m))::DOUBLE / nullif((SELECT max({col}) FROM m) - (SELECT min({col}) FROM m), 0))"
    return _r(f"25 * {'(1 - ' + share + ')' if inverted else share}", 1)


@query("composite_score", WITH_S + Q2_SQL + f""",
  m AS (SELECT a.n_nationkey, a.n_name, a.r_name, a.freq_a, c.lines_r, t.connectivity_index, p.avg_price FROM (SELECT * FROM s WHERE year = (SELECT max(year) FROM s)) a
    LEFT JOIN (SELECT n_nationkey, arg_max(lines_r, year) AS lines_r FROM s GROUP BY 1) c USING (n_nationkey) LEFT JOIN q2 t USING (n_nationkey)
    LEFT JOIN (SELECT n_nationkey, arg_max(avg_price, year) AS avg_price FROM s GROUP BY 1) p USING (n_nationkey))
  SELECT n_name, r_name, 'Safety' AS factor, {_score_sql('lines_r', True)} AS score FROM m
  UNION ALL SELECT n_name, r_name, 'Schools', {_score_sql('freq_a', False)} FROM m
  UNION ALL SELECT n_name, r_name, 'Transit', {_score_sql('connectivity_index', False)} FROM m
  UNION ALL SELECT n_name, r_name, 'Affordability', {_score_sql('avg_price', True)} FROM m""")
def composite_score(spark, sf):
    """Four equally weighted factors per nation, long, adding up to at most 100."""
    rows = nation_rows(spark, sf)
    q2_rows = reports.connectivity(rows, PLACE, MODES)
    newest = reports.newest(rows, PLACE, ["freq_a"])
    # entities only: stored once instead of being derived again for each extreme
    base = materialize(spark, newest.select("n_nationkey", "n_name", "r_name", "freq_a")
        .join(scoring.newest_value(rows, "n_nationkey", "lines_r"), "n_nationkey", "left")
        .join(q2_rows.select("n_nationkey", "connectivity_index"), "n_nationkey", "left")
        .join(scoring.newest_value(rows, "n_nationkey", "avg_price"), "n_nationkey", "left"))
    return scoring.composite(base, ["n_name", "r_name"], FACTORS)


@query("latest_enrich", WITH_S + Q5_SQL + """SELECT n_nationkey, n_name, r_name, current_median, cagr_pct,
  (SELECT arg_max(lines, year) FROM s WHERE s.n_nationkey = q5.n_nationkey) AS lines FROM q5""")
def latest_enrich(spark, sf):
    """Growth rows with each nation's newest volume attached."""
    rows = nation_rows(spark, sf)
    g = scoring.growth(rows, "n_nationkey", ["n_name", "r_name"], "avg_price")
    return reports.with_newest(g, rows, "n_nationkey", "lines").select(
        "n_nationkey", "n_name", "r_name", "current_median", "cagr_pct", "lines"
    )


@query("unpivot_modes", WITH_S + """SELECT n_name, r_name, year, 'Returned' AS mode, lines_r AS stops FROM s
  UNION ALL SELECT n_name, r_name, year, 'Accepted', lines_a FROM s UNION ALL SELECT n_name, r_name, year, 'None', lines_n FROM s""")
def unpivot_modes(spark, sf):
    labels = {"lines_r": "Returned", "lines_a": "Accepted", "lines_n": "None"}
    return reports.modes_long(nation_rows(spark, sf), ["n_name", "r_name", "year"], labels)


SELECTION = {"c_mktsegment": ["BUILDING", "MACHINERY"], "c_nationkey": [1, 2, 3, 5, 8], "year": []}


@query("linked_filter", """WITH t AS (SELECT c_mktsegment, c_nationkey, year(o_orderdate) AS year, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey)
  SELECT 'c_mktsegment' AS field, c_mktsegment AS value, count(*) FILTER (c_nationkey IN (1, 2, 3, 5, 8)) AS associated_rows FROM t GROUP BY ALL
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) FROM t GROUP BY ALL
  UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 2, 3, 5, 8)) FROM t GROUP BY ALL
  UNION ALL SELECT 'selected', 'rows', count(*) FROM t WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 2, 3, 5, 8)""")
def linked_filter(spark, sf):
    """Selections on several fields together; each field's values with what the others leave them."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    t = table(spark, sf, "orders").join(customers, "o_custkey").withColumn("year", F.year("o_orderdate"))
    # one scan: rows counted per combination of the fields, which all filters then read
    counted = materialize(spark, t.groupBy(*SELECTION).agg(F.count(F.lit(1)).alias("rows")))
    parts = [
        scoring.options(counted, f, SELECTION, "rows").select(
            F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), "associated_rows"
        )
        for f in SELECTION
    ]
    picked = scoring.linked(counted, SELECTION).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("associated_rows"))
    parts.append(picked.select(F.lit("selected").alias("field"), F.lit("rows").alias("value"), "associated_rows"))
    return combine(parts)


@query("kpi_counters", """SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities,
  count(DISTINCT year(o_orderdate)) AS years FROM orders""")
def kpi_counters(spark, sf):
    t = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return reports.kpi(t, {"customers": "o_custkey", "priorities": "o_orderpriority", "years": "year"})
