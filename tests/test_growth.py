"""Plans that are the same at every size: what is moved between tasks grows with the input, not faster."""

from pyspark.sql import functions as F

from tierline.operators import history as hist
from tierline.operators import star
from tierline.operators.asof import temporal_join
from tierline.plans.retail import base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_mart_moves_lines_once_and_no_sums_per_version(spark, sf):
    text = plan(base.nation_years(spark, sf))
    assert "customer_sk" not in text
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # lines and orders by order, orders, customers and first starts by customer, sums by nation and year
    assert sum("(l_orderkey" in m for m in moved) == 2 and sum("_custkey" in m for m in moved) == 3
    assert sum("nation_sk" in m for m in moved) == 1 and len(moved) == 6


def test_lines_meet_orders_by_the_same_join_however_few_they_are(spark, sf):
    text = plan(base.order_lines(spark, sf))
    assert "SortMergeJoin [l_orderkey" in text and "Broadcast" not in text


def test_versions_are_hashed_and_rows_not_sorted_for_them(spark):
    v = spark.createDataFrame([("a", 1, 5, "x"), ("a", 5, None, "y")], f"k string, {hist.START} long, {hist.END} long, label string")
    f = spark.createDataFrame([("a", 0), ("a", 4), ("a", 5), ("b", 9)], "k string, at long")
    joined = temporal_join(f, v, "k", F.col("at"), ["label"])
    text = plan(joined)
    assert "ShuffledHashJoin" in text and "Sort [" not in text
    assert sorted((r["k"], r["at"], r["label"]) for r in joined.collect() if r["label"]) == [("a", 4, "x"), ("a", 5, "y")]
    assert joined.count() == 4


def test_a_fact_moves_no_column_that_can_be_derived_later(spark):
    dim = hist.with_surrogate_key(spark.createDataFrame([("a", 1995)], "code string, y int").select(
        "code", F.make_date("y", F.lit(1), F.lit(1)).alias(hist.START), F.lit(None).cast("date").alias(hist.END)), ["code"], "sk")
    rows = spark.createDataFrame([("a", 1996, 7), ("a", 1990, 8), ("z", 1996, 9)], "code string, period int, v int")
    fact = star.build_fact(rows, dim, star.dim_year(spark), "code", F.make_date("period", F.lit(7), F.lit(1)), F.col("period"), "sk")
    text = plan(fact)
    assert "_year#" not in text.replace("_calendar_year#", "") and " AS _at#" not in text
    assert sorted((r["sk"] == -1, r["year_sk"], r["v"]) for r in fact.collect()) == [(False, 1996, 7), (True, 1990, 8), (True, 1996, 9)]
