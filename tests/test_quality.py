import pytest
from pyspark.sql import functions as F

from tierline.functions.rules import passes, predicate
from tierline.operators import quality
from tierline.operators.shaping import cast_failures, dedup_latest, typed_select
from tierline.registry import Rule

GRAIN = ["sal_code", "period"]


def verdict(spark, rule, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(passes(rule)).collect()]


def test_rules_tolerate_null_but_not_null_rules_do_not(spark):
    assert verdict(spark, Rule("r", "not_null", "WARN", column="x"), [1, None], "int") == [True, False]
    assert verdict(spark, Rule("r", "in_set", "WARN", column="x", values=("a", "it's")), ["a", "it's", "b", None], "string") == [True, True, False, True]
    assert verdict(spark, Rule("r", "value_range", "WARN", column="x", min=0, max=2), [0, 2, 3, None], "int") == [True, True, False, True]
    assert verdict(spark, Rule("r", "in_set", "WARN", column="x", values=(True,)), [True, False], "boolean") == [True, False]


def test_regex_keeps_its_backslash_and_finds_anywhere(spark):
    assert verdict(spark, Rule("r", "regex_match", "WARN", column="x", pattern=r"^3\d{3}$"), ["3000", "300", "d333", None], "string") == [True, False, False, True]
    assert verdict(spark, Rule("r", "regex_match", "WARN", column="x", pattern=r"\d"), ["a1b", "ab"], "string") == [True, False]


def test_cross_field_that_cannot_be_decided_is_a_violation(spark):
    df = spark.createDataFrame([(5, 5), (5, None), (5, 1)], "a int, b int")
    rule = Rule("r", "cross_field", "WARN", expr="abs(a - b) <= 1")
    assert [r[0] for r in df.select(passes(rule)).collect()] == [True, False, False]
    with pytest.raises(ValueError):
        predicate(Rule("u", "unique", "WARN", columns=("a",)))


def test_newest_row_of_each_grain_is_then_judged(spark):
    rows = [(f"A{k}", 1990 + y, 10 * k + version, version) for k in range(3) for y in range(4) for version in range(k + 1)] + [(None, 1990, 7, 0), (None, 1990, 8, 1)]
    df = spark.createDataFrame(rows, "sal_code string, period int, stops int, version int")
    latest = dedup_latest(df, GRAIN, ["version"])
    assert latest.count() == 3 * 4 + 1
    kept = quality.keep_valid(latest, [Rule("named", "not_null", "WARN", column="sal_code"), Rule("few", "value_range", "WARN", column="stops", min=0, max=15)]).collect()
    assert sorted((r["sal_code"], r["period"], r["stops"]) for r in kept) == [(f"A{k}", 1990 + y, 11 * k) for k in range(2) for y in range(4)]


def test_an_older_valid_row_is_not_revived(spark):
    df = spark.createDataFrame([("S1", 2020, 10, 1), ("S1", 2020, -1, 2)], "sal_code string, period int, v int, ingested_at int")
    rules = [Rule("v_ok", "value_range", "WARN", column="v", min=0, max=100)]
    latest = dedup_latest(df, GRAIN, ["ingested_at"])
    assert quality.keep_valid(latest, rules).count() == 0
    bad = quality.quarantine(latest, rules).collect()
    assert [r["failed_rules"] for r in bad] == [["v_ok"]]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = dedup_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_typed_select(spark):
    df = spark.createDataFrame([("1", "x", "b1", "u"), ("bad", None, "b2", "u")], "n string, t string, batch_id string, unlisted string")
    plan = [("t", "string"), ("n", "int")]
    out = typed_select(df, plan)
    assert out.columns == ["t", "n", "batch_id"]
    assert [tuple(r) for r in out.collect()] == [("x", 1, "b1"), (None, None, "b2")]
    assert df.agg(*cast_failures(df, plan)).first()["cast_failed__n"] == 1
    with pytest.raises(Exception):
        typed_select(df, plan, strict=True).collect()
    # a lineage column that is configured is not added twice
    assert typed_select(df, [("batch_id", "string")]).columns == ["batch_id"]


def test_results_and_breaches(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "x int")
    rules = [Rule("lt8", "value_range", "WARN", column="x", min=0, max=7, fail_if_violation_pct_above=19), Rule("min", "row_count_min", "FATAL", min=11)]
    r = quality.rule_results(df, rules).first()
    assert (r["rows_evaluated"], r["rows_passed"], r["rows_failed"], r["pass_rate"]) == (10, 8, 2, 0.8)
    found = quality.breaches({"n": 10, "failed__lt8": 2}, rules)
    assert {b.rule for b in found} == {"min", "lt8"}
    assert quality.breaches({"n": 11, "failed__lt8": 2}, rules) == []
    with pytest.raises(quality.QualityError):
        quality.enforce({"n": 10}, rules)


def test_empty_table_has_no_pass_rate(spark):
    df = spark.createDataFrame([], "x int")
    r = quality.rule_results(df, [Rule("a", "not_null", "WARN", column="x")]).first()
    assert r["rows_evaluated"] == 0 and r["pass_rate"] is None


def test_unique_counts_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert [(r["k"], r["rows"]) for r in quality.duplicates(df, ["k"]).collect()] == [(None, 2)]


def test_a_minimum_of_rows_is_judged_from_counts_without_reading_the_older_rows(spark):
    read = spark.sparkContext.accumulator(0)

    def pull(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    new = quality.marked(spark.range(3).withColumn("x", F.col("id")), [])
    whole = spark.range(8).withColumn("x", F.col("id") % 4).mapInArrow(pull, "id long, x long")
    counts = quality.marked_counts(new, [Rule("min", "row_count_min", "FATAL", min=9)], whole, 5)
    assert (counts["n"], counts["n_whole"], counts["failed__min"], read.value) == (3, 8, 1, 0)
    counts = quality.marked_counts(new, [Rule("min", "row_count_min", "FATAL", min=8), Rule("x", "unique", "WARN", columns=("x",))], whole, 5)
    assert (counts["n_whole"], counts["failed__min"], counts["failed__x"]) == (8, 0, 4) and read.value > 0
