import pytest
from pyspark.sql import functions as F

from tierline.functions import series
from tierline.operators import scoring
from tierline.operators.scoring import Factor, Mode
from tierline.plans import runlog
from tierline.registry import Settings


def test_bands_add_up_and_shares_are_floored(spark):
    df = spark.createDataFrame([(1000, 0.19, 0.12, -5.0), (7, 1.0, 1.0, 1.0), (0, 1.0, 2.0, 3.0)], "total int, a double, b double, c double")
    rows = series.apportion(df, "total", ["a", "b", "c"], ["x", "y", "z"]).collect()
    assert all(r["x"] + r["y"] + r["z"] == r["total"] for r in rows)
    assert rows[0]["z"] == 1000 - 594 - 375


def test_binned_median_is_linear_inside_its_bin(spark):
    df = spark.createDataFrame([(10, 0, 0), (0, 0, 4), (5, 10, 5), (0, 0, 0)], "a int, b int, c int")
    got = [r[0] for r in df.select(series.binned_median(["a", "b", "c"], [0, 10, 20, 40])).collect()]
    assert got == [5.0, 30.0, 15.0, None]


def test_backcast_ramp_and_ratios(spark):
    one = spark.range(1)
    assert one.select(series.backcast(F.lit(121.0), F.lit(0.1), F.lit(2))).first()[0] == pytest.approx(100.0)
    ramp = [one.select(series.linear_ramp(F.lit(10), 0.6, F.lit(y), F.lit(2000), F.lit(2010))).first()[0] for y in (2000, 2005, 2010)]
    assert ramp == [6, 8, 10]
    assert float(one.select(series.coverage(F.lit(3), 2.0, F.lit(0.0))).first()[0]) == 0.98
    assert one.select(series.urbanisation(F.lit(4000.0), F.lit(1.0))).first()[0] == 0.5


def test_year_grid_counts_back_from_the_end(spark):
    df = spark.createDataFrame([("a",)], "k string")
    assert [r["period"] for r in series.year_grid(df, 1971, 2021, 5).collect()] == list(range(1971, 2022, 5))
    assert [r["period"] for r in series.year_grid(df, 2018, 2021, 2).collect()] == [2019, 2021]


def test_roll_forward_and_restatement(spark):
    df = spark.createDataFrame([("a", 2020, 10, 1.0), ("a", 2021, 11, 1.005), ("b", 2021, 3, 123456.0)], "k string, period int, n int, x double")
    out = sorted(tuple(r) for r in series.roll_forward(df, 1.06).collect())
    assert out == [("a", 2022, 12, 1.07), ("b", 2022, 3, 130863.36)]
    shocked = series.restatement(df, "x", 1.12, F.col("k") == "b").collect()
    assert [(r["k"], r["period"], r["x"]) for r in shocked] == [("b", 2021, 138000.0)]


def test_growth_and_missing_ends(spark):
    rows = [("a", "A", 2000, 100.0), ("a", "A", 2010, 200.0), ("b", "B", 2010, 50.0), ("c", "C", 2000, 0.0), ("c", "C", 2010, 5.0), ("a", "A", 2005, 1.0)]
    df = spark.createDataFrame(rows, "k string, name string, year int, v double")
    got = {r["k"]: r for r in scoring.growth(df, "k", ["name"], "v").collect()}
    assert set(got) == {"a", "c"}
    assert (got["a"]["pct_growth"], got["a"]["cagr_pct"]) == (100.0, 7.2)
    assert got["c"]["pct_growth"] is None and got["c"]["current_median_fmt"] == "5"


def test_scores(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", 3.0, 10.0), ("c", 2.0, 10.0)], "k string, x double, flat double")
    out = {(r["k"], r["factor"]): r["score"] for r in scoring.composite(df, ["k"], [Factor("X", "x", True), Factor("Flat", "flat")]).collect()}
    assert out["a", "X"] == 50.0 and out["b", "X"] == 0.0 and out["c", "X"] == 25.0 and out["a", "Flat"] is None
    m = spark.createDataFrame([(2, 6, 0.5), (0, 0, 0.0)], "n int, f int, c double")
    rows = scoring.connectivity(m, [Mode("n", "f", "c", 6.0, 1.0)]).orderBy("n").collect()
    assert [(r["connectivity_raw"], r["connectivity_index"]) for r in rows] == [(0.0, 0.0), (1.0, 100.0)]


def test_global_extremes_use_no_single_partition_window_and_no_cross_join(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("x"))
    plan = scoring.min_max(df, [Factor("s", "x")], 25.0)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_linked_selections(spark):
    df = spark.createDataFrame([("s1", "r1"), ("s2", "r1"), ("s3", "r2")], "s string, r string")
    pick = {"s": ["s1"], "r": []}
    assert scoring.linked(df, pick).count() == 1
    assert {r["r"]: r["associated_rows"] for r in scoring.options(df, "r", pick).collect()} == {"r1": 1, "r2": 0}
    assert {r["s"]: r["associated_rows"] for r in scoring.options(df, "s", pick).collect()} == {"s1": 1, "s2": 1, "s3": 1}


def test_run_states_health_and_alerts(spark):
    fields = [f.name for f in runlog.RUN_EVENTS]

    def ev(**kw):
        return tuple(kw.get(f) for f in fields)

    from datetime import datetime

    def at(h):
        return datetime(2024, 1, 1, h)

    events = spark.createDataFrame([
        ev(run_id="a", event="OPEN", at=at(1), pipeline_name="p", env="dev", trigger="manual"),
        ev(run_id="a", event="CLOSE", at=at(2), status="SUCCESS", rows_read=1, rows_written=5, batch_ids=["b"]),
        ev(run_id="b", event="OPEN", at=at(3), pipeline_name="p", env="dev", trigger="manual"),
        ev(run_id="c", event="OPEN", at=at(4), pipeline_name="q", env="dev", trigger="manual"),
        ev(run_id="c", event="CLOSE", at=at(5), status="FAILED", error_class="E", error_message="it's bad"),
        # opened again after its close
        ev(run_id="a2", event="OPEN", at=at(1), pipeline_name="z", env="dev", trigger="manual"),
        ev(run_id="a2", event="CLOSE", at=at(2), status="FAILED"),
        ev(run_id="a2", event="OPEN", at=at(3), pipeline_name="z", env="dev", trigger="manual"),
    ], runlog.RUN_EVENTS)
    state = {r["run_id"]: r for r in runlog.run_state(events).collect()}
    assert {k: v["status"] for k, v in state.items()} == {"a": "SUCCESS", "b": "RUNNING", "c": "FAILED", "a2": "RUNNING"}
    assert state["c"]["error_message"] == "it's bad" and state["a"]["batch_ids"] == ["b"] and state["b"]["ended_at"] is None
    dq = spark.createDataFrame([("a", "low", "WARN", 10, 0.5)], "run_id string, rule_name string, severity string, rows_failed long, pass_rate double")
    health = runlog.health(runlog.run_state(events), dq, Settings())
    rows = {r["run_id"]: r for r in health.collect()}
    assert rows["a"]["duration_seconds"] == 3600 and rows["a"]["failing_rules"] == ["low"]
    late = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert {(r["pipeline_name"], r["reason"]) for r in runlog.alerts(health, Settings(), late).collect()} == {
        ("p", "stale"), ("q", "run failed"), ("z", "stale")}
