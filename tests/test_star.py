import pytest
from pyspark.sql import functions as F

from tierline.functions.columns import period_date
from tierline.operators import checks, star
from tierline.operators import history as hist


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("A", "1990-01-01", "2000-07-01", "n1"), ("A", "2000-07-01", None, "n2"), ("B", "1980-01-01", None, "b")]
    df = spark.createDataFrame(rows, "code string, s string, e string, name string").select(
        "code", "name", F.col("s").cast("timestamp").alias(hist.START), F.col("e").cast("timestamp").alias(hist.END))
    return hist.with_surrogate_key(df, ["code"], "sk")


def fact(spark, dim, rows):
    m = spark.createDataFrame(rows, "code string, period int, v int, batch_id string")
    return star.build_fact(m, dim, star.dim_year(spark), "code", period_date("period"), F.col("period"), "sk", attrs=("name",), leave_out=("period",))


def test_fact_binds_versions_and_unknown_members(spark, dim):
    rows = [("A", 1999, 1, "x"), ("A", 2000, 2, "x"), ("A", 1985, 3, "x"), ("B", None, 4, "x"), ("B", 1960, 5, "x"), ("B", 2040, 6, "x"), (None, 2000, 7, "x"), ("Z", 2000, 8, "x")]
    f = fact(spark, dim, rows)
    assert f.columns == ["sk", "year_sk", "name", "v", "batch_id"]
    got = {r["v"]: (r["name"], r["sk"] == -1, r["year_sk"]) for r in f.collect()}
    assert got == {
        1: ("n1", False, 1999), 2: ("n2", False, 2000), 3: (None, True, 1985), 4: (None, True, -1), 5: (None, True, -1),
        6: ("b", False, -1), 7: (None, True, 2000), 8: (None, True, 2000)}
    # unknown members stay out of star joins, and out of the orphan checks
    assert star.star_rows(f, dim, star.dim_year(spark), "sk", ["code"]).count() == 2
    assert star.orphan_keys(f, dim, "sk").count() == 0
    lost = star.orphan_keys(f, dim.where("code <> 'A'"), "sk")
    assert lost.agg(F.sum("fact_rows")).first()[0] == 2


def test_surrogate_key_is_per_version_and_stable(spark, dim):
    a, b = (sorted(r["sk"] for r in dim.collect()) for _ in range(2))
    assert a == b and len(set(a)) == 3
    assert checks.dim_sanity(dim, "sk", ["code"]).first().asDict() == {"duplicated_keys": 0, "keys_with_two_open": 0}
    broken = dim.unionByName(dim)
    assert checks.dim_sanity(broken, "sk", ["code"]).first().asDict() == {"duplicated_keys": 3, "keys_with_two_open": 2}


def test_dim_year(spark):
    rows = {r["year"]: r for r in star.dim_year(spark).collect()}
    assert len(rows) == 60 and min(rows) == 1971 and max(rows) == 2030
    assert rows[2021]["is_census_year"] and not rows[2020]["is_census_year"] and rows[1999]["decade"] == 1990


def test_upsert_replaces_by_grain_and_is_idempotent(spark):
    schema = "k int, y int, s string, v int"
    old = spark.createDataFrame([(1, 2000, "a", 1), (1, 2001, "a", 2), (None, 2000, "a", 3)], schema)
    new = spark.createDataFrame([(1, 2001, "a", 20), (None, 2000, "a", 30), (2, 2000, "a", 5)], schema)
    once = star.upsert(old, new, ["k", "y", "s"])
    want = {(1, 2000, "a", 1), (1, 2001, "a", 20), (None, 2000, "a", 30), (2, 2000, "a", 5)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in star.upsert(once, new, ["k", "y", "s"]).collect()} == want


def test_upsert_does_not_make_the_replaced_grains_distinct(spark):
    old, new = (spark.createDataFrame(rows, "k int, v int") for rows in ([(1, 1), (2, 2), (None, 3)], [(1, 10), (1, 11), (None, 30)]))
    out = star.upsert(old, new, ["k"])
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in out.collect()} == {(2, 2), (1, 10), (1, 11), (None, 30)}


def test_drill_across_does_not_multiply_shared_keys(spark):
    many = spark.createDataFrame([(-1, 2000, 1)] * 50 + [(7, 2000, 2)], "sk int, y int, v int")
    n = F.count(F.lit(1))
    out = star.drill_across({"a": many, "b": many}, ["sk", "y"], {"a": [n.alias("a")], "b": [n.alias("b")]})
    assert {tuple(r) for r in out.collect()} == {(-1, 2000, 50, 50), (7, 2000, 1, 1)}


@pytest.mark.parametrize("right,want", [([1, 2], {3}), ([1, None], set()), ([], {1, 2, 3, None}), ([9], {1, 2, 3})])
def test_not_in(spark, right, want):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    r = spark.createDataFrame([(x,) for x in right], "r int")
    assert {x["k"] for x in star.not_in(left, "k", r, "r").collect()} == want


def test_row_flow_and_verdicts(spark):
    full, none = spark.range(4), spark.range(0)
    flow = {r["entity"]: r for r in checks.row_flow({"ok": (full, full, full), "lost": (full, none, none), "unbound": (full, full, none), "empty": (none, none, none)}).collect()}
    assert [flow[e]["status"] for e in ("ok", "lost", "unbound", "empty")] == ["OK", "FAIL", "FAIL", "EMPTY"]
    assert flow["lost"]["drop_pct"] == 100.0 and flow["empty"]["drop_pct"] is None
    with pytest.raises(checks.VerificationError):
        checks.require_clean(checks.flow_checks(checks.row_flow({"lost": (full, none, none)})))


def test_a_no_op_run_is_healthy(spark):
    runs = spark.createDataFrame([("SUCCESS", 5, 1), ("NO_OP", 0, 2)], "status string, rows_written long, started_at int")
    assert [r["result"] for r in checks.run_checks(runs).collect()] == ["PASS", "PASS"]
    failed = runs.union(spark.createDataFrame([("FAILED", 0, 3)], runs.schema))
    assert [r["result"] for r in checks.run_checks(failed).collect()] == ["FAIL", "WARN"]


def test_unknown_rate_warns_above_half(spark):
    f = spark.createDataFrame([(-1,), (-1,), (5,)], "sk int")
    assert checks.unknown_rate(f, "sk").first()["result"] == "WARN"


def test_one_pass_per_table_finds_what_is_wrong(spark, dim):
    f = fact(spark, dim, [("A", 1999, 1, "x"), ("A", 1999, 2, "x"), ("B", 2000, 3, "x"), ("Z", 2000, 4, "x"), ("B", 1960, 5, "x")])
    years, grain = star.dim_year(spark), ["sk", "year_sk"]
    assert checks.fact_summary(f, dim, years, "sk", grain).first().asDict() == {"rows": 5, "doubled": 1, "no_member": 0, "no_year": 0, "unknown": 2}
    half, few = dim.where("code = 'A'"), years.where("year > 1999")
    assert checks.fact_summary(f, half, few, "sk", grain).first().asDict() == {"rows": 5, "doubled": 1, "no_member": 1, "no_year": 2, "unknown": 2}
    with pytest.raises(ValueError, match="year_sk"):
        checks.fact_summary(f, dim, years, "sk", ["sk"])
    measured = checks.summaries({"fact_a": (f, half, few, "sk", grain)}, {"dim_a": (dim.unionByName(half), "sk", "code")}, {"vw": f.limit(0)}, {"a": (f, f)})
    found = {r["check"]: (r["result"], r["detail"]) for r in checks.table_checks(measured, 30.0).collect()}
    assert found == {
        "a flows through all layers": ("PASS", "5 > 5 > 5"),
        "dim_a has one row per surrogate key": ("FAIL", "doubled: 2"), "dim_a has one open version per key": ("FAIL", "open twice: 1"),
        "fact_a has one row per grain": ("FAIL", "doubled: 1"),
        "fact_a refers to members and years that exist": ("FAIL", "rows without member: 1, without year: 2"),
        "fact_a knows its members": ("WARN", "unknown %: 40.0"), "vw answers": ("WARN", "rows: 0"),
    }
