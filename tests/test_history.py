"""Type 2 history against a plain Python model, with and without split keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators import history as hist
from tierline.operators import skew
from tierline.operators.asof import temporal_join

SCHEMA = "k string, seq long, name string, area double, tie long"


def model(rows):
    """The same history in plain Python."""
    out = []
    by_key = {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            by_key.setdefault(r[0], []).append(r)
    for k, group in by_key.items():
        newest = {}
        for r in sorted(group, key=lambda r: (r[1], r[4])):
            newest[r[1]] = r
        versions = []
        for r in (newest[s] for s in sorted(newest)):
            if versions and versions[-1][0] == r[2]:
                versions[-1][1] = r[3]
            else:
                versions.append([r[2], r[3], r[1]])
        for i, (name, area, start) in enumerate(versions):
            end = versions[i + 1][2] if i + 1 < len(versions) else None
            out.append((k, name, area, start, end))
    return sorted(out, key=lambda r: (r[0], r[3]))


def build(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    h = hist.scd2(df, ["k"], "seq", ["name"], ["area"], ["tie"], **kw)
    assert h.columns == ["k", "name", "area", hist.START, hist.END]
    return sorted((tuple(r) for r in h.collect()), key=lambda r: (r[0], r[3]))


SEQUENCE = [
    ("A", 1971, "n1", 1.0, 0), ("A", 1980, "n1", 2.0, 0), ("A", 1990, "n2", 2.0, 0),
    ("A", 2000, "n2", 3.0, 0), ("A", 2010, "n1", 3.0, 0), ("B", 1971, "b", 1.0, 0), ("B", 1971, "b", 1.0, 0),
]


@pytest.mark.parametrize("limit", [None, 1, 2])
def test_changes_untracked_and_return_to_an_old_value(spark, limit):
    assert build(spark, SEQUENCE, limit=limit) == [
        ("A", "n1", 2.0, 1971, 1990), ("A", "n2", 3.0, 1990, 2010), ("A", "n1", 3.0, 2010, None),
        ("B", "b", 1.0, 1971, None),
    ]


@pytest.mark.parametrize("limit", [None, 1])
def test_null_values_open_versions_only_when_they_change(spark, limit):
    rows = [("N", 1, None, None, 0), ("N", 2, None, None, 0), ("N", 3, "x", None, 0), ("N", 4, None, None, 0)]
    assert [(r[1], r[3]) for r in build(spark, rows, limit=limit)] == [(None, 1), ("x", 3), (None, 4)]


def test_tie_is_decided_by_the_tiebreak_and_keyless_rows_are_left_out(spark):
    rows = [("T", 1, "old", 1.0, 1), ("T", 1, "new", 2.0, 2), (None, 1, "x", 1.0, 0), ("T", None, "x", 1.0, 0)]
    assert build(spark, rows) == [("T", "new", 2.0, 1, None)]


def test_late_and_repeated_rows_recut_history(spark):
    late = [*SEQUENCE, ("A", 1960, "n0", 0.5, 0), ("A", 1985, "n9", 9.0, 0), *SEQUENCE]
    assert build(spark, late) == model(late)


def random_feed(seed, n, hot_share=0.35):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < hot_share else f"k{rnd.randrange(60)}"
        rows.append((k, rnd.randrange(400), rnd.choice(["a", "b", None]), float(rnd.randrange(5)), i))
    return rows


@pytest.mark.parametrize("limit", [None, 300, 40, 7])
def test_random_feed_equals_the_model_however_keys_are_split(spark, limit):
    rows = random_feed(7, 3000)
    assert build(spark, rows, limit=limit) == model(rows)


def test_one_long_run_over_many_segments_stays_one_version(spark):
    rows = [("L", i, "same", float(i), 0) for i in range(500)] + [("L", 500, "other", 1.0, 0)]
    assert build(spark, rows, limit=20) == [("L", "same", 499.0, 0, 500), ("L", "other", 1.0, 500, None)]


def test_audit_columns_in_both_plans(spark):
    df = spark.createDataFrame(random_feed(3, 800), SCHEMA)
    kw = dict(keys=["k"], seq="seq", tracked=["name"], tiebreak=["tie"], audit=["tie"])
    plain = {tuple(r) for r in hist.scd2(df, **kw).collect()}
    split = {tuple(r) for r in hist.scd2(df, limit=25, **kw).collect()}
    assert plain == split


def test_overlap_check_finds_a_broken_history(spark):
    rows = [("A", 1, 5), ("A", 4, None), ("B", 1, 3), ("B", 3, None), ("C", 1, None), ("C", 2, None)]
    df = spark.createDataFrame(rows, f"k string, {hist.START} int, {hist.END} int")
    assert sorted(r["k"] for r in hist.overlaps(df, ["k"]).collect()) == ["A", "C"]


@pytest.mark.parametrize("limit", [None, 10, 3])
def test_overlap_check_is_the_same_however_a_key_is_cut(spark, limit):
    """Segments of ten versions: overlaps and gaps lie inside them and exactly on the cuts."""
    rows = [("hot", i, i + 1) for i in range(100)] + [("k", 1, 5), ("k", 4, None)]
    for at, end in ((9, 11), (19, 20), (29, 29), (50, 70), (89, None), (95, 97)):
        rows[at] = ("hot", at, end)
    rows += [("hot", 40, 41)] * 2
    df = spark.createDataFrame(rows, f"k string, {hist.START} int, {hist.END} int")
    got = sorted((r["k"], r[hist.START], r["next_start"]) for r in hist.overlaps(df, ["k"], limit).collect())
    assert got == sorted([("hot", 9, 10), ("hot", 40, 40), ("hot", 40, 40), ("hot", 50, 51), ("hot", 89, 90), ("hot", 95, 96), ("k", 1, 4)])


def test_a_key_with_a_long_history_goes_its_own_way(spark):
    rows = [("long", i, i + 1 if i < 499 else None, f"L{i}") for i in range(500)] + [(f"k{i}", 10 * j, 10 * j + 10 if j < 2 else None, f"{i}-{j}") for i in range(20) for j in range(3)]
    v = spark.createDataFrame(rows, V_SCHEMA)
    rnd = random.Random(7)
    facts = [(rnd.choice(["long", "long", None, "none", *(f"k{i}" for i in range(20))]), rnd.randrange(-5, 520), i) for i in range(800)]
    f = spark.createDataFrame(facts, "k string, at long, id int")
    joined = temporal_join(f, v, "k", F.col("at"), ["label"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Window" in plan and "_v_start" in plan
    want = {i: next((x for a, s, e, x in rows if a == k and s <= at and (e is None or at < e)), None) for k, at, i in facts}
    assert {r["id"]: r["label"] for r in joined.collect()} == want
    short = temporal_join(f, v, "k", F.col("at"), ["label"], most=500)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in short


def test_plain_plan_needs_one_shuffle(spark):
    df = spark.createDataFrame(SEQUENCE, SCHEMA)
    plan = hist.scd2(df, ["k"], "seq", ["name"], ["area"], ["tie"])
    text = plan._jdf.queryExecution().explainString(plan._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


# ---- point in time --------------------------------------------------------------------------

VERSIONS = [("A", 10, 20, "v1"), ("A", 20, None, "v2"), ("B", 10, 15, "w1"), ("B", 18, None, "w2")]
V_SCHEMA = f"k string, {hist.START} long, {hist.END} long, label string"


@pytest.mark.parametrize("method,limit", [("interval", None), ("merge", None), ("merge", 2), ("auto", None)])
def test_edges_of_intervals(spark, method, limit):
    v = spark.createDataFrame(VERSIONS, V_SCHEMA)
    facts = [("A", 10), ("A", 19), ("A", 20), ("A", 9), ("A", None), (None, 12), ("B", 16), ("B", 18), ("C", 12), ("A", 10)]
    f = spark.createDataFrame([(*x, i) for i, x in enumerate(facts)], "k string, at long, id int")
    got = temporal_join(f, v, "k", F.col("at"), ["label"], method=method, limit=limit).collect()
    assert {r["id"]: r["label"] for r in got} == {
        0: "v1", 1: "v1", 2: "v2", 3: None, 4: None, 5: None, 6: None, 7: "w2", 8: None, 9: "v1"}
    assert len(got) == len(facts)


@pytest.mark.parametrize("method,limit", [("merge", None), ("merge", 50), ("interval", None)])
def test_random_lookup_equals_brute_force(spark, method, limit):
    history = model(random_feed(11, 2000))
    v = spark.createDataFrame([(k, s, e, f"{k}-{s}") for k, _, _, s, e in history], V_SCHEMA)
    rnd = random.Random(5)
    facts = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(70)}", rnd.randrange(-5, 420), i) for i in range(1500)]
    # very many rows of one key on one date
    facts += [("hot", 200, 10_000 + i) for i in range(600)]
    f = spark.createDataFrame(facts, "k string, at long, id int")
    got = {r["id"]: r["label"] for r in temporal_join(f, v, "k", F.col("at"), ["label"], method=method, limit=limit).collect()}
    want = {}
    for k, at, i in facts:
        hits = [f"{a}-{s}" for a, _, _, s, e in history if a == k and s <= at and (e is None or at < e)]
        want[i] = hits[0] if hits else None
    assert got == want


def test_segments_are_contiguous_and_bounded(spark):
    df = spark.createDataFrame(random_feed(1, 4000), SCHEMA)
    cold, hot = skew.split_hot(df, ["k"], ["seq", "tie"], 200)
    assert cold.count() + hot.count() == 4000
    assert {r["k"] for r in hot.select("k").distinct().collect()} == {"hot"}
    cuts = hot.groupBy(skew.SEGMENT).agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    cuts = cuts.orderBy("lo", "hi").collect()
    assert len(cuts) > 3 and all(a["hi"] <= b["lo"] for a, b in zip(cuts, cuts[1:]))


def test_rows_of_a_join_are_computed_once_for_both_ways(spark):
    """One key of 100 versions among short ones: the rows are not joined again to cut the long key's."""
    v = spark.createDataFrame([("long", i, i + 1, f"L{i}") for i in range(100)] + [("k", 0, None, "K")], V_SCHEMA)
    read = spark.sparkContext.accumulator(0)

    def pull(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    f = spark.range(200).selectExpr("if(id % 2 = 0, 'long', 'k') AS k", "id AS at", "id").mapInArrow(pull, "k string, at long, id long")
    got = {r["id"]: r["label"] for r in temporal_join(f, v, "k", F.col("at"), ["label"], limit=30).collect()}
    assert got == {i: "K" if i % 2 else f"L{i}" if i < 100 else None for i in range(200)}
    assert read.value == 200


@pytest.mark.parametrize("order", [["seq"], ["seq", "tie"]])
def test_values_carried_over_segments_equal_plain_windows(spark, order):
    """Order columns with NULL and with equal first values, segments of few rows and values that are often missing."""
    rnd = random.Random(9)
    rows = [("hot", rnd.choice([None, *range(12)]) if len(order) > 1 else i, i, rnd.choice([None, None, None, i])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, seq long, tie long, v long")
    cut = skew.cut(df, ["k"], order, 300, 40)
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    row = F.struct("tie")
    want = df.select("tie", F.lag("tie").over(w), F.lead("tie").over(w), F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = skew.lag_across(cut, ["k"], order, row, "a").join(skew.lead_across(cut, ["k"], order, row, "b").select("tie", "b"), "tie")
    got = got.join(skew.last_known_across(cut, ["k"], order, F.col("v"), "c").select("tie", "c"), "tie")
    assert sorted(map(tuple, got.select("tie", "a.tie", "b.tie", "c").collect())) == sorted(map(tuple, want.collect()))


def test_edges_of_segments_need_no_sort_of_all_rows(spark):
    df = spark.createDataFrame([("a", 1, 0, "x")], f"k string, seq long, {skew.SEGMENT} int, v string")
    plan = skew._edges(df, ["k"], ["seq"], F.struct("v"), last=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan and "partial_max(" in plan
