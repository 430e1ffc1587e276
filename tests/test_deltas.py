"""Delta tables and the history kept in them, against a dictionary and against a full build."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierline.operators import history as hist
from tierline.sources.deltas import DeltaTable
from tierline.streaming.changes import HistoryTable

SCHEMA = "k string, j int, v long"


def listed(path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(path).rglob("*.parquet")}


def delta_table(spark, path, **kw):
    return DeltaTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ("k", "j"), **kw)


def content(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_random_writes_equal_a_dictionary(spark, tmp_path):
    rnd, t, model = random.Random(1), delta_table(spark, tmp_path / "t", buckets=4, max_deltas=2), {}
    assert content(t) == [] and not (tmp_path / "t").exists()
    for n in range(7):
        # all keys, few keys until the deltas are many, then all keys again
        keys = [(f"k{i}", i % 3) for i in rnd.sample(range(4000), 4000 if n in (0, 5) else 6)]
        new = {k: [rnd.randrange(1 << 40) for _ in range(rnd.randrange(4))] for k in keys}
        rows = [(*k, v) for k, vs in new.items() for v in vs]
        model |= new
        t.write(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(keys, "k string, j int"))
        assert content(t) == sorted((*k, v) for k, vs in model.items() for v in vs)
        assert max(sum(f.bucket == b for f in t.live()) for b in range(4)) <= 4
    kinds = {(r["kind"], r["since"] == -1) for r in t.log().collect()}
    assert kinds == {("write", True), ("write", False), ("merge", True), ("merge", False)}


def test_a_write_leaves_files_without_its_keys_alone(spark, tmp_path):
    t = delta_table(spark, tmp_path / "t", buckets=8)
    many = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("j"), F.col("id").alias("v"))
    t.write(many, many)
    before = listed(t.rows_path)
    one = spark.createDataFrame([("k7", 1, -1)], SCHEMA)
    seq = t.write(one, one)
    after = listed(t.rows_path)
    assert {p: after.get(p) for p in before} == before
    new = [p for p in after if p not in before]
    assert len(new) == 1 and spark.read.parquet(*new).count() == 1
    assert t.read().where("k = 'k7'").collect()[0]["v"] == -1 and t.read().count() == 4000
    assert [tuple(r) for r in t.changed_since(seq - 1).collect()] == [("k7", 1)] and t.changed_since(seq).count() == 0


def test_a_write_that_did_not_reach_the_log_does_not_count(spark, tmp_path, monkeypatch):
    t = delta_table(spark, tmp_path / "t", buckets=2)
    rows = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], SCHEMA)
    t.write(rows, rows)

    def lost(*_):
        raise OSError("gone")

    changed = spark.createDataFrame([("a", 1, 9)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(DeltaTable, "_append", lost)
        with pytest.raises(OSError):
            t.write(changed, changed)
    assert content(t) == [("a", 1, 1), ("b", 1, 2)]
    t.write(changed, changed)
    assert content(t) == [("a", 1, 9), ("b", 1, 2)]
    with pytest.raises(ValueError, match="buckets"):
        delta_table(spark, tmp_path / "t", buckets=3).read()


FEED = "k string, at int, name string, tie int"


def test_history_in_many_batches_equals_one_build_and_follows_the_changes(spark, tmp_path):
    rnd = random.Random(3)
    feed = [(f"k{rnd.randrange(40)}" if rnd.random() < 0.7 else "hot", rnd.randrange(60), rnd.choice("abc"), i) for i in range(600)]
    schema = spark.createDataFrame([], FEED).schema
    t = HistoryTable(spark, str(tmp_path / "h"), schema, ("k",), "at", ("name",), (), ("tie",), buckets=4, max_deltas=2)
    size = 150
    for n in range(0, 600, size):
        t.apply(spark.createDataFrame(feed[n : n + size], FEED), n // size)
        want = hist.scd2(spark.createDataFrame(feed[: n + size], FEED), ["k"], "at", ["name"], tiebreak=["tie"])
        assert sorted(map(tuple, t.read().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    before, done = listed(f"{t.path}/dim/rows"), sorted(map(tuple, t.read().collect()), key=str)
    t.apply(spark.createDataFrame([("k1", 70, "z", 1000)], FEED), 4)
    after = listed(f"{t.path}/dim/rows")
    assert all(after[p] == before[p] for p in before)
    fresh = spark.read.parquet(*[p for p in after if p not in before]) if len(after) > len(before) else None
    assert fresh is not None and {r["k"] for r in fresh.where("_seq IS NOT NULL" if "_seq" in fresh.columns else "true").collect()} >= {"k1"}
    now = sorted(map(tuple, t.read().collect()), key=str)
    assert {r for r in now if r[0] != "k1"} == {r for r in done if r[0] != "k1"}
    # the last batch once more, as after a lost checkpoint
    t.apply(spark.createDataFrame([("k1", 70, "z", 1000)], FEED), 4)
    assert sorted(map(tuple, t.read().collect()), key=str) == now


def test_each_run_is_a_micro_batch_and_reads_only_what_is_new(spark, tmp_path):
    schema = spark.createDataFrame([], FEED).schema
    t = HistoryTable(spark, str(tmp_path / "h"), schema, ("k",), "at", ("name",), (), ("tie",), buckets=2)
    root, taken = str(tmp_path / "in"), []
    for i, rows in enumerate(([("a", 1, "x", 1), ("b", 1, "x", 1)], [("a", 5, "y", 2)], [])):
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(f"{root}/part={i}")
        taken.append(t.run(spark.readStream.schema(schema).parquet(root)))
    assert taken[:2] == [2, 1] and not taken[2]
    assert {r["_batch"] for r in t.feed().select("_batch").distinct().collect()} == {0, 1}
    assert sorted(map(tuple, t.read().collect())) == [("a", "x", 1, 5), ("a", "y", 5, None), ("b", "x", 1, None)]
    assert os.path.isdir(t.checkpoint)
