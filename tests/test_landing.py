import pytest
from pyspark.sql import functions as F

from tierline.sources.lake import Lake
from tierline.sources.landing import headers, stamp, write_csv
from tierline.streaming.ingest import Bronze, ingest


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_columns_are_matched_by_name_and_added(spark, tmp_path):
    land, bronze = tmp_path / "land", Bronze(spark, str(tmp_path / "bronze"))
    put(land, "a.csv", "k,v\n1,one\n2,\n")
    assert ingest(spark, str(land), bronze).rows == 2
    put(land, "b.csv", "k,v,extra\n3,three,x\n")
    put(land, "c.csv", "v,k,extra\nfour,4,y\n")
    taken = ingest(spark, str(land), bronze)
    assert (taken.files, taken.rows) == (2, 2)
    assert ingest(spark, str(land), bronze).files == 0
    assert bronze.columns() == ["k", "v", "extra"]
    rows = sorted((r["k"], r["v"], r["extra"]) for r in bronze.read().collect())
    assert rows == [("1", "one", None), ("2", None, None), ("3", "three", "x"), ("4", "four", "y")]
    files = {r["source_file"].rsplit("/", 1)[-1] for r in bronze.read().select("source_file").collect()}
    assert files == {"a.csv", "b.csv", "c.csv"}


def test_large_file_in_many_splits_keeps_one_header(spark, tmp_path):
    land, bronze = tmp_path / "land", Bronze(spark, str(tmp_path / "bronze"))
    put(land, "big.csv", "k,v\n" + "".join(f"{i},value {i}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert ingest(spark, str(land), bronze, files_per_batch=1).rows == 20000
        assert bronze.read().where(F.col("v") == F.concat(F.lit("value "), F.col("k"))).count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def bytes_read(spark):
    """Bytes this Spark process has asked the system for so far."""
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    return int(open(f"/proc/{pid}/io").readline().split()[1])


def test_a_header_costs_a_few_buffers_whatever_the_size_of_its_file(spark, tmp_path):
    line = "1," + "x" * 1000 + "\n"
    for name in ("a.csv", "b.csv"):
        put(tmp_path, name, "k,v\n" + line * 60_000)
    paths = [str(tmp_path / name) for name in ("a.csv", "b.csv")]
    headers(spark, paths)  # classes are loaded
    before = bytes_read(spark)
    assert {k.rsplit("/", 1)[-1]: v for k, v in headers(spark, paths).items()} == {"a.csv": ("k", "v"), "b.csv": ("k", "v")}
    assert bytes_read(spark) - before < 2 * 8_000_000


def test_headers_in_every_form(spark, tmp_path):
    land, bronze = tmp_path / "land", Bronze(spark, str(tmp_path / "bronze"))
    put(land, "a.csv", '\ufeffk,"a, ""b"""\n1,x\n')
    put(land, "b.csv", 'k,"two\nlines"\n2,"y\nz"\n3,w\n')
    put(land, "c.csv", "k\n")
    put(land, "d.csv", "")
    put(land, "e.csv", "k\r\n4\r\n")
    assert ingest(spark, str(land), bronze).rows == 4
    assert bronze.columns() == ["k", 'a, "b"', "two\nlines"]
    got = {r["k"]: (r['a, "b"'], r["two\nlines"]) for r in bronze.read().collect()}
    assert got == {"1": ("x", None), "2": (None, "y\nz"), "3": (None, "w"), "4": (None, None)}


def test_bounded_batches_take_everything_once(spark, tmp_path):
    land, bronze = tmp_path / "land", Bronze(spark, str(tmp_path / "bronze"))
    for i in range(5):
        put(land, f"f{i}.csv", f"k\n{i}\n")
    assert ingest(spark, str(land), bronze, files_per_batch=2).files == 5
    assert bronze.read().count() == 5


def test_quoted_text_survives(spark, tmp_path):
    text = ['say "hi"', "a,b", "", "plain", "back\\slash"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "k int, t string")
    write_csv(df, str(tmp_path / "land"))
    bronze = Bronze(spark, str(tmp_path / "bronze"))
    ingest(spark, str(tmp_path / "land"), bronze)
    got = {int(r["k"]): r["t"] for r in bronze.read().collect()}
    assert [got[i] or "" for i in range(5)] == text


def test_stamp(spark):
    df = spark.createDataFrame([(2020, 1)], "period int, v int")
    r = stamp(df, "b1").first()
    assert (r["source_system"], r["batch_id"], r["effective_ts"]) == ("SYNTHETIC", "b1", "2020-07-01T00:00:00")



def test_publication_is_all_or_nothing_and_versioned(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    one, two = spark.range(3), spark.range(5)
    staged = lake.stage(one, "gold", "t")
    with pytest.raises(KeyError):
        lake.read("gold", "t")
    lake.publish("gold", "t", staged, "r1", 3)
    lake.publish_all([("gold", "t", lake.stage(two, "gold", "t"), 5), ("gold", "u", lake.stage(one, "gold", "u"), 3)], "r2")
    assert lake.read("gold", "t").count() == 5 and lake.read("gold", "u").count() == 3
    assert lake.published()["gold", "t"].version == 2


def test_every_visible_file_is_taken_whatever_its_name(spark, tmp_path):
    from tierline.streaming.ingest import Bronze, ingest

    landing = tmp_path / "in"
    landing.mkdir()
    for name in ("a.CSV", "b.txt", "c.csv", "d"):
        (landing / name).write_text(f"k,v\n{name},1\n")
    bronze = Bronze(spark, str(tmp_path / "bronze"))
    assert ingest(spark, str(landing), bronze).files == 4
    assert {r["k"] for r in bronze.read().collect()} == {"a.CSV", "b.txt", "c.csv", "d"}
    only = Bronze(spark, str(tmp_path / "only"))
    assert ingest(spark, str(landing), only, only_names="*.csv").files == 1


def test_a_null_segment_is_not_lost(spark, tmp_path):
    from pyspark.sql import functions as F

    from tierline.plans import retail

    real = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    holes = real.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")))
    holes.write.parquet(str(tmp_path / "customer.parquet"))
    assert retail.QUERIES["bronze_schema_evolution"](spark, str(tmp_path)).count() == real.count()


def test_a_cluster_needs_a_shared_folder():
    from tierline.session import on_one_machine

    assert on_one_machine("local") and on_one_machine("local[8]")
    assert not any(on_one_machine(m) for m in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://https://host"))


def test_a_materialized_table_is_built_again_when_its_input_has_changed(spark, tmp_path):
    lake, built = Lake(spark, str(tmp_path / "lake")), []

    def ask(version, by=None):
        def build():
            built.append(version)
            return spark.createDataFrame([(1, version, "a"), (2, version, "b")], "year int, v int, t string")

        return sorted(map(tuple, lake.materialized("reporting", f"mart_{by}", {"fact": version}, build, by).collect()))

    for by in (None, "year"):
        built.clear()
        assert ask(1, by) == ask(1, by) == [(1, 1, "a"), (2, 1, "b")] and built == [1]
        assert ask(2, by) == ask(2, by) == [(1, 2, "a"), (2, 2, "b")] and built == [1, 2]
    mart = lake.read("reporting", "mart_year").where("year = 2").select("v")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<v:int>" in plan
