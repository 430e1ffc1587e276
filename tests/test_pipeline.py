"""The suburb mart end to end: files, restatement, history, facts, views, no-op, failure."""

import csv
from dataclasses import replace
from pathlib import Path

import pytest

from tierline import registry
from tierline.operators.quality import QualityError
from tierline.plans import runlog, suburbs, verification
from tierline.plans.pipeline import Pipeline
from tierline.sources.lake import Lake

YEARS = (2011, 2016, 2021)
SUBURBS = {"S1": ("Ash", "L1", 1.0), "S2": ("Birch", "L1", 2.0), "S3": ("Cedar", "L2", 4.0)}


def land(root: Path, entity: str, name: str, rows: list[dict], batch: str = "b1") -> None:
    folder = root / entity
    folder.mkdir(parents=True, exist_ok=True)
    rows = [{**r, "source_system": "SYNTHETIC", "batch_id": batch} for r in rows]
    with open(folder / name, "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=list(rows[0]))
        w.writeheader()
        w.writerows(rows)


def suburb(code, name, lga, area, at):
    return dict(sal_code=code, suburb_name=name, postcode="3000", lga_code=lga, region="R",
                asgs_edition="E1", area_sqkm=area, effective_ts=at)


def land_all(root: Path) -> None:
    land(root, "suburb_ref", "suburb_ref_1.csv",
         [suburb(c, n, g, a, "1971-01-01T00:00:00") for c, (n, g, a) in SUBURBS.items()])
    land(root, "lga_ref", "lga_ref_1.csv",
         [dict(lga_code=c, lga_name=n, lga_type="City", asgs_edition="E1", effective_ts="1971-01-01T00:00:00")
          for c, n in (("L1", "Lake"), ("L2", "Moor"))])
    keys = [(c, y, i, j) for i, c in enumerate(SUBURBS) for j, y in enumerate(YEARS)]
    land(root, "demographics", "demographics_1.csv",
         [dict(sal_code=c, period=y, population_total=1000 * (i + 1) + j, median_age=30 + i, pop_0_14=200,
               pop_15_24=200, pop_25_44=200, pop_45_64=200, pop_65_plus=1000 * (i + 1) + j - 800,
               median_household_income_weekly=1500.5) for c, y, i, j in keys])
    land(root, "property", "property_1.csv",
         [dict(sal_code=c, period=y, median_house_price=100000.0 * (i + 1) * (j + 1), median_unit_price=90000,
               median_rent_weekly=400, sales_volume=10) for c, y, i, j in keys])
    land(root, "crime", "crime_1.csv",
         [dict(sal_code=c, period=y, offence_count_total=100 * (3 - i) + j) for c, y, i, j in keys])
    land(root, "transport", "transport_1.csv",
         [dict(sal_code=c, period=y, train_station_count=i, tram_stop_count=i, bus_stop_count=i + 1,
               train_freq_peak=6, tram_freq_peak=10, bus_freq_peak=6, train_coverage=0.5, tram_coverage=0.5,
               bus_coverage=0.5) for c, y, i, j in keys])
    land(root, "education", "education_1.csv",
         [dict(sal_code=c, period=y, govt_school_count=i + 1, mean_icsea=1000 + 10 * i) for c, y, i, j in keys])


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("mart")
    land_all(root / "landing")
    lake = Lake(spark, str(root / "lake"))
    pipe = Pipeline(lake, registry.load(), str(root / "landing"))
    first = pipe.run("r1")
    return root, lake, pipe, first


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_first_run_publishes_everything(mart):
    _, lake, _, first = mart
    assert first.status == "SUCCESS" and first.rows_read == 5 * 9 + 3 + 2
    assert lake.read("gold", "fact_crime").count() == 9
    assert lake.read("gold", "fact_crime").where("suburb_ref_sk = -1 OR year_sk = -1").count() == 0
    assert lake.read("gold", "dim_year").count() == 60


def test_views_and_datasets(mart):
    _, lake, _, _ = mart
    v = suburbs.views(lake)
    assert v["vw_q1_population_growth"].count() == 9
    q1 = v["vw_q1_population_growth"].where("sal_code = 'S3' AND year = 2021").first()
    assert (q1["population_total"], q1["population_total_fmt"], q1["lga_name"]) == (3002, "3,002", "Moor")
    # S3: 2*.5*1 + 2*.5*.7 + 3*.5*.4 = 2.3; S1: 1*.5*.4 = .2
    q2 = v["vw_q2_transport_connectivity"].collect()
    assert [(r["sal_code"], r["connectivity_raw"], r["connectivity_index"]) for r in q2] == [
        ("S3", 2.3, 100.0), ("S2", 1.25, 54.3), ("S1", 0.2, 8.7)]
    q5 = v["vw_q5_affordable_growth"].collect()
    assert [r["sal_code"] for r in q5] == ["S1", "S2", "S3"]
    assert q5[0]["pct_growth"] == 200.0 and q5[0]["cagr_pct"] == 11.6
    assert [r["sal_code"] for r in v["vw_q4_top_schools"].collect()] == ["S3", "S2", "S1"]
    d = suburbs.datasets(v)
    assert d["ds_q2"].count() == 9
    best = {(r["suburb_name"], r["factor"]): r["score"] for r in d["ds_best"].collect()}
    assert best["Cedar", "Safety (low crime)"] == 25.0 and best["Cedar", "Affordability"] == 0.0
    assert best["Ash", "Transit"] == 0.0 and len(best) == 12
    assert rows(d["ds_q4"], "suburb_name", "population_total") == [("Ash", 1002), ("Birch", 2002), ("Cedar", 3002)]


def test_verification_and_diagnosis(mart):
    _, lake, pipe, _ = mart
    found = {r["check"]: r for r in verification.verify(pipe, suburbs.views(lake)).collect()}
    assert {r["result"] for r in found.values()} == {"PASS"} and len(found) == 2 + 5 + 4 + 15 + 6
    assert found["crime flows through all layers"]["detail"] == "9 > 9 > 9"
    fact = verification.diagnose_fact(pipe, "crime")
    assert rows(fact["by_year"], "year", "resolved", "unknown") == [(y, 3, 0) for y in YEARS]
    assert fact["coverage"].first()["entities"] == 3 and fact["orphans"].count() == 0
    silver = verification.diagnose_silver(pipe, "crime")
    assert silver["keys"].first().asDict() == {"bronze_rows": 9, "null_keys": 0, "duplicated_grains": 0}
    assert silver["flow"].first()["drop_pct"] == 0.0 and silver["rules"].count() == 3
    assert [r["message"].split()[-1] for r in silver["order"].collect()][0] == "raw_crime"
    latest = runlog.rows_written_by_latest(pipe.log.events()).first()
    assert latest["update_id"] == "r1" and latest["rows_written"] > 0


def test_no_op_change_restatement_and_failure(mart, spark):
    root, lake, pipe, _ = mart
    before = lake.published()
    assert pipe.run("r2").status == "NO_OP"
    assert lake.published() == before

    # a rename from 2015 on, a restated price, both in new files with other batch ids
    land(root / "landing", "suburb_ref", "suburb_ref_0_upd.csv",
         [suburb("S1", "Ash North", "L1", 1.0, "2015-01-01T00:00:00")], "a0")
    land(root / "landing", "property", "property_0_upd.csv",
         [dict(sal_code="S2", period=2021, median_house_price=999000, median_unit_price=1, median_rent_weekly=1,
               sales_volume=1)], "a0")
    third = pipe.run("r3")
    assert third.status == "SUCCESS" and third.rows_read == 2
    q6 = suburbs.views(lake)["vw_q6_most_expensive"]
    assert rows(q6.where("sal_code = 'S1'"), "year", "suburb_name") == [
        (2011, "Ash"), (2016, "Ash North"), (2021, "Ash North")]
    assert q6.where("sal_code = 'S2' AND year = 2021").first()["median_house_price"] == 999000
    assert lake.read("gold", "dim_suburb_ref").count() == 4

    # a key that is missing is fatal: nothing is published, the failure is logged
    before = lake.published()
    land(root / "landing", "crime", "crime_2.csv", [dict(sal_code="", period=2021, offence_count_total=1)], "b2")
    with pytest.raises(QualityError, match="sal_code_not_null"):
        pipe.run("r4")
    assert lake.published() == before
    runs = {r["run_id"]: r for r in pipe.log.runs().collect()}
    assert [runs[f"r{i}"]["status"] for i in (1, 2, 3, 4)] == ["SUCCESS", "NO_OP", "SUCCESS", "FAILED"]
    assert runs["r4"]["error_class"] == "QualityError" and runs["r3"]["batch_ids"] == ["a0"]
    health = pipe.log.health(pipe.registry.settings("prod"))
    assert health.first()["failing_rules"] == ["sal_code_not_null"]
    # no new file, but the failed load is still unsettled: it must not pass for a no-op
    with pytest.raises(QualityError):
        pipe.run("r5")
    found = pipe.source_registry().where("entity = 'property'")
    assert rows(found, "batch_id", "rows_written") == [("a0", 1), ("b1", 9)]
    assert rows(pipe.trace("property"), "batch_id", "rows_written") == [("a0", 1)] + [("b1", 9)] * 8
    assert "vw_q1_population_growth" in suburbs.publish(lake)
    assert spark.table("vw_q1_population_growth").count() == 9


def test_full_refresh_gives_the_same_tables_and_is_remembered(spark, tmp_path):
    land_all(tmp_path / "landing")
    only = registry.Registry(tuple(e for e in registry.load().entities if e.name in ("suburb_ref", "crime")))
    lake = Lake(spark, str(tmp_path / "lake"))
    pipe = Pipeline(lake, only, str(tmp_path / "landing"))
    pipe.run("a")
    dim, fact = lake.read("gold", "dim_suburb_ref"), lake.read("gold", "fact_crime")
    assert pipe.full_refresh("b").status == "SUCCESS"
    again = Pipeline(lake, only, str(tmp_path / "landing"))
    assert again.generation == pipe.generation != "g0"
    assert again.run("c").status == "NO_OP"
    for old, name in ((dim, "dim_suburb_ref"), (fact, "fact_crime")):
        new = lake.read("gold", name).drop("gold_loaded_at", "ingested_at")
        old = old.drop("gold_loaded_at", "ingested_at")
        assert new.exceptAll(old).count() == 0 and old.exceptAll(new).count() == 0


def test_lost_values_batch_rules_and_repeated_batches_are_recorded(spark, tmp_path):
    root = tmp_path / "landing"
    land_all(root)
    rules = (
        registry.Rule("one_period", "unique", "WARN", columns=("period",)),
        registry.Rule("many_rows", "row_count_min", "WARN", min=1000),
        registry.Rule("code_there", "not_null", "FATAL", column="sal_code"),
    )
    known = {e.name: e for e in registry.load().entities}
    only = registry.Registry((known["suburb_ref"], replace(known["crime"], rules=rules)))
    pipe = Pipeline(Lake(spark, str(tmp_path / "lake")), only, str(root))
    land(root, "crime", "crime_2.csv", [dict(sal_code="S9", period="20x6", offence_count_total="abc")], "b2")
    with open(root / "crime" / "crime_2.csv", "a") as f:
        f.write("S8,2011,5,SYNTHETIC,b2,surplus\n")
    assert pipe.run("a").status == "SUCCESS"
    found = pipe.log.dq_results().where("entity = 'crime'").collect()
    found = {(r["batch_id"], r["rule_name"]): (r["rows_evaluated"], r["rows_failed"]) for r in found}
    assert found == {
        ("b1", "code_there"): (9, 0), ("b2", "code_there"): (2, 0),
        ("b1", "source_is_configured"): (9, 0), ("b2", "source_is_configured"): (2, 0),
        ("b2", "cast_failed__period"): (2, 1), ("b2", "cast_failed__offence_count_total"): (2, 1),
        (None, "one_period"): (11, 3), (None, "many_rows"): (1, 1),
    }
    kept = pipe.bronze(only["crime"]).read().where("corrupt_record IS NOT NULL").collect()
    assert [r["corrupt_record"] for r in kept] == ["S8,2011,5,SYNTHETIC,b2,surplus"]

    # the same batch delivered again: a run that fails, then one that takes the fix
    land(root, "crime", "crime_3.csv", [dict(sal_code="", period=2021, offence_count_total=1)], "b2")
    with pytest.raises(QualityError, match="code_there"):
        pipe.run("b")
    land(root, "crime", "crime_4_upd.csv", [dict(sal_code="", period=2021, offence_count_total=2)], "b3")
    pipe.registry = registry.Registry((known["suburb_ref"], replace(known["crime"], rules=rules[:2])))
    assert (pipe.run("c").rows_read, pipe.run("d").status) == (2, "NO_OP")
    runs = {r["run_id"]: (r["status"], r["rows_read"], sorted(r["batch_ids"])) for r in pipe.log.runs().collect()}
    assert runs == {"a": ("SUCCESS", 14, ["b1", "b2"]), "b": ("FAILED", 1, ["b2"]), "c": ("SUCCESS", 2, ["b2", "b3"]), "d": ("NO_OP", 0, [])}
    crime = pipe.source_registry().where("entity = 'crime'")
    assert rows(crime, "batch_id", "rows_written") == [("b1", 9), ("b2", 3), ("b3", 1)]
    assert pipe.trace("crime").count() == pipe.lake.read("gold", "fact_crime").count() == 12
