"""Runs that bring something new to a published warehouse: what they write, what they leave, and that a
replay of everything gives the same tables."""

from dataclasses import replace
from pathlib import Path

import pytest

from test_pipeline import YEARS, land, land_all, rows, suburb
from tierline import registry
from tierline.operators.quality import QualityError
from tierline.plans.pipeline import Pipeline
from tierline.sources.lake import Lake

KNOWN = {e.name: e for e in registry.load().entities}
ONLY = registry.Registry((KNOWN["suburb_ref"], KNOWN["crime"]))
STAMPS = ("gold_loaded_at", "ingested_at", "source_file", "source_modified_at", "quarantined_at")


def start(spark, tmp_path, only=ONLY):
    land_all(tmp_path / "landing")
    pipe = Pipeline(Lake(spark, str(tmp_path / "lake")), only, str(tmp_path / "landing"))
    assert pipe.run("first").status == "SUCCESS"
    return pipe


def crime(code, year, n):
    return dict(sal_code=code, period=year, offence_count_total=n)


def files_of(df):
    """Per partition folder, the files a table is read from."""
    out = {}
    for f in df.inputFiles():
        path = Path(f.removeprefix("file://"))
        out.setdefault(path.parent.name, set()).add((str(path), path.stat().st_mtime_ns))
    return out


def table(lake, layer, name):
    df = lake.read(layer, name)
    return sorted(map(tuple, df.drop(*STAMPS).collect()), key=str)


def same_as_replayed(pipe):
    tables = [("silver", "crime"), ("gold", "fact_crime"), ("gold", "dim_suburb_ref")]
    before = [table(pipe.lake, *t) for t in tables]
    assert pipe.full_refresh().status == "SUCCESS"
    assert [table(pipe.lake, *t) for t in tables] == before


def test_a_new_period_and_a_restated_one_leave_other_years_alone(spark, tmp_path):
    pipe = start(spark, tmp_path)
    silver, fact = files_of(pipe.lake.read("silver", "crime")), files_of(pipe.lake.read("gold", "fact_crime"))
    assert set(silver) == {f"period={y}" for y in YEARS} and set(fact) == {f"year_sk={y}" for y in YEARS}
    dim, years = (pipe.lake.published()["gold", t] for t in ("dim_suburb_ref", "dim_year"))
    land(tmp_path / "landing", "crime", "crime_2.csv", [crime("S1", 2016, 7), crime("S4", 2016, 1), crime("S2", 2022, 3)], "b2")
    done = pipe.run("second")
    assert (done.rows_read, done.rows_written) == (3, 2 * (4 + 1))
    for before, now in ((silver, files_of(pipe.lake.read("silver", "crime"))), (fact, files_of(pipe.lake.read("gold", "fact_crime")))):
        changed = {k for k in now if before.get(k) != now[k]}
        assert len(now) == 4 and {k.split("=")[1] for k in changed} == {"2016", "2022"}
    assert [pipe.lake.published()["gold", t] for t in ("dim_suburb_ref", "dim_year")] == [dim, years]
    got = pipe.lake.read("silver", "crime")
    assert rows(got.where("period >= 2016 AND sal_code <> 'S3'"), "sal_code", "period", "offence_count_total") == [
        ("S1", 2016, 7), ("S1", 2021, 302), ("S2", 2016, 201), ("S2", 2021, 202), ("S2", 2022, 3), ("S4", 2016, 1)]
    # S4 is in no dimension
    assert pipe.lake.read("gold", "fact_crime").where("suburb_ref_sk = -1").count() == 1
    same_as_replayed(pipe)


def test_a_changed_history_rebuilds_the_years_of_its_key(spark, tmp_path):
    pipe = start(spark, tmp_path)
    land(tmp_path / "landing", "crime", "crime_2.csv", [crime("S1", 2022, 7), crime("S9", 1960, 1), crime("S9", "x", 2)], "b2")
    pipe.run("second")
    silver, fact = files_of(pipe.lake.read("silver", "crime")), files_of(pipe.lake.read("gold", "fact_crime"))
    assert set(fact) == {f"year_sk={y}" for y in (-1, *YEARS, 2022)}
    land(tmp_path / "landing", "suburb_ref", "suburb_ref_2.csv", [suburb("S9", "New", "L1", 1.0, "1950-01-01T00:00:00")], "a2")
    done = pipe.run("third")
    assert done.rows_read == 1 and files_of(pipe.lake.read("silver", "crime")) == silver
    now = files_of(pipe.lake.read("gold", "fact_crime"))
    assert {k for k in now if fact.get(k) != now[k]} == {"year_sk=-1"}
    # of the two rows of the unknown year, one has a key that is known now; the other has no date to be known at
    got = pipe.lake.read("gold", "fact_crime").where("year_sk = -1")
    assert sorted(r["suburb_ref_sk"] == -1 for r in got.collect()) == [False, True]


def test_rows_that_move_or_fail_leave_their_old_place(spark, tmp_path):
    loose = replace(KNOWN["crime"], grain=("sal_code",), rules=(registry.Rule("few", "value_range", "WARN", column="offence_count_total", min=0, max=1000),
                                                               registry.Rule("some", "row_count_min", "FATAL", min=3),
                                                               registry.Rule("single", "unique", "WARN", columns=("offence_count_total",))))
    pipe = start(spark, tmp_path, registry.Registry((KNOWN["suburb_ref"], loose)))
    kept = rows(pipe.lake.read("silver", "crime"), "sal_code")
    assert len(kept) == 3 and len(pipe.lake.published()["silver", "crime"].parts) == 1
    land(tmp_path / "landing", "crime", "crime_2.csv", [crime("S1", 2011, 7), crime("S2", 2016, 5000), crime("S5", 2016, 7)], "b2")
    pipe.run("second")
    assert [r[0] for r in rows(pipe.lake.read("silver", "crime"), "sal_code", "period")] == ["S1", "S3", "S5"]
    assert rows(pipe.lake.read("metadata", "dq_quarantine_crime"), "sal_code", "offence_count_total") == [("S2", 5000)]
    # all rows of the table count for rules on tables, new ones only for rules on rows
    found = {(r["run_id"], r["batch_id"], r["rule_name"]): (r["rows_evaluated"], r["rows_failed"]) for r in pipe.log.dq_results().collect()}
    assert found["second", "b2", "few"] == (3, 1) and found["second", None, "single"] == (4, 1) and found["second", None, "some"] == (1, 0)
    assert not [k for k in found if k[:2] == ("second", "b1")]
    land(tmp_path / "landing", "crime", "crime_3.csv", [crime("S2", 2011, 3)], "b3")
    pipe.run("third")
    assert rows(pipe.lake.read("silver", "crime"), "sal_code", "period")[1] == ("S2", 2011)
    assert pipe.lake.read("metadata", "dq_quarantine_crime").count() == 0
    # other rules: built anew from all rows
    pipe.registry = registry.Registry((KNOWN["suburb_ref"], replace(loose, rules=loose.rules[1:])))
    land(tmp_path / "landing", "crime", "crime_4.csv", [crime("S7", 2011, 9000)], "b4")
    assert pipe.run("fourth").rows_read == 1 and pipe.lake.read("silver", "crime").count() == 5


def test_a_foreign_source_stops_the_run_wherever_it_lands(spark, tmp_path):
    pipe = start(spark, tmp_path)
    published = pipe.lake.published()
    for entity, row in (("crime", crime("S1", 2021, 7)), ("suburb_ref", suburb("S1", "Odd", "L1", 1.0, "2020-01-01T00:00:00"))):
        folder = tmp_path / "landing" / entity
        path = folder / f"{entity}_9.csv"
        path.write_text(",".join([*row, "source_system", "batch_id"]) + "\n" + ",".join(map(str, [*row.values(), "ELSEWHERE", "b9"])) + "\n")
        with pytest.raises(QualityError, match=f"{entity}.source_is_configured"):
            pipe.run(f"bad-{entity}")
    assert pipe.lake.published() == published
    found = pipe.log.dq_results().where("rule_name = 'source_is_configured' AND run_id = 'bad-suburb_ref'")
    assert rows(found, "entity", "batch_id", "rows_evaluated", "rows_failed") == [("crime", "b9", 1, 1), ("suburb_ref", "b9", 1, 1)]
    assert rows(pipe.lake.read("gold", "dim_suburb_ref"), "suburb_name") == [("Ash",), ("Birch",), ("Cedar",)]


def test_the_change_feed_is_a_table_of_its_own_and_lost_values_in_it_are_counted(spark, tmp_path):
    pipe = start(spark, tmp_path)
    feed = lambda: rows(pipe.lake.read("silver", "suburb_ref_changes"), "sal_code", "suburb_name")
    assert feed() == [("S1", "Ash"), ("S2", "Birch"), ("S3", "Cedar")]
    land(tmp_path / "landing", "suburb_ref", "suburb_ref_2.csv", [suburb("S1", "Ash East", "L1", "wide", "2020-01-01T00:00:00")], "a2")
    pipe.run("second")
    assert feed() == [("S1", "Ash"), ("S1", "Ash East"), ("S2", "Birch"), ("S3", "Cedar")]
    assert pipe.lake.published()["silver", "suburb_ref_changes"].rows == 4
    found = pipe.log.dq_results().where("entity = 'suburb_ref' AND run_id = 'second'")
    assert rows(found, "batch_id", "rule_name", "rows_failed") == [("a2", "cast_failed__area_sqkm", 1), ("a2", "source_is_configured", 0)]
    assert pipe.run("third").status == "NO_OP" and len(feed()) == 4
