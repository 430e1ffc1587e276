"""Every registered query against its SQL twin on DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return check_oracle.connect(sf)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, sf, name):
    status, note, _ = check_oracle.compare(spark, duck, sf, name, entry.queries()[name], SQL.get(name))
    assert status in ("OK", "ROWS"), note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["priority", "lines", "revenue"] and df.count() > 1


def test_reads_only_needed_columns_and_pushes_filters(spark, sf):
    plan = entry.queries()["dq_warn_drop"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan
    plan = entry.queries()["binned_median"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan
