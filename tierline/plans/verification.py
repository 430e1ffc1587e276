"""Checks and diagnostics over a published lake, for every entity of a registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators import checks
from tierline.operators.star import orphan_keys
from tierline.plans.pipeline import Pipeline
from tierline.plans.runlog import flow_order
from tierline.session import materialize


def row_flow(pipe: Pipeline) -> DataFrame:
    """Rows of each measure in bronze, silver and gold, with what was lost between them."""
    read = pipe.lake.reader()
    return checks.row_flow({
        e.name: (pipe.bronze(e).read(), read("silver", e.name), read("gold", f"fact_{e.name}")) for e in pipe.registry.measures
    })


def verify(pipe: Pipeline, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """All checks as (check, result, detail), in the order of the layers. Every table is read once."""
    registry, read = pipe.registry, pipe.lake.reader()
    years = read("gold", "dim_year")
    dims = {f"dim_{e.name}": (read("gold", f"dim_{e.name}"), f"{e.name}_sk", e.keys[0]) for e in registry.references}
    facts = {}
    for e in registry.measures:
        sk = f"{registry.dimension_of(e)[0].name}_sk"
        facts[f"fact_{e.name}"] = (read("gold", f"fact_{e.name}"), dims[f"dim_{registry.dimension_of(e)[0].name}"][0], years, sk, [sk, "year_sk"])
    layers = {e.name: (pipe.bronze(e).read(), read("silver", e.name)) for e in registry.measures}
    # a row per table
    measured = materialize(pipe.lake.spark, checks.summaries(facts, dims, views or {}, layers))
    found = checks.report(pipe.log.runs(), measured, registry.settings(pipe.env).unknown_rate_pct)
    return found.orderBy("stage", "at", "part").select("check", "result", "detail")


def diagnose_fact(pipe: Pipeline, entity: str) -> dict[str, DataFrame]:
    """Why a fact does not resolve: coverage of the dimension, resolution per year, lost keys."""
    e = pipe.registry[entity]
    ref, _ = pipe.registry.dimension_of(e)
    sk, lake = f"{ref.name}_sk", pipe.lake
    fact, dim = lake.read("gold", f"fact_{entity}"), lake.read("gold", f"dim_{ref.name}")
    years = lake.read("gold", "dim_year")
    return {
        "coverage": checks.dim_coverage(dim, list(ref.keys)),
        "by_year": checks.resolution_by_year(fact, years, sk).orderBy("year"),
        "unknown": checks.unknown_rate(fact, sk),
        "orphans": orphan_keys(fact, dim, sk),
    }


def diagnose_silver(pipe: Pipeline, entity: str) -> dict[str, DataFrame]:
    """Where rows vanish before the fact: per layer, by key, by rule, in order of the flows."""
    e = pipe.registry[entity]
    return {
        "flow": row_flow(pipe).where(F.col("entity") == entity),
        "keys": checks.key_health(pipe.bronze(e).read(), e.grain[0], list(e.grain)),
        "rules": pipe.log.dq_results().where(F.col("entity") == entity),
        "order": flow_order(pipe.log.events(), f"raw_{entity}", f"flow {entity}", f"fact_{entity}"),
    }
