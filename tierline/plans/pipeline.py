"""The whole warehouse from configuration: files -> bronze -> silver -> gold -> log.

A new entity is a new entry in the registry. Tables become visible together, by one append to
the publication log after every quality rule has passed; a failed run publishes nothing.

A run costs what it brings. New files are judged by themselves; a delivered grain replaces the silver row
it had, in the partitions concerned; facts are rebuilt for the years of these grains and for the years in which keys
with a changed history occur; dimensions are published again where their history changed. All other
partitions and tables are listed where they are. An entity whose configuration has changed is rebuilt in full.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierline.functions.columns import LINEAGE, UNKNOWN_SK, period_date
from tierline.operators import quality
from tierline.operators.history import with_surrogate_key
from tierline.operators.shaping import dedup_latest, failed_casts, typed_select
from tierline.operators.star import build_fact, dim_year, upsert, without
from tierline.plans import runlog
from tierline.plans.runlog import RunLog
from tierline.registry import Entity, Registry, batch_rules, rules_of
from tierline.session import history_buckets, materialize
from tierline.sources.lake import Lake, Staged, part
from tierline.streaming.changes import HistoryTable, change_feed, run_feed
from tierline.streaming.ingest import Bronze, Ingested, ingest

# Fixed value: how a restating file is named.
RESTATEMENT = r"_upd\.csv"


@dataclass(frozen=True)
class RunResult:
    run_id: str
    status: str
    rows_read: int
    rows_written: int


@dataclass
class Load:
    """What loading one entity gave: counts, what must stop the run, staged tables with all rows and rows written now."""

    entity: Entity
    counts: dict[str, int]
    failures: list[str]
    results: DataFrame
    tables: list[tuple] = field(default_factory=list)


@dataclass
class Dimension:
    """A dimension as of this run; the keys whose history changed since it was published, None for all of them."""

    rows: DataFrame
    changed: DataFrame | None
    same: bool = False


@dataclass
class Pipeline:
    lake: Lake
    registry: Registry
    landing: str
    env: str = "dev"
    name: str = "tierline"
    # a name for the streams' state; a new one replays everything into new tables. By default the
    # one that was published last
    generation: str | None = None
    side_by_side: int = 8

    def __post_init__(self):
        self.spark = self.lake.spark
        self.log = RunLog(self.lake)
        if self.generation is None:
            last = self.lake.published().get(("metadata", "generation"))
            self.generation = last.path if last else "g0"

    # ---- layers -----------------------------------------------------------------------------

    def bronze(self, e: Entity) -> Bronze:
        return Bronze(self.spark, f"{self.lake.path('bronze', f'raw_{e.name}')}/{self.generation}")

    def history(self, e: Entity) -> HistoryTable:
        carried = tuple(c for c in e.column_names if c not in (*e.keys, *e.track, e.sequence_by))
        lineage = ("source_system", "batch_id", "ingested_at", "source_file")
        typed = self.spark.range(0).select(
            *[F.lit(None).cast(t).alias(c) for c, t in e.columns],
            *[F.lit(None).cast("timestamp" if c == "ingested_at" else "string").alias(c) for c in lineage],
        )
        return HistoryTable(
            self.spark,
            f"{self.lake.path('gold', f'dim_{e.name}_history')}/{self.generation}",
            typed.schema,
            e.keys,
            e.sequence_by,
            e.track,
            (*carried, "source_system", "batch_id", "ingested_at"),
            # the newest arrival wins a tie, then a fixed order of the values
            ("ingested_at", "source_file", *e.track, *carried),
            buckets=history_buckets(self.spark),
        )

    def silver(self, e: Entity, raw: DataFrame) -> DataFrame:
        """Newest row of each grain, typed. A restating file beats a base file of its ingest."""
        restates = F.col("source_file").rlike(RESTATEMENT)
        order = [F.col("ingested_at"), restates, F.col("source_modified_at"), F.col("source_file")]
        # rows of one file tie: the greatest values win, so every computation picks the same row
        ties = [F.col(c) for c in dict.fromkeys((*e.column_names, *LINEAGE)) if c in raw.columns]
        newest = dedup_latest(raw, list(e.grain), [*order, *ties])
        return typed_select(newest.withColumn("failed_casts", failed_casts(e.columns)), e.columns, extra=("failed_casts",))

    def fact(self, e: Entity, measures: DataFrame, dims: dict[str, DataFrame], years: DataFrame) -> DataFrame:
        dim, key = self.registry.dimension_of(e)
        period = F.col(e.period)
        bound = build_fact(
            measures, dims[dim.name], years, key, period_date(period), period,
            f"{dim.name}_sk", dim.keys[0], leave_out=(e.period,),
        )
        return bound.withColumn("gold_loaded_at", F.current_timestamp())

    # ---- one run ----------------------------------------------------------------------------

    def _stage(self, df: DataFrame, layer: str, table: str, partition_by=()):
        """Write a table aside; its rows are counted during the write."""
        seen = Observation()
        staged = self.lake.stage(df.observe(seen, F.count(F.lit(1)).alias("n")), layer, table, partition_by)
        return staged, seen.get["n"]

    def _made_from(self, e: Entity, **more) -> dict:
        """What a published table of an entity depends on besides its rows."""
        said = repr((e, self.registry.dimension_of(e)[0].keys if e.kind == "measure" else None))
        return {"generation": self.generation, "configuration": hashlib.sha256(said.encode()).hexdigest(), **more}

    def _goes_on(self, published, e: Entity) -> bool:
        """Whether a published table can be brought up to date instead of being built anew."""
        made = published.made_from if published else None
        return bool(made) and all(made.get(k) == v for k, v in self._made_from(e).items())

    def _taken(self, e: Entity, last) -> int:
        """The newest batch of an entity that is in its published tables."""
        generation, _, batch = last.path.rpartition("/") if last else ("", "", "")
        return int(batch) if generation == self.generation else -1

    def _pending(self, e: Entity, last) -> tuple[str, tuple[int, int, list[str]]]:
        """What an entity's files brought since the run that published last, failed runs included."""
        bronze, after = self.bronze(e), self._taken(e, last)
        return e.name, bronze.since(after) if bronze.columns() else (0, after, [])

    def _settled(self, run_id: str) -> bool:
        """Whether the run before this one finished: if not, its files still wait for a rebuild."""
        before = self.log.runs().where(F.col("run_id") != run_id)
        status = before.agg(F.max_by("status", "started_at")).first()[0]
        return status in (None, runlog.SUCCESS, runlog.NO_OP)

    def _load(self, run_id: str, read: dict) -> tuple[str, int]:
        """Status and rows written; ``read`` takes what was read, also of a run that fails."""
        taken = dict(self._each(self.registry.entities, self._ingest))
        self.log.record_flows(run_id, {f"raw_{name}": t.rows for name, t in taken.items()})
        if not any(t.files for t in taken.values()) and self._settled(run_id):
            return runlog.NO_OP, 0

        last = self.lake.published()
        pending = dict(self._each(self.registry.entities, lambda e: self._pending(e, last.get(("metadata", f"taken_{e.name}")))))
        read["rows"] = sum(n for n, _, _ in pending.values())
        read["batches"] = sorted({b for _, _, ids in pending.values() for b in ids})

        dims: dict[str, Dimension] = {}
        loads: list[Load] = []
        for name, dim, load in self._each(self.registry.references, lambda e: self._reference(e, last)):
            dims[name] = dim
            loads.append(load)
        years, loads_of_years = self._years(last)
        loads += self._each(self.registry.measures, lambda e: self._measure(e, dims, years, last))
        self.log.record_quality(run_id, [(x.entity, x.counts, x.results) for x in loads])
        tables = [t for x in loads for t in x.tables] + loads_of_years
        self.log.record_flows(run_id, {t: n for _, t, _, _, n in tables})
        failures = [f for x in loads for f in x.failures]
        if failures:
            raise quality.QualityError("; ".join(failures))

        publish = [t[:4] for t in tables] + [("metadata", "generation", (self.generation, "{}"), 0)]
        for name, (n, batch, _) in pending.items():
            publish.append(("metadata", f"taken_{name}", (f"{self.generation}/{batch}", "{}"), n))
        self.lake.publish_all(publish, run_id)
        return runlog.SUCCESS, sum(n for layer, _, _, _, n in tables if layer in ("silver", "gold"))

    def _years(self, last) -> tuple[DataFrame, list[tuple]]:
        """The year dimension: always the same, written once."""
        now = last.get(("gold", "dim_year"))
        if now:
            return self.lake.open(now), []
        staged, n = self._stage(dim_year(self.spark), "gold", "dim_year")
        return self.lake.open(staged), [("gold", "dim_year", staged, n, n)]

    # ---- one entity -------------------------------------------------------------------------

    def _each(self, entities, work) -> list:
        """Entities do not depend on each other; their Spark jobs run side by side."""
        with ThreadPoolExecutor(max_workers=self.side_by_side) as pool:
            return [r for r in pool.map(work, entities) if r is not None]

    def _ingest(self, e: Entity) -> tuple[str, Ingested]:
        return e.name, ingest(self.spark, f"{self.landing}/{e.landing_path}", self.bronze(e))

    def _judged(self, e: Entity, typed: DataFrame, counted_only: bool = False) -> tuple[DataFrame, Entity]:
        """Rows marked with the rules they violate, once for all who read them, and the entity with all its rules.
        What is only counted is kept without the columns no count looks at."""
        rules = e.rules + ((e.source_rule,) if "source_system" in typed.columns else ())
        marked = quality.marked(typed, rules)
        if counted_only:
            looked_at = {"failed_rules", "failed_casts", "batch_id", *(c for r in batch_rules(rules) for c in r.columns)}
            marked = marked.select(*[c for c in marked.columns if c in looked_at])
        return materialize(self.spark, marked), replace(e, rules=rules)

    def _counted(self, e: Entity, checked: DataFrame, whole: DataFrame | None = None, older: int | None = None) -> Load:
        counts = quality.marked_counts(checked, e.rules, whole, older)
        failures = [f"{e.name}.{b.rule}: {b.detail}" for b in quality.breaches(counts, e.rules)]
        return Load(e, counts, failures, quality.results_by_batch(checked, e.rules, e.columns))

    def changes(self, e: Entity) -> str:
        """Where the published change feed of a reference is."""
        return f"{self.lake.path('silver', f'{e.name}_changes')}/{self.generation}"

    def _reference(self, e: Entity, last) -> tuple[str, Dimension, Load] | None:
        """New rows to the change feed, from there to the history, from there to the dimension."""
        bronze, history, path = self.bronze(e), self.history(e), self.changes(e)
        if not bronze.columns():
            return None
        raw = bronze.read_since(self._taken(e, last.get(("metadata", f"taken_{e.name}")))).drop("_batch")
        typed = typed_select(raw.withColumn("failed_casts", failed_casts(e.columns)), e.columns, extra=("failed_casts",))
        load = self._counted(*reversed(self._judged(e, typed, counted_only=True)))
        published = last.get(("gold", f"dim_{e.name}"))
        if load.failures:
            # what must not be published must not reach the history either; it stays pending
            return e.name, Dimension(self.lake.open(published) if published else with_surrogate_key(history.read(), list(e.keys), f"{e.name}_sk"), None), load

        feed = change_feed_of(bronze.read_stream(), e)
        n = run_feed(feed, f"{path}/data", f"{path}/checkpoint")
        stream = self.spark.readStream.schema(feed.schema).parquet(f"{path}/data")
        history.run(stream)
        known = last.get(("silver", f"{e.name}_changes"))
        before = known.rows if known and known.path == f"{path}/data" else 0
        load.tables.append(("silver", f"{e.name}_changes", Staged(f"{path}/data", feed.schema.json()), before + n, n))

        newest = history.versions.newest()
        if self._goes_on(published, e):
            if published.made_from["history"] == newest:
                return e.name, Dimension(self.lake.open(published), None, same=True), load
            changed = history.versions.changed_since(published.made_from["history"])
        else:
            changed = None
        dim = with_surrogate_key(history.read(), list(e.keys), f"{e.name}_sk")
        staged, n = self._stage(dim, "gold", f"dim_{e.name}")
        load.tables.append(("gold", f"dim_{e.name}", staged._replace(made_from=self._made_from(e, history=newest)), n, n))
        return e.name, Dimension(self.lake.open(staged), changed), load

    def _replaced(self, e: Entity, old, grains: DataFrame) -> dict:
        """Rows of a published table that new ones of their grain replace, by the period they had: read from
        the columns of the grain and the period."""
        if not old:
            return {}
        grain = list(e.grain)
        gone = without(self.lake.open(old).select(*dict.fromkeys((*grain, e.period))), grains, grain, "left_semi")
        return {r[0]: r[1] for r in gone.groupBy(e.period).count().collect()}

    def _merged(self, layer: str, table: str, e: Entity, old, incoming: DataFrame, grains: DataFrame, periods: set, replaced: dict) -> tuple[Staged, set[str], int]:
        """Put rows into the partitions they belong to, in place of those of the same grains. Other partitions are not opened."""
        grain = list(e.grain)
        # a grain may have moved
        touched = {part(e.period, p) for p in (*periods, *replaced)}
        if old:
            rows = upsert(self.lake.open(old, touched), incoming, grain, grains)
        else:
            rows = incoming
        staged = self.lake.stage_parts(rows, layer, table, e.period, old, touched)
        written = sum(n for name, (_, n) in staged.parts.items() if name in touched)
        return staged._replace(made_from=self._made_from(e)), touched, written

    def _measure(self, e: Entity, dims: dict[str, Dimension], years: DataFrame, last) -> Load | None:
        bronze = self.bronze(e)
        if not bronze.columns():
            return None
        tables = {t: last.get(t) for t in (("silver", e.name), ("metadata", f"dq_quarantine_{e.name}"), ("gold", f"fact_{e.name}"))}
        silver, aside, fact = (p if self._goes_on(p, e) else None for p in tables.values())
        if not (silver and fact):
            silver = aside = fact = None
        raw = bronze.read_since(self._taken(e, last.get(("metadata", f"taken_{e.name}"))) if silver else -1).drop("_batch")
        # judged once, then read: silver, quarantine and all counts see the same rows
        checked, judged = self._judged(e, self.silver(e, raw))
        # joined to as they are: who is given twice goes once
        grains = checked.select(*e.grain)
        replaced, replaced_aside = (self._replaced(e, p, grains) for p in (silver, aside))
        whole, older = None, 0
        if silver and batch_rules(e.rules):
            held = sum(n for p in (silver, aside) if p for _, n in p.parts.values())
            older = held - sum(replaced.values()) - sum(replaced_aside.values())
            names = [c for c in checked.columns if c not in ("failed_rules", "failed_casts")]
            kept = [without(self.lake.open(p).select(*names), grains, list(e.grain)) for p in (silver, aside) if p]
            whole = reduce(DataFrame.unionByName, [*kept, checked.select(*names)])
        load = self._counted(judged, checked, whole, older)
        if load.failures:
            return load
        warn = F.array(*[F.lit(r.name) for r in rules_of(e.rules, "WARN")]).cast("array<string>")
        drops = F.array_intersect("failed_rules", warn)
        good = checked.where(F.size(drops) == 0).drop("failed_rules", "failed_casts")
        bad = checked.where(F.size(drops) > 0).drop("failed_casts").withColumns(
            {"failed_rules": drops, "entity": F.lit(e.name), "quarantined_at": F.current_timestamp()}
        )
        # as many values as the new rows have periods
        periods = {r[0] for r in checked.select(e.period).distinct().collect()}
        touched: set[str] = set()
        if load.counts["n"] or not silver:
            staged, touched, n = self._merged("silver", e.name, e, silver, good, grains, periods, replaced)
            load.tables.append(("silver", e.name, staged, sum(x for _, x in staged.parts.values()), n))
            if aside or load.counts["n"] != n or silver:
                staged_aside, _, m = self._merged("metadata", f"dq_quarantine_{e.name}", e, aside, bad, grains, periods, replaced_aside)
                if staged_aside.parts or aside:
                    load.tables.append(("metadata", f"dq_quarantine_{e.name}", staged_aside, sum(x for _, x in staged_aside.parts.values()), m))
        else:
            staged = silver
        self._fact_of(e, load, staged, touched, dims, years, fact)
        return load

    def _fact_of(self, e: Entity, load: Load, silver, touched: set[str], dims: dict[str, Dimension], years: DataFrame, old) -> None:
        """Rebuild the years of the touched periods, and those of keys whose history changed."""
        ref, key = self.registry.dimension_of(e)
        dim = dims[ref.name]
        if old and not dim.same:
            if dim.changed is None:
                old = None
            else:
                changed = dim.changed.withColumnRenamed(ref.keys[0], key)
                others = self.lake.open(silver, set(silver.parts) - touched)
                seen = others.select(key, e.period).join(changed.select(key), key, "left_semi")
                touched = touched | {part(e.period, r[0]) for r in seen.select(e.period).distinct().collect()}
        if old and not touched:
            return
        # a period outside the calendar goes to the unknown year, together with all others of its kind
        calendar = {part(e.period, r[0]): part("year_sk", r[1]) for r in years.select("year", "year_sk").collect()}
        unknown = part("year_sk", UNKNOWN_SK)
        parts = {calendar.get(p, unknown) for p in touched} if old else None
        chosen = {p for p in silver.parts if old is None or calendar.get(p, unknown) in parts}
        rows = self.fact(e, self.lake.open(silver, chosen), {n: d.rows for n, d in dims.items()}, years).hint("rebalance", "year_sk")
        staged = self.lake.stage_parts(rows, "gold", f"fact_{e.name}", "year_sk", old, parts)
        total = sum(n for _, n in staged.parts.values())
        n = total if old is None else sum(n for name, (_, n) in staged.parts.items() if name in parts)
        load.tables.append(("gold", f"fact_{e.name}", staged._replace(made_from=self._made_from(e)), total, n))

    def source_registry(self) -> DataFrame:
        """Rows every delivered batch brought to every entity: one row each, however often it was delivered."""
        parts = [self.bronze(e).sources().withColumn("entity", F.lit(e.name)) for e in self.registry.entities]
        return _summed(reduce(DataFrame.unionByName, parts), "batch_id", "source_system", "entity")

    def trace(self, entity: str) -> DataFrame:
        """Fact rows with the batches they came from."""
        mine = _summed(self.source_registry().where(F.col("entity") == entity), "batch_id", "entity")
        return runlog.batch_trace(self.lake.read("gold", f"fact_{entity}"), mine)

    def run(self, run_id: str | None = None, trigger: str = "manual") -> RunResult:
        run_id = run_id or uuid.uuid4().hex
        self.log.open(run_id, self.name, self.env, trigger)
        read = {"rows": 0, "batches": []}
        try:
            status, written = self._load(run_id, read)
        except Exception as exc:
            self.log.close(run_id, runlog.FAILED, read["batches"], read["rows"], 0, type(exc).__name__, str(exc))
            raise
        self.log.close(run_id, status, read["batches"], read["rows"], written)
        return RunResult(run_id, status, read["rows"], written)

    def full_refresh(self, run_id: str | None = None) -> RunResult:
        """Replay every landing file into new streams and tables; the old ones stay in use until
        the new ones are published, and remain so if the replay fails."""
        before, self.generation = self.generation, f"g-{uuid.uuid4().hex}"
        try:
            return self.run(run_id, "full_refresh")
        except Exception:
            self.generation = before
            raise


def _summed(sources: DataFrame, *by: str) -> DataFrame:
    return sources.groupBy(*by).agg(F.sum("rows_written").alias("rows_written"), F.max("generated_at").alias("generated_at"))


def change_feed_of(raw: DataFrame, e: Entity) -> DataFrame:
    feed = change_feed(raw, e.columns, extra=("source_file",))
    for c in ("source_system", "batch_id"):
        if c not in feed.columns:
            feed = feed.withColumn(c, F.lit(None).cast("string"))
    return feed
