"""Registered queries: run log, health, alerts, provenance, verification, scalar functions.

The pipeline's own records are derived from ``events``: an hour is a run, a day is a batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.functions.columns import exact_round, thousands
from tierline.operators import checks, quality
from tierline.operators.star import dim_year
from tierline.plans import runlog
from tierline.plans.retail.base import FACT, dimension, query, sales_fact, table
from tierline.plans.retail.quality import EVENT_RULES, FLOW, flow_tables
from tierline.registry import Settings
from tierline.session import materialize
from tierline.streaming import ingest



def k_value():
    return F.get_json_object("props", "$.k").cast("long")


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
SETTINGS = Settings(env="prod", freshness_hours=192, warn_pass_rate_threshold=0.8)


def run_events(spark, sf):
    """OPEN and CLOSE events of each hour's run, from one aggregation of the event table."""
    hour = F.date_format("ts", "yyyy-MM-dd HH")
    per_run = table(spark, sf, "events").groupBy(hour.alias("run_id")).agg(
        F.min("ts").alias("opened"),
        F.max("ts").alias("closed"),
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "view", k_value())), F.lit(0)).alias("rows_written"),
    )
    failed = F.col("errors") * 3 > F.col("rows_read")
    status = F.when(failed, "FAILED").when(F.col("rows_written") == 0, "NO_OP").otherwise("SUCCESS")
    text, none = "string", F.lit(None)

    def event(name, at, own):
        return F.struct(
            "run_id", F.lit(name).alias("event"), F.col(at).alias("at"),
            *[own.get(c, none.cast(t)).alias(c) for c, t in (
                ("pipeline_name", text), ("env", text), ("trigger", text), ("status", text),
                ("batch_ids", "array<string>"), ("rows_read", "bigint"), ("rows_written", "bigint"),
                ("error_class", text), ("error_message", text))],
        )

    opened = event("OPEN", "opened", {
        "pipeline_name": F.concat(F.lit("day-"), F.substring("run_id", 9, 2)), "env": F.lit("prod"), "trigger": F.lit("scheduled"),
    })
    closed = event("CLOSE", "closed", {
        "status": status, "rows_read": F.col("rows_read"), "rows_written": F.col("rows_written"),
        "error_class": F.when(failed, "EventError"),
        "error_message": F.when(failed, F.concat(F.lit("it's bad: "), F.col("errors").cast("string"))),
    })
    both = F.array(opened, F.when(F.col("purchases") > 0, closed))
    return per_run.select(F.explode(both).alias("e")).where("e IS NOT NULL").select("e.*")


RUNS = f"""
pr AS (SELECT strftime(ts, '%Y-%m-%d %H') AS run_id, min(ts) AS opened, max(ts) AS closed, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors,
         count(*) FILTER (event_type = 'purchase') AS purchases, coalesce(sum({K_SQL}) FILTER (event_type = 'view'), 0)::BIGINT AS written FROM events GROUP BY 1),
r AS (SELECT run_id, 'day-' || substr(run_id, 9, 2) AS pipeline_name, 'prod' AS env,
         CASE WHEN purchases = 0 THEN 'RUNNING' WHEN errors * 3 > n THEN 'FAILED' WHEN written = 0 THEN 'NO_OP' ELSE 'SUCCESS' END AS status,
         'scheduled' AS trigger, CASE WHEN purchases > 0 THEN n END AS rows_read, CASE WHEN purchases > 0 THEN written END AS rows_written,
         opened AS started_at, CASE WHEN purchases > 0 THEN closed END AS ended_at,
         CASE WHEN purchases > 0 AND errors * 3 > n THEN 'EventError' END AS error_class,
         CASE WHEN purchases > 0 AND errors * 3 > n THEN 'it''s bad: ' || errors END AS error_message FROM pr)
"""
HEALTH = RUNS + f""",
dq AS (SELECT strftime(ts, '%Y-%m-%d %H') AS run_id, count(*) AS n, count(*) FILTER (value BETWEEN 0 AND 100) AS a,
        count(*) FILTER (event_type IN ('click', 'view', 'purchase', 'signup')) AS b, count(*) FILTER ({K_SQL} < 90) AS c FROM events GROUP BY 1),
hl AS (SELECT r.*, date_sub('second', started_at, ended_at) AS duration_seconds,
        nullif(concat_ws(',', CASE WHEN 1 - (n - c)::DOUBLE / n < 0.8::DOUBLE THEN 'k_small' END, CASE WHEN 1 - (n - b)::DOUBLE / n < 0.8::DOUBLE THEN 'type_known' END,
               CASE WHEN 1 - (n - a)::DOUBLE / n < 0.8::DOUBLE THEN 'value_small' END), '') AS failing_rules, false AS fatal_tripped
       FROM r JOIN dq USING (run_id))
"""


@query("run_log", f"WITH {RUNS} SELECT * FROM r")
def run_log(spark, sf):
    """State of every run from its OPEN and CLOSE events."""
    return runlog.run_state(run_events(spark, sf)).drop("batch_ids")


def health_rows(spark, sf):
    results = quality.rule_results(
        table(spark, sf, "events").withColumn("run_id", F.date_format("ts", "yyyy-MM-dd HH")), EVENT_RULES, ["run_id"]
    )
    return runlog.health(runlog.run_state(run_events(spark, sf)), results, SETTINGS)


@query("run_health", f"WITH {HEALTH} SELECT * FROM hl")
def run_health(spark, sf):
    """Runs with duration and the rules that fell below the limit, newest first."""
    rows = health_rows(spark, sf).withColumn("failing_rules", F.array_join("failing_rules", ",")).drop("batch_ids")
    return rows.orderBy(F.col("started_at").desc())


@query("alert_rows", f"""WITH {HEALTH}, a AS (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY started_at DESC) AS rn FROM hl),
  z AS (SELECT pipeline_name, run_id, status, CASE WHEN status = 'FAILED' THEN 'run failed' WHEN failing_rules IS NOT NULL THEN 'pass rate below limit'
    WHEN date_sub('hour', coalesce(ended_at, started_at), (SELECT max(ts) FROM events)) > 192 THEN 'stale' END AS reason FROM a WHERE rn = 1)
  SELECT * FROM z WHERE reason IS NOT NULL""")
def alert_rows(spark, sf):
    now = table(spark, sf, "events").agg(F.max("ts")).scalar()
    return runlog.alerts(health_rows(spark, sf), SETTINGS, now)


def _raw(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        F.col("event_type").alias("source_system"), F.col("ts").alias("ingested_at"),
    )


@query("source_registry", """SELECT strftime(ts, '%Y-%m-%d') AS batch_id, event_type AS source_system, 'events' AS entity, count(*) AS rows_written,
  max(ts) AS generated_at FROM events GROUP BY ALL""")
def source_registry(spark, sf):
    return ingest.source_registry(_raw(spark, sf), "events")


@query("batch_trace", """WITH g AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS rows_written, max(ts) AS generated_at FROM events GROUP BY 1)
  SELECT event_id, value, batch_id, rows_written, generated_at FROM events JOIN g ON batch_id = strftime(ts, '%Y-%m-%d')""")
def batch_trace(spark, sf):
    """Each fact row with the batch that brought it."""
    raw = _raw(spark, sf)
    registry = ingest.source_registry(raw, None, ("batch_id",))
    return runlog.batch_trace(raw.select("event_id", "value", "batch_id"), registry)


def _pipeline_events(spark, sf):
    details = F.concat(F.lit('{"flow_progress":{"metrics":{"num_output_rows":'), F.get_json_object("props", "$.k"), F.lit("}}}"))
    return table(spark, sf, "events").select(
        F.struct(F.date_format("ts", "yyyy-MM-dd").alias("update_id")).alias("origin"),
        F.when(F.col("event_type").isin("click", "view"), "flow_progress").otherwise(F.col("event_type")).alias("event_type"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("Completed flow raw_"), F.col("event_type"), F.lit("."), F.col("user_id").cast("string")).alias("message"),
        details.alias("details"),
    )


@query("event_metrics", f"""WITH w AS (SELECT strftime(ts, '%Y-%m-%d') AS update_id, ts, {K_SQL} AS k FROM events WHERE event_type IN ('click', 'view'))
  SELECT update_id, coalesce(sum(k), 0)::BIGINT AS rows_written FROM w WHERE update_id = (SELECT arg_max(update_id, ts) FROM w) GROUP BY 1""")
def event_metrics(spark, sf):
    """Rows the newest update wrote, from the JSON details of its flow events."""
    return runlog.rows_written_by_latest(_pipeline_events(spark, sf))


@query("event_order", """WITH m AS (SELECT ts, event_type, 'Completed flow raw_' || event_type || '.' || user_id AS message FROM events)
  SELECT strftime(ts, '%H:%M:%S.%g') AS ts, message FROM m WHERE event_type IN ('click', 'view') AND (message LIKE '%raw_view%' OR message LIKE '%.77%') ORDER BY m.ts""")
def event_order(spark, sf):
    return runlog.flow_order(_pipeline_events(spark, sf), "raw_view", ".77")


def all_checks(spark, sf):
    """A sound star and a damaged one: versions of urgent customers twice, those of low priority missing."""
    dim, years = dimension(spark, sf), dim_year(spark)
    lines = materialize(spark, sales_fact(spark, sf, dim).select("customer_sk", "year_sk", "l_quantity"))
    per_year = lines.groupBy("customer_sk", "year_sk").agg(F.sum("l_quantity").alias("quantity"))
    damaged = dim.unionByName(dim.where("o_orderpriority = '1-URGENT'")).where("o_orderpriority <> '5-LOW'")
    known_years = years.where("year <> 1997")
    grain = ["customer_sk", "year_sk"]
    layers = flow_tables(spark, sf)
    raw, typed, _ = layers.pop("sales")
    measured = materialize(spark, checks.summaries(
        {"fact_sales": (per_year, dim, years, "customer_sk", grain), "fact_lines": (lines, damaged, known_years, "customer_sk", grain)},
        {"dim_customer": (dim, "customer_sk", "o_custkey"), "dim_damaged": (damaged, "customer_sk", "o_custkey")},
        {"vw_sales": lines.where("customer_sk <> -1"), "vw_nothing": lines.where("year_sk = 1971")},
        {"lines": (raw, typed), **layers},
    ))
    return checks.report(runlog.run_state(run_events(spark, sf)), measured).select("check", "result", "detail")


CHECKS = f"""{FACT.strip()}, {FLOW.strip()}, {RUNS.strip()},
lr AS (SELECT status, coalesce(rows_written, 0) AS w FROM r ORDER BY started_at DESC LIMIT 1),
member AS (SELECT o_custkey, start_at, year_sk, priority, count(*) AS n FROM (SELECT CASE WHEN start_at IS NULL THEN NULL ELSE o_custkey END AS o_custkey, start_at, year_sk, priority FROM f) GROUP BY ALL),
broken AS (SELECT * FROM h WHERE o_orderpriority <> '5-LOW' UNION ALL SELECT * FROM h WHERE o_orderpriority = '1-URGENT'),
dims AS (SELECT 'dim_customer' AS name, * FROM h UNION ALL SELECT 'dim_damaged', * FROM broken),
names AS (SELECT DISTINCT name FROM dims),
twice AS (SELECT name, count(*) AS n FROM (SELECT name FROM dims GROUP BY name, o_custkey, "__START_AT" HAVING count(*) > 1) GROUP BY name),
opened AS (SELECT name, count(*) AS n FROM (SELECT name FROM dims WHERE "__END_AT" IS NULL GROUP BY name, o_custkey HAVING count(*) > 1) GROUP BY name),
calendar AS (SELECT y AS year_sk FROM range(1971, 2031) t(y)),
facts AS (
  SELECT 'fact_sales' AS name, 1 AS n, m.o_custkey, m.start_at, m.year_sk, EXISTS (SELECT 1 FROM h WHERE h.o_custkey = m.o_custkey AND h."__START_AT" = m.start_at) AS there,
         m.year_sk IN (SELECT year_sk FROM calendar) AS dated FROM member m
  UNION ALL SELECT 'fact_lines', m.n, m.o_custkey, m.start_at, m.year_sk, EXISTS (SELECT 1 FROM broken b WHERE b.o_custkey = m.o_custkey AND b."__START_AT" = m.start_at),
         m.year_sk IN (SELECT year_sk FROM calendar WHERE year_sk <> 1997) FROM member m),
fs AS (SELECT name, sum(n) AS rows, count(*) FILTER (n > 1) AS doubled, coalesce(sum(n) FILTER (start_at IS NOT NULL AND NOT there), 0) AS no_member,
         coalesce(sum(n) FILTER (NOT dated), 0) AS no_year,
         CAST(round(CAST(100 * CAST(coalesce(sum(n) FILTER (start_at IS NULL), 0) AS DOUBLE) / sum(n) AS DECIMAL(38,10)), 1) AS DOUBLE) AS pct FROM facts GROUP BY name),
fl2 AS (SELECT CASE entity WHEN 'sales' THEN 'lines' ELSE entity END AS entity, bronze, silver, CASE entity WHEN 'sales' THEN (SELECT count(*) FROM f) ELSE fact END AS fact FROM flow),
ck AS (
  SELECT 'newest run ended well' AS "check", CASE WHEN status IN ('SUCCESS', 'NO_OP') THEN 'PASS' ELSE 'FAIL' END AS result, status AS detail FROM lr
  UNION ALL SELECT 'newest run wrote rows', CASE WHEN w > 0 OR status = 'NO_OP' THEN 'PASS' ELSE 'WARN' END, CAST(w AS VARCHAR) FROM lr
  UNION ALL SELECT entity || ' flows through all layers',
     CASE WHEN (bronze > 0 AND silver = 0) OR (silver > 0 AND fact = 0) THEN 'FAIL' WHEN fact > 0 THEN 'PASS' ELSE 'WARN' END, bronze || ' > ' || silver || ' > ' || fact FROM fl2
  UNION ALL SELECT name || ' has one row per surrogate key', CASE WHEN coalesce(n, 0) = 0 THEN 'PASS' ELSE 'FAIL' END, 'doubled: ' || coalesce(n, 0) FROM names LEFT JOIN twice USING (name)
  UNION ALL SELECT name || ' has one open version per key', CASE WHEN coalesce(n, 0) = 0 THEN 'PASS' ELSE 'FAIL' END, 'open twice: ' || coalesce(n, 0) FROM names LEFT JOIN opened USING (name)
  UNION ALL SELECT name || ' has one row per grain', CASE WHEN doubled = 0 THEN 'PASS' ELSE 'FAIL' END, 'doubled: ' || doubled FROM fs
  UNION ALL SELECT name || ' refers to members and years that exist', CASE WHEN no_member = 0 AND no_year = 0 THEN 'PASS' ELSE 'FAIL' END,
     'rows without member: ' || no_member || ', without year: ' || no_year FROM fs
  UNION ALL SELECT name || ' knows its members', CASE WHEN pct > 50 THEN 'WARN' ELSE 'PASS' END, 'unknown %: ' || pct FROM fs
  UNION ALL SELECT 'vw_sales answers', CASE WHEN count(*) = 0 THEN 'WARN' ELSE 'PASS' END, 'rows: ' || count(*) FROM f WHERE start_at IS NOT NULL
  UNION ALL SELECT 'vw_nothing answers', CASE WHEN count(*) = 0 THEN 'WARN' ELSE 'PASS' END, 'rows: ' || count(*) FROM f WHERE year_sk = 1971)
"""


@query("verify_checks", f"WITH {CHECKS} SELECT * FROM ck")
def verify_checks(spark, sf):
    """Newest run, row flow, dimensions, facts, views: each table summed up in one pass."""
    return all_checks(spark, sf)


@query("verify_summary", f"WITH {CHECKS} SELECT result, count(*) AS n FROM ck GROUP BY 1")
def verify_summary(spark, sf):
    return checks.tally(all_checks(spark, sf))


@query("scalar_functions", f"""SELECT event_id, coalesce(nullif(event_type, 'click'), 'none') AS c_coalesce, event_type IS NULL AS c_null,
  CAST(round(CAST(value AS DECIMAL(38,10)), 1) AS DOUBLE) AS c_round, CAST(round(CAST(pow(value, 1.5) AS DECIMAL(38,10)), 4) AS DOUBLE) AS c_power,
  CAST(floor(value / 10) * 10 AS INTEGER) AS c_floor, user_id % 5 = 1 AS c_mod, abs(value - 100) AS c_abs,
  concat_ws('-', CAST(year(ts) AS VARCHAR), '07', '01') AS c_concat_ws, event_type || ':' || user_id AS c_concat,
  format('{{:,}}', CAST(round_even(value * 1000, 0) AS BIGINT)) AS c_format, regexp_matches(event_type, '^[cv]') AS c_rlike, event_type LIKE '%i%' AS c_like,
  CAST(value AS VARCHAR) AS c_string, CAST(ts AS DATE) AS c_date, date_sub('second', date_trunc('day', ts), ts) AS c_seconds,
  strftime(ts, '%H:%M:%S.%g') AS c_clock, ts >= TIMESTAMP '2024-01-15 00:00:00' AS c_literal, {K_SQL} AS c_json, 0 AS c_array,
  value BETWEEN 10 AND 20 AS c_between, event_type IN ('view', 'error') AS c_in, CASE WHEN value > 100 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS c_case,
  CAST(user_id AS INTEGER) AS c_int, CAST(user_id AS BIGINT) AS c_bigint, CAST(user_id AS DOUBLE) AS c_double, user_id > 0 AS c_boolean, ts AS c_timestamp FROM events""")
def scalar_functions(spark, sf):
    """Every scalar function of the warehouse once, row by row."""
    v, t, u, ts = F.col("value"), F.col("event_type"), F.col("user_id"), F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        F.coalesce(F.nullif(t, F.lit("click")), F.lit("none")).alias("c_coalesce"),
        t.isNull().alias("c_null"),
        exact_round(v, 1).cast("double").alias("c_round"),
        exact_round(F.pow(v, F.lit(1.5)), 4).cast("double").alias("c_power"),
        (F.floor(v / 10) * 10).cast("int").alias("c_floor"),
        (u % 5 == 1).alias("c_mod"),
        F.abs(v - 100).alias("c_abs"),
        F.concat_ws("-", F.year(ts).cast("string"), F.lit("07"), F.lit("01")).alias("c_concat_ws"),
        F.concat(t, F.lit(":"), u.cast("string")).alias("c_concat"),
        thousands(v * 1000).alias("c_format"),
        t.rlike("^[cv]").alias("c_rlike"),
        t.like("%i%").alias("c_like"),
        v.cast("string").alias("c_string"),
        F.to_date(ts).alias("c_date"),
        F.timestamp_diff("SECOND", F.date_trunc("day", ts), ts.cast("timestamp")).alias("c_seconds"),
        F.date_format(ts, "HH:mm:ss.SSS").alias("c_clock"),
        (ts >= F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")).alias("c_literal"),
        k_value().alias("c_json"),
        F.size(F.array()).alias("c_array"),
        v.between(10, 20).alias("c_between"),
        t.isin("view", "error").alias("c_in"),
        F.when(v > 100, "high").when(v > 10, "mid").otherwise("low").alias("c_case"),
        u.cast("int").alias("c_int"),
        u.cast("bigint").alias("c_bigint"),
        u.cast("double").alias("c_double"),
        u.cast("boolean").alias("c_boolean"),
        ts.cast("timestamp").cast("timestamp_ntz").alias("c_timestamp"),
    )
