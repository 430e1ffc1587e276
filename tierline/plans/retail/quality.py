"""Registered queries: quality rules, drops, quarantine, verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators import quality
from tierline.operators.checks import combine, key_health as measure_keys, row_flow as flow_of
from tierline.operators.shaping import dedup_latest
from tierline.plans.retail.base import query, table
from tierline.plans.retail.landing import LATEST
from tierline.registry import Entity, Rule
from tierline.session import materialize, work_dir
from tierline.sources.lake import Lake

LINE_RULES = [
    Rule("key_not_null", "not_null", "FATAL", column="l_orderkey"),
    Rule("flag_known", "in_set", "WARN", column="l_returnflag", values=("A", "R")),
    Rule("discount_range", "value_range", "WARN", column="l_discount", min=0.0, max=0.08),
    Rule("status_known", "in_set", "INFO", column="l_linestatus", values=("O",)),
]
DOC_RULES = [
    Rule("lang_two_letters", "regex_match", "WARN", column="lang", pattern=r"^[a-z]{2}$"),
    Rule("text_has_digit", "regex_match", "WARN", column="text", pattern=r"\d"),
    Rule("length_matches", "cross_field", "FATAL", expr="abs(length(text) - n_chars) <= 0"),
]
PAGE_RULES = [
    Rule("url_secure", "regex_match", "WARN", column="url", pattern=r"^https://"),
    Rule("url_host", "regex_match", "WARN", column="url", pattern=r"^https?://[a-z0-9.]+\.example\.(com|org)/"),
]
# landed documents, of which only those from one source are allowed
CORPUS = Entity("corpus", "measure", (("text", "string"),), source_system="src0")
CROSS = Rule("price_per_unit", "cross_field", "WARN", expr="l_extendedprice - l_quantity * 1000 <= 5")


def _sql_rules(source: str, rows: list[tuple[str, str, str]], lead: str = "", group: str = "") -> str:
    """One SELECT per (rule, severity, condition)."""
    return " UNION ALL ".join(
        f"""SELECT {lead} '{name}' AS rule_name, '{severity}' AS severity, count(*) AS rows_evaluated,
        count(*) FILTER ({cond}) AS rows_passed, count(*) - count(*) FILTER ({cond}) AS rows_failed,
        1 - CAST(count(*) - count(*) FILTER ({cond}) AS DOUBLE) / count(*) AS pass_rate FROM {source} {group}"""
        for name, severity, cond in rows
    )


LINE_SQL = [
    ("key_not_null", "FATAL", "l_orderkey IS NOT NULL"),
    ("flag_known", "WARN", "l_returnflag IS NULL OR l_returnflag IN ('A', 'R')"),
    ("discount_range", "WARN", "l_discount IS NULL OR l_discount BETWEEN 0 AND 0.08::DOUBLE"),
    ("status_known", "INFO", "l_linestatus IS NULL OR l_linestatus IN ('O')"),
]


@query("dq_rules", " UNION ALL ".join([
    _sql_rules("lineitem", LINE_SQL),
    _sql_rules("documents", [
        ("lang_two_letters", "WARN", "lang IS NULL OR regexp_matches(lang, '^[a-z]{2}$')"),
        ("text_has_digit", "WARN", r"text IS NULL OR regexp_matches(text, '[0-9]')"),
        ("length_matches", "FATAL", "length(text) = n_chars"),
    ]),
    _sql_rules("pages", [
        ("url_secure", "WARN", "url IS NULL OR regexp_matches(url, '^https://')"),
        ("url_host", "WARN", r"url IS NULL OR regexp_matches(url, '^https?://[a-z0-9.]+\.example\.(com|org)/')"),
    ]),
    _sql_rules("documents", [("source_is_configured", "FATAL", "source IS NULL OR source = 'src0'")]),
]))
def dq_rules(spark, sf):
    """Every row-level rule type, over lines, documents and pages: one scan per table."""
    documents = table(spark, sf, "documents").withColumnRenamed("source", "source_system")
    return combine([
        quality.rule_results(rows, rules) for rows, rules in (
            (table(spark, sf, "lineitem"), LINE_RULES), (documents, [*DOC_RULES, CORPUS.source_rule]), (table(spark, sf, "pages"), PAGE_RULES))
    ])


@query("dq_cross_field", "SELECT * FROM (" + _sql_rules(
    "lineitem", [("price_per_unit", "WARN", "l_extendedprice - l_quantity * 1000 <= 5")], "l_returnflag,", "GROUP BY l_returnflag") + ")")
def dq_cross_field(spark, sf):
    return quality.rule_results(table(spark, sf, "lineitem"), [CROSS], ["l_returnflag"])


@query("dq_warn_drop", "SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_discount BETWEEN 0 AND 0.08::DOUBLE")
def dq_warn_drop(spark, sf):
    return quality.keep_valid(table(spark, sf, "lineitem"), LINE_RULES)


@query("dq_unique", """WITH v AS (
    SELECT 'line_unique' AS rule_name, (SELECT count(*) FROM lineitem) AS rows_evaluated,
      (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'order_unique', (SELECT count(*) FROM orders),
      (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)))
  SELECT rule_name, 'FATAL' AS severity, rows_evaluated, violations, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS result FROM v""")
def dq_unique(spark, sf):
    lines = Rule("line_unique", "unique", "FATAL", columns=("l_orderkey", "l_linenumber"))
    orders = Rule("order_unique", "unique", "FATAL", columns=("o_orderkey",))
    return combine([
        quality.verdicts(table(spark, sf, "lineitem"), [lines]), quality.verdicts(table(spark, sf, "orders"), [orders])
    ])


@query("dq_row_count_min", """WITH v AS (
    SELECT 'any_rows' AS rule_name, 1 AS least, count(*) AS n FROM lineitem UNION ALL SELECT 'huge', 1000000000000000, count(*) FROM lineitem)
  SELECT rule_name, 'FATAL' AS severity, n AS rows_evaluated, CASE WHEN n < least THEN 1 ELSE 0 END::BIGINT AS violations,
    CASE WHEN n < least THEN 'FAIL' ELSE 'PASS' END AS result FROM v""")
def dq_row_count_min(spark, sf):
    rules = [Rule("any_rows", "row_count_min", "FATAL", min=1), Rule("huge", "row_count_min", "FATAL", min=10**15)]
    return quality.verdicts(table(spark, sf, "lineitem"), rules)


@query("dq_escalation", """WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_quantity > 45) AS a, count(*) FILTER (l_discount > 0.09::DOUBLE) AS b,
    count(*) FILTER (l_tax > 0.05::DOUBLE) AS d FROM lineitem),
  v AS (SELECT 'quantity_high' AS rule_name, n, a AS violations, 5.0 AS lim FROM c UNION ALL SELECT 'discount_high', n, b, 20.0 FROM c
    UNION ALL SELECT 'tax_high', n, d, NULL FROM c)
  SELECT rule_name, 'WARN' AS severity, n AS rows_evaluated, violations, CASE WHEN 100.0 * violations / n > lim THEN 'FAIL' ELSE 'PASS' END AS result FROM v""")
def dq_escalation(spark, sf):
    """WARN rules that stop the run above a share of violations."""
    def below(name, column, top, limit):
        return Rule(name, "value_range", "WARN", column=column, min=0.0, max=top, fail_if_violation_pct_above=limit)

    rules = [
        below("quantity_high", "l_quantity", 45.0, 5.0),
        below("discount_high", "l_discount", 0.09, 20.0),
        below("tax_high", "l_tax", 0.05, None),
    ]
    return quality.verdicts(table(spark, sf, "lineitem"), rules)


@query("dq_results", "SELECT * FROM (" + _sql_rules("lineitem", LINE_SQL, "l_linestatus AS batch_id, 'lineitem' AS entity,", "GROUP BY l_linestatus") + ")")
def dq_results(spark, sf):
    """Evaluated, passed and failed rows per rule and batch, in one scan."""
    found = quality.rule_results(table(spark, sf, "lineitem"), LINE_RULES, ["l_linestatus"])
    return found.withColumnRenamed("l_linestatus", "batch_id").withColumn("entity", F.lit("lineitem"))


@query("dq_fatal", """SELECT 'bad' AS load, 'FAILED' AS status, count(*) AS rows, count(*) FILTER (l_discount > 0.05::DOUBLE) AS violations, 0::BIGINT AS published_rows FROM lineitem
  UNION ALL SELECT 'good', 'SUCCESS', count(*), 0, count(*) FROM lineitem""")
def dq_fatal(spark, sf):
    """A load is written aside, its violations are counted on the way, and only then published."""
    lake = Lake(spark, work_dir(spark, "fatal"))
    out = []
    for name, top in (("bad", 0.05), ("good", 1.0)):
        rules = [Rule("discount", "value_range", "FATAL", column="l_discount", min=0.0, max=top)]
        df, seen = quality.observed(table(spark, sf, "lineitem"), rules, f"load_{name}")
        staged = lake.stage(df, "silver", f"lines_{name}")
        counts = seen.get
        try:
            quality.enforce(counts, rules)
            lake.publish("silver", f"lines_{name}", staged, "run", counts["n"])
            status = "SUCCESS"
        except quality.QualityError:
            status = "FAILED"
        there = ("silver", f"lines_{name}") in lake.published()
        rows = lake.read("silver", f"lines_{name}").count() if there else 0
        out.append((name, status, counts["n"], counts["failed__discount"], rows))
    return spark.createDataFrame(out, "load string, status string, rows long, violations long, published_rows long")


EVENT_RULES = [
    Rule("value_small", "value_range", "WARN", column="value", min=0.0, max=100.0),
    Rule("type_known", "in_set", "WARN", column="event_type", values=("click", "view", "purchase", "signup")),
    Rule("k_small", "cross_field", "WARN", expr="CAST(get_json_object(props, '$.k') AS INT) < 90"),
]


@query("dq_quarantine", """WITH q AS (SELECT event_id, concat_ws(',', CASE WHEN value NOT BETWEEN 0 AND 100 THEN 'value_small' END,
    CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'type_known' END,
    CASE WHEN coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER) < 90, false) THEN NULL ELSE 'k_small' END) AS failed_rules FROM events)
  SELECT * FROM q WHERE failed_rules <> ''""")
def dq_quarantine(spark, sf):
    """Dropped rows with every rule they fail."""
    bad = quality.quarantine(table(spark, sf, "events"), EVENT_RULES)
    return bad.select("event_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("key_health", """SELECT sum(n)::BIGINT AS bronze_rows, (SELECT count(*) FROM lineitem WHERE l_suppkey = 1) AS null_keys,
  count(*) FILTER (n > 1) AS duplicated_grains FROM (SELECT count(*) AS n FROM lineitem GROUP BY nullif(l_suppkey, 1), l_orderkey, l_linenumber)""")
def key_health(spark, sf):
    raw = table(spark, sf, "lineitem").withColumn("supplier", F.nullif(F.col("l_suppkey"), F.lit(1)))
    return measure_keys(raw, "supplier", ["supplier", "l_orderkey", "l_linenumber"])


def flow_tables(spark, sf):
    """Raw, typed and bound rows of three entities; the last one loses everything."""
    lines, orders, docs = (table(spark, sf, t) for t in ("lineitem", "orders", "documents"))
    silver = quality.keep_valid(dedup_latest(lines, ["l_orderkey", "l_linenumber"], LATEST), LINE_RULES)
    silver = materialize(spark, silver.select("l_orderkey", "l_linenumber"))
    fact = silver.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    unique_orders = orders.select("o_custkey", "o_orderdate").dropDuplicates()
    nothing = docs.where("n_chars < 0")
    return {
        "sales": (lines, silver, fact),
        "orders": (orders, unique_orders, unique_orders),
        "documents": (docs, nothing, nothing),
    }


FLOW = f"""
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LATEST)}) AS rn FROM lineitem) WHERE rn = 1),
sv AS (SELECT * FROM d WHERE l_returnflag IN ('A', 'R') AND l_discount BETWEEN 0 AND 0.08::DOUBLE),
uo AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders),
fl AS (SELECT 1 AS idx, 'sales' AS entity, (SELECT count(*) FROM lineitem) AS bronze, (SELECT count(*) FROM sv) AS silver,
         (SELECT count(*) FROM sv JOIN orders ON o_orderkey = l_orderkey) AS fact
  UNION ALL SELECT 2, 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM uo), (SELECT count(*) FROM uo)
  UNION ALL SELECT 3, 'documents', (SELECT count(*) FROM documents), 0, 0),
flow AS (SELECT *, bronze - silver AS dropped,
  CAST(round(CAST(100.0::DOUBLE * (bronze - silver) / nullif(bronze, 0) AS DECIMAL(38,10)), 1) AS DOUBLE) AS drop_pct,
  CASE WHEN bronze > 0 AND silver = 0 THEN 'FAIL' WHEN silver > 0 AND fact = 0 THEN 'FAIL' WHEN fact > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM fl)
"""


@query("row_flow", f"WITH {FLOW} SELECT * FROM flow")
def row_flow(spark, sf):
    return flow_of(flow_tables(spark, sf))
