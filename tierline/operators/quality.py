"""Quality rules on tables: drop, fail, record, quarantine, escalate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierline.functions.rules import all_pass, failed_names, passes
from tierline.registry import Rule, batch_rules, cast_plan, escalation_rules, rules_of


class QualityError(RuntimeError):
    """A FATAL rule was violated, or a WARN rule beyond its limit."""


def rule_counts(rules) -> list[Column]:
    """One violation count per row-level rule, for ``agg`` or ``observe``."""
    return [F.count_if(~passes(r)).alias(f"failed__{r.name}") for r in rules if r.row_level]


def rule_results(df: DataFrame, rules: list[Rule], by: list[str] = ()) -> DataFrame:
    """Rows evaluated, passed and failed per rule, in one scan of ``df`` (per group of ``by``)."""
    rows = [r for r in rules if r.row_level]
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *rule_counts(rows))
    long = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule_name"),
                    F.lit(r.severity).alias("severity"),
                    F.col(f"failed__{r.name}").alias("rows_failed"),
                )
                for r in rows
            ]
        )
    ).alias("r")
    return counted.select(*by, "n", long).select(
        *by,
        "r.rule_name",
        "r.severity",
        F.col("n").alias("rows_evaluated"),
        (F.col("n") - F.col("r.rows_failed")).alias("rows_passed"),
        "r.rows_failed",
        (1 - F.col("r.rows_failed") / F.nullif(F.col("n"), F.lit(0))).alias("pass_rate"),
    )


def marked(df: DataFrame, rules) -> DataFrame:
    """``df`` with ``failed_rules``: the names of all row-level rules a row violates."""
    return df.withColumn("failed_rules", failed_names([r for r in rules if r.row_level]))


def marked_counts(df: DataFrame, rules, whole: DataFrame | None = None, older: int | None = None) -> dict[str, int]:
    """Rows and violations of a marked table, batch rules included: duplicated keys of a ``unique``
    rule, 1 for a table shorter than ``row_count_min``.

    Batch rules judge ``whole``, of which ``df`` may be the part that is new; all of them in one query. Where the number
    of ``older`` rows is known, ``whole`` is read for ``unique`` rules only.
    """
    rows = [F.count_if(F.array_contains("failed_rules", r.name)).alias(f"failed__{r.name}") for r in rules if r.row_level]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *rows).first().asDict()
    counts["n_whole"] = counts["n"]
    batch = batch_rules(rules)
    counted = older is not None and all(r.type == "row_count_min" for r in batch)
    if batch and counted:
        counts["n_whole"] += older
    elif batch:
        whole = df if whole is None else whole
        doubled = [duplicates(whole, list(r.columns)).agg(F.count(F.lit(1))).scalar().alias(f"failed__{r.name}") for r in batch if r.type == "unique"]
        counts |= whole.agg(F.count(F.lit(1)).alias("n_whole")).select("n_whole", *doubled).first().asDict()
    counts |= {f"failed__{r.name}": int(counts["n_whole"] < r.min) for r in batch if r.type == "row_count_min"}
    return counts


def results_by_batch(df: DataFrame, rules, columns) -> DataFrame:
    """Per delivered batch: results of the row-level rules of a marked table, and of each column with
    values lost in typing (``failed_casts``). Reads the batch and the two lists of names only."""
    found = [(r.name, r.severity, "failed_rules") for r in rules if r.row_level]
    found += [(f"cast_failed__{c}", "WARN", "failed_casts") for c, t in cast_plan(columns) if t != "string"]
    batch = F.col("batch_id") if "batch_id" in df.columns else F.lit(None).cast("string")
    counted = df.groupBy(batch.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("rows_evaluated"),
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("rule_name"),
                    F.lit(severity).alias("severity"),
                    F.count_if(F.array_contains(where, name)).alias("rows_failed"),
                    F.lit(where == "failed_rules").alias("always"),
                )
                for name, severity, where in found
            ]
        ).alias("results"),
    )
    long = counted.select("batch_id", "rows_evaluated", F.inline("results")).where("always OR rows_failed > 0")
    passed = F.col("rows_evaluated") - F.col("rows_failed")
    return long.select(
        "batch_id", "rule_name", "severity", "rows_evaluated", passed.alias("rows_passed"), "rows_failed",
        (passed / F.col("rows_evaluated")).alias("pass_rate"),
    )


def keep_valid(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that pass every WARN rule."""
    return df.where(all_pass(rules_of(rules, "WARN")))


def quarantine(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows some WARN rule drops, with the names of the rules they fail."""
    failed = failed_names(rules_of(rules, "WARN"))
    return df.withColumn("failed_rules", failed).where(F.size("failed_rules") > 0)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values on more than one row, NULL being a value like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


@dataclass(frozen=True)
class Breach:
    rule: str
    detail: str


def breaches(counts: dict[str, int], rules: list[Rule]) -> list[Breach]:
    """What must stop the run, given ``n`` and the ``failed__<rule>`` counts of a load."""
    n = counts.get("n") or 0
    whole = counts.get("n_whole", n)
    out = []
    for r in rules:
        failed = counts.get(f"failed__{r.name}") or 0
        if r.type == "row_count_min":
            if r.severity == "FATAL" and whole < r.min:
                out.append(Breach(r.name, f"{whole} rows, at least {r.min} expected"))
        elif r.severity == "FATAL" and failed:
            out.append(Breach(r.name, "duplicated keys" if r.type == "unique" else f"{failed} of {n} rows violate it"))
    for r in escalation_rules(rules):
        failed = counts.get(f"failed__{r.name}") or 0
        # a table is long enough or it is not: that rule has one thing to judge
        of = 1 if r.type == "row_count_min" else n if r.row_level else whole
        if of and 100.0 * failed / of > r.fail_if_violation_pct_above:
            out.append(Breach(r.name, f"{failed} of {of} rows, above {r.fail_if_violation_pct_above} %"))
    return out


def observed(df: DataFrame, rules: list[Rule], name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row and violation counts taken while it is written, not in a second scan."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n"), *rule_counts(rules)), obs


def enforce(counts: dict[str, int], rules: list[Rule]) -> None:
    found = breaches(counts, rules)
    if found:
        raise QualityError("; ".join(f"{b.rule}: {b.detail}" for b in found))


def verdicts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: rows, violations, whether the run may go on. Batch rules included.

    A ``unique`` rule counts the duplicated keys; keys are counted before they are shuffled.
    """
    measured = df.agg(
        F.count(F.lit(1)).alias("n"), *rule_counts([r for r in rules if r.row_level])
    )
    parts = []
    for r in rules:
        if r.type == "unique":
            bad = duplicates(df, list(r.columns)).agg(F.count(F.lit(1))).scalar()
        elif r.type == "row_count_min":
            bad = F.when(F.col("n") < r.min, F.lit(1)).otherwise(F.lit(0))
        else:
            bad = F.col(f"failed__{r.name}")
        limit = F.lit(r.fail_if_violation_pct_above).cast("double")
        parts.append(
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(r.severity).alias("severity"),
                bad.cast("long").alias("violations"),
                limit.alias("limit_pct"),
            )
        )
    share = 100.0 * F.col("v.violations") / F.nullif(F.col("n"), F.lit(0))
    stops = F.when(F.col("v.severity") == "FATAL", F.col("v.violations") > 0).otherwise(
        F.coalesce(share > F.col("v.limit_pct"), F.lit(False))
    )
    return measured.select("n", F.explode(F.array(*parts)).alias("v")).select(
        "v.rule_name",
        "v.severity",
        F.col("n").alias("rows_evaluated"),
        "v.violations",
        F.when(stops, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("result"),
    )
