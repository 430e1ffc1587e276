"""Quality rules as Columns. A row passes a rule only where the rule is TRUE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.registry import Rule


def predicate(rule: Rule) -> Column:
    """The rule as written: TRUE, FALSE or NULL."""
    if rule.type == "cross_field":
        return F.expr(rule.expr)
    if not rule.row_level:
        raise ValueError(f"{rule.type!r} rules judge whole batches, not rows")
    c = F.col(rule.column)
    if rule.type == "not_null":
        return c.isNotNull()
    if rule.type == "in_set":
        return c.isNull() | c.isin(*rule.values)
    if rule.type == "value_range":
        return c.isNull() | c.between(rule.min, rule.max)
    return c.isNull() | c.rlike(rule.pattern)


def passes(rule: Rule) -> Column:
    """Never NULL: a rule that cannot be decided counts as violated."""
    return F.coalesce(predicate(rule), F.lit(False))


def all_pass(rules) -> Column:
    out = F.lit(True)
    for r in rules:
        out = out & passes(r)
    return out


def failed_names(rules) -> Column:
    """Names of the violated rules, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.filter(
        F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
