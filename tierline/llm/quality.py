"""Quality rules as a short-circuit cascade, in native column expressions only.

A rule is a named predicate that rejects a text. Rules are tried on a sample: what share each one
rejects, and how long it takes over the sample beyond reading it. They are then asked in the order of
rejection per cost, so that cheap and decisive rules spare the dear ones; `CASE` evaluates a rule
only where none before it rejected. The order changes the cost, never the verdict: a text is kept if no rule
rejects it. `order_rules` returns the order with its figures.

Repeated three-word windows of a text are found inside its row: hashes of the windows are sorted with
their places, equal neighbours mark windows that occur twice, and the places they cover are counted.
No word leaves its row, so no shuffle and no hot key.

Defined cases: a null text has no words; repeated rows and ties are judged alike; very long texts cost
n log n in their words; an empty table gives an empty result and the rules stay as given.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import column_of
from tierline.session import materialize

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first included."""

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(t: Column) -> Column:
            last = F.size(t) - 1
            same = F.filter(t, lambda x, i: ((i > 0) & (F.get(t, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(t, i + 1)["h"] == x["h"])))
            places = F.sort_array(F.transform(same, lambda x: x["i"]))
            span = lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
            return let(places, span)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(placed, repeated))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, 0).otherwise(let(windows, covered)).cast("long")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_letters."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counts = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), n_repeat_words(w).alias("n_repeat_words")))
    held = column_of("_counts", docs.columns)
    out = docs.withColumn(held, counts)
    return out.withColumns({
        "n_words": F.col(held)["n_words"], "word_chars": F.col(held)["word_chars"], "n_symbols": n_symbols(text), "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": F.col(held)["n_repeat_words"],
    }).drop(held)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[str], Column]  # of the name of the text column


def rules() -> list[Rule]:
    """The default rules. Limits are shares of the whole text, the same at every length."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    letters = lambda c: F.length(F.regexp_replace(text(c), r"\P{L}+", ""))
    chars = lambda c: F.length(F.regexp_replace(text(c), WHITE, ""))
    return [
        Rule("few_words", lambda c: F.size(words(F.col(c))) < 50),
        Rule("repeated_windows", lambda c: let(words(F.col(c)), lambda w: 100 * n_repeat_words(w) > 50 * F.size(w))),
        Rule("few_letters", lambda c: 100 * letters(c) < 60 * chars(c)),
        Rule("many_symbols", lambda c: 100 * n_symbols(F.col(c)) > 10 * chars(c)),
        Rule("odd_word_length", lambda c: let(words(F.col(c)), lambda w: F.length(F.array_join(w, "")) > 15 * F.size(w))),
        Rule("repeated_lines", lambda c: 100 * n_dup_lines(F.col(c)) > 50 * F.size(F.split(text(c), "\n"))),
    ]


def order_rules(docs: DataFrame, wanted: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, share it rejects, seconds) by rejection per cost, from a sample of whole texts.

    The sample is the rows whose text hashes lowest: spread over the corpus, and the same every time.
    """
    sample = docs.select(F.col(text_col).alias("text")).orderBy(F.xxhash64("text"), "text").limit(sample_rows)
    sample = materialize(docs.sparkSession, sample.repartition(docs.sparkSession.sparkContext.defaultParallelism))

    def timed(column: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = sample.agg(F.avg(column.cast("double"))).first()[0]
        return share or 0.0, time.perf_counter() - began

    timed(F.length("text") < 0)  # starts the readers
    least = timed(F.length("text") < 0)[1]
    figures = [(rule, *timed(rule.rejects("text"))) for rule in wanted]
    figures = [(rule, share, max(1e-3, took - least)) for rule, share, took in figures]
    return sorted(figures, key=lambda x: -x[1] / x[2])


def cascade(wanted: list[Rule], text_col: str = "text") -> Column:
    """The name of the first rule that rejects the text, or null. Later rules are not evaluated for it."""
    out = F.lit(None).cast("string")
    for rule in reversed(wanted):
        out = F.when(F.coalesce(rule.rejects(text_col), F.lit(False)), rule.name).otherwise(out)
    return out


def judge(docs: DataFrame, text_col: str = "text", wanted: list[Rule] | None = None, verdict: str = "rejected_by") -> DataFrame:
    """`docs` with the rule that rejects each text, or null. Only whether it is null is the same for every order."""
    ordered = [r for r, _, _ in order_rules(docs, wanted or rules(), text_col)]
    return docs.withColumn(verdict, cascade(ordered, text_col))
