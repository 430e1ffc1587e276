"""The registered queries over the text tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (conversation, conversation_sql, decontamination, embedding, html, language, maxent, packing, periodicity, pii, quality,
                          similarity, toxicity, warc)
from tierline.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(of: str, modulus: int):
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(of).cast("string")) % modulus


@query("op1_packing")
def op1(spark, sf_dir):
    """Pieces of all documents, packed."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op2_html_extraction")
def op2(spark, sf_dir):
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op3_lm_scoring")
def op3(spark, sf_dir):
    """Every document's log10 probability under the model of the training documents, and under the unigram base."""
    return maxent.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


@query("op4_pii")
def op4(spark, sf_dir):
    """Base spans, counted and digested, and all spans of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(k) for k in pii.KINDS), F.sha2(pii.written(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                        pii.written(F.concat("spans", "extra")).alias("spans"), F.size("extra").alias("n_added"))


@query("op5_decontamination")
def op5(spark, sf_dir):
    """The benchmark items that each document contains."""
    found = decontamination.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids")


@query("op6_language_id")
def op6(spark, sf_dir):
    """Every document's language, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    found = language.identify(docs.select("doc_id", "text"), docs.filter(~held_out).select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op7_ngram_jaccard_join")
def op7(spark, sf_dir):
    """Each document's near-duplicate class and the number of different texts that its text is linked to."""
    return similarity.similarity_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "text_id")


@query("op8_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  translate(""" + " || ".join(f"lpad(to_base(('0x' || substr(h, {1 + 5 * k}, 5))::BIGINT, 32), 4, '0')" for k in range(8)) + """,
            '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM g
""")
def op8(spark, sf_dir):
    """Every page as written to archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_quality_rules", r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
t AS (SELECT k, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM t) WHERE n > 1),
v AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, i + unnest([0, 1, 2]) AS j FROM r) GROUP BY k),
m AS (SELECT w.doc_id, w.text, solid, len(w.w)::BIGINT AS n_words, length(solid)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN v USING (k)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * length(regexp_replace(text, '\P{L}+', '', 'g')) < 60 * word_chars OR 100 * n_symbols > 10 * word_chars
            OR word_chars > 15 * n_words OR 100 * n_dup_lines > 50 * len(string_split(text, chr(10)))) AS kept
FROM f
""")
def op9(spark, sf_dir):
    """The measures of every document, and the cascade's verdict on those that pass the two base limits."""
    measured = quality.measures(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measured = measured.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    further = [r for r in quality.rules() if r.name not in ("few_words", "repeated_windows")]
    ordered = [r for r, _, _ in quality.order_rules(table(spark, sf_dir, "documents"), further)]
    kept = F.when(F.col("base_failed"), False).otherwise(quality.cascade(ordered).isNull())
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    """Every document's toxicity, learned from three quarters of the labels."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2)
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op11_conversation_repair", conversation_sql.SQL)
def op11(spark, sf_dir):
    """Every conversation's faults after the damage, and the cheapest repair."""
    return conversation.repair(conversation.damage(table(spark, sf_dir, "conversations")))


@query("op12_quality_classifier")
def op12(spark, sf_dir):
    """Every document's quality, learned from three quarters of the labels."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2)
    scored = embedding.quality(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= embedding.THRESHOLD).cast("int").alias("predicted"))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    """The periodic runs of every document, one in ten with a repeated tail."""
    return periodicity.find(table(spark, sf_dir, "documents"), repeat_tails=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
