"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed words, word pairs and pairs that skip one word (lower case, ASCII
signs removed). Weights are trained with per-coordinate rates and L1, so most stay exactly zero and
what is sent to the tasks is a short list of at most 2^20 weights (some hundreds in practice).

FTRL is an online method: the learner passes over its rows in a fixed order and streams them, so its
memory is the two numbers per coordinate. It learns from at most `max_rows` labelled rows (those whose
ids hash lowest; a documented bound), in one task. Scores of all texts come from one distributed scan.

Defined cases: a null or empty text has the score of the bias alone; rows with a null label or a null
id are not learned from; a document labelled twice counts as toxic if any label says so; without a labelled
row, or with one class only, the bias is all that is learned (from counts with one added); an empty table gives
an empty result; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import PLAIN, blocks, hashes, mix, words
from tierline.session import materialize

BITS, MAX_ROWS, PASSES = 20, 20_000, 2
ALPHA, BETA, L1 = 0.5, 1.0, 6.0
THRESHOLD = 0.3


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, and where each text's begin."""
    data = PLAIN[data]
    starts, ends, text = words(data, offsets)
    h = hashes(data, starts, ends)
    found, of = [h], [text]
    for apart, salt in ((1, 7), (2, 13)):
        if len(h) > apart:
            same = text[apart:] == text[:-apart]
            found.append(mix(h[:-apart] * np.uint64(31) + h[apart:] + np.uint64(salt))[same])
            of.append(text[apart:][same])
    code = np.sort((np.concatenate(of).astype(np.int64) << BITS) | (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64))
    code = code[np.append(True, code[1:] != code[:-1])] if len(code) else code
    n = len(offsets) - 1
    return code & ((1 << BITS) - 1), np.searchsorted(code >> BITS, np.arange(n + 1))


def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA))


def trained(bias: float):
    """Rows (label, text), in order, to the weights that are not zero. The last coordinate corrects the bias."""

    def run(batches):
        z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
        for batch in batches:
            label = batch.column("label").to_numpy()
            for i, j, data, offsets in blocks(batch.column("text")):
                index, begins = features(data, offsets)
                for t in range(j - i):
                    at = np.append(index[begins[t] : begins[t + 1]], 1 << BITS)
                    w = weight(z[at], n[at])
                    g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30))) - label[i + t]
                    z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
                    n[at] += g * g
        w = weight(z, n)
        out = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(w[out])], ["feature", "weight"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = MAX_ROWS, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, float]:
    """(features with a weight, their weights, bias) from the labelled rows given."""
    spark = docs.sparkSession
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("double").alias("label"))
    marked = materialize(spark, marked.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_rows))
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # at most max_rows rows of three numbers are broadcast
    rows = materialize(spark, source.join(F.broadcast(marked), "doc_id").select("doc_id", "order", "label", "text"))
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    bias = float(np.log((toxic + 1) / (total - toxic + 1)))
    if not 0 < toxic < total:
        return np.zeros(0, np.int64), np.zeros(0), bias
    again = rows.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes)))).coalesce(1).sortWithinPartitions("pass", "order", "doc_id", "text")
    learned = again.select("label", "text").mapInArrow(trained(bias), "feature long, weight double").toPandas()  # at most 2^BITS + 1 rows
    index, w = learned["feature"].to_numpy(), learned["weight"].to_numpy()
    return index[index < 1 << BITS], w[index < 1 << BITS], bias + float(w[index == 1 << BITS].sum())


def scored(index: np.ndarray, w: np.ndarray, bias: float, name: str):
    def run(batches):
        dense = np.zeros(1 << BITS)
        dense[index] = w
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(name)):
                at, begins = features(data, offsets)
                sums = np.concatenate([[0.0], np.cumsum(dense[at])])
                x = bias + sums[begins[1:]] - sums[begins[:-1]]
                part = batch.slice(i, j - i).drop_columns([name])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))], [*part.schema.names, "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, score) of every row of `docs`; trained on `labels` (id, toxic)."""
    index, w, bias = train(docs, labels, id_col, text_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(scored(index, w, bias, "text"), f"`{id_col}` {kind}, score double")
