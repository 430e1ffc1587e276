"""Text quality by supervised subword embeddings.

Each word, each of its character n-grams (3 to 5 characters, the word's two ends marked) and each pair of
neighbouring words (one vector for all pairs of equal words) has a vector, found by hash in a table of 2^18 rows.
A document is the mean of the vectors of all its words, n-grams and pairs, and a softmax over two classes reads it.
Vectors and output are learned together, one document after the other, by stochastic gradient descent with a
rate that falls to zero.

Equal words of a block are cut into n-grams once. The output is linear in the mean, so for scoring each row of the
table is first reduced to one number, the log odds it adds; that list (2^18 numbers, 2 MB) is all that tasks get.

The learner takes at most `max_rows` labelled documents (those whose ids hash lowest; a documented bound), whole
texts, streamed in a fixed order through one task. Scores of all texts come from one distributed scan.

Defined cases: a null or empty text has no vectors and gets the score of the bias alone; rows with a null label or
a null id are not learned from; a document labelled twice counts as bad if any label says so; without a labelled
row, or with one class only, the bias is all that is learned (from counts with one added); bytes are taken as they
are, only A-Z is folded; very long words and texts are read whole; repeated rows are scored alike and ties cannot
occur; further columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import LOWER, blocks, distinct_words, hashes, mix, words
from tierline.session import materialize

BITS, DIM, GRAMS = 18, 16, (3, 4, 5)
MAX_ROWS, PASSES, RATE = 12_000, 3, 1.0
THRESHOLD = 0.7
#: Marks the beginning and the end of a word; neither byte occurs in UTF-8.
OPEN, CLOSE = 0xFE, 0xFF
#: The hash of all pairs of equal words.
SAME = np.uint64(0x5A5A5A5A5A5A5A5A)


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words and of their n-grams, and the number of the word of each."""
    sizes = ends - starts + 2
    begins = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(starts)), sizes)
    marked = np.empty(int(sizes.sum()), np.uint8)
    inside = np.ones(len(marked), bool)
    inside[begins] = inside[begins + sizes - 1] = False
    marked[begins], marked[begins + sizes - 1] = OPEN, CLOSE
    marked[inside] = data[(np.arange(len(marked)) + np.repeat(starts - begins - 1, sizes))[inside]]
    chars = np.flatnonzero(marked & 0xC0 != 0x80)  # bytes that begin a character
    bounds, of = np.append(chars, len(marked)), word[chars]
    found, mine = [hashes(marked, begins, begins + sizes)], [np.arange(len(starts))]
    for n in GRAMS:
        if len(chars) >= n:
            first = np.flatnonzero(of[n - 1 :] == of[: len(of) - n + 1])
            found.append(hashes(marked, bounds[first], bounds[first + n]))
            mine.append(of[first])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(mine)


def bags(data: np.ndarray, offsets: np.ndarray):
    """Of a block of texts: text and distinct word of each word, table rows of the distinct words with the word of each,
    text and table row of each pair of neighbouring words."""
    data = LOWER[data]
    starts, ends, text = words(data, offsets)
    example, number, h = distinct_words(data, starts, ends)
    row, of = subwords(data, starts[example], ends[example])
    near = np.flatnonzero(text[1:] == text[:-1])
    a, b = h[number[near]], h[number[near + 1]]
    pair = np.where(a == b, SAME, mix(a * np.uint64(31) + b)) >> np.uint64(64 - BITS)
    return text, number, row, of, text[near], pair.astype(np.int64)


def counted(text, number, row, of, near, pair, n: int):
    """Of each text, its different table rows and how often each is met; where each text's begin."""
    order = np.argsort(of, kind="stable")
    row, n_words = row[order], int(number.max(initial=-1)) + 1
    begins = np.searchsorted(of[order], np.arange(n_words + 1))
    pairs, nth = np.unique(pair, return_inverse=True)
    text, number = np.concatenate([text, near]), np.concatenate([number, nth + n_words])
    row, begins = np.concatenate([row, pairs]), np.concatenate([begins, len(row) + 1 + np.arange(len(pairs))])
    unit, times = np.unique((text << 32) | number, return_counts=True)
    text, number = unit >> 32, unit & 0xFFFFFFFF
    size = begins[number + 1] - begins[number]
    at = np.arange(size.sum()) + np.repeat(begins[number] - np.cumsum(size) + size, size)
    code = np.repeat(text << BITS, size) | row[at]
    order = np.argsort(code, kind="stable")
    code, times = code[order], np.repeat(times, size)[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, first) if len(first) else times
    return code[first] & ((1 << BITS) - 1), times, np.searchsorted(code[first] >> BITS, np.arange(n + 1))


def learned(bias: float, total: int, rate: float):
    """Rows (label, text), in order, to each table row's share in the log odds; the last number is the bias."""

    def run(batches):
        table = ((np.random.default_rng(1).random((1 << BITS, DIM), np.float32) - 0.5) / DIM).astype(np.float32)
        out, base, seen = np.zeros((2, DIM), np.float32), np.array([0.0, bias]), 0
        for batch in batches:
            label = batch.column("label").to_numpy()
            for i, j, data, offsets in blocks(batch.column("text")):
                row, times, begins = counted(*bags(data, offsets), j - i)
                for t in range(j - i):
                    now = rate * max(0.0, 1 - seen / total)
                    seen += 1
                    at, share = row[begins[t] : begins[t + 1]], times[begins[t] : begins[t + 1]]
                    share = (share / max(1, share.sum())).astype(np.float32)
                    vectors = table[at]
                    mean = share @ vectors
                    x = out @ mean + base
                    error = np.exp(x - x.max())
                    error /= error.sum()
                    error[int(label[i + t])] -= 1
                    # the rows of a long text would hardly move by their share of the mean alone
                    back = (error.astype(np.float32) @ out) * np.float32(now * len(at) ** 0.5)
                    out -= now * np.outer(error, mean).astype(np.float32)
                    base -= now * 0.1 * error
                    table[at] = vectors - np.outer(share, back)
        odds = np.append(table @ (out[1] - out[0]), base[1] - base[0]).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(odds))), pa.array(odds)], ["row", "odds"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int = MAX_ROWS, passes: int = PASSES, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(log odds of each table row, bias) from the labelled rows given."""
    spark = docs.sparkSession
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).cast("double").alias("label"))
    marked = materialize(spark, marked.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_rows))
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # at most max_rows rows of three numbers are broadcast
    rows = materialize(spark, source.join(F.broadcast(marked), "doc_id").select("doc_id", "order", "label", "text"))
    total, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    bias = float(np.log((good + 1) / (total - good + 1)))
    if not 0 < good < total:
        return np.zeros(1 << BITS), bias
    again = rows.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes)))).coalesce(1).sortWithinPartitions("pass", F.xxhash64("pass", "order"), "doc_id", "text")
    odds = again.select("label", "text").mapInArrow(learned(bias, total * passes, rate), "row long, odds double").toPandas()  # 2^BITS + 1 rows
    odds = odds.sort_values("row")["odds"].to_numpy()
    return odds[:-1], float(odds[-1])


def scored(odds: np.ndarray, bias: float):

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column("text")):
                text, number, row, of, near, pair = bags(data, offsets)
                size = np.bincount(of)
                total = np.bincount(text, np.bincount(of, odds[row], len(size))[number], j - i) + np.bincount(near, odds[pair], j - i)
                n = np.bincount(text, size[number], j - i) + np.bincount(near, minlength=j - i)
                x = bias + total / np.maximum(n, 1)
                part = batch.slice(i, j - i).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))], [*part.schema.names, "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, score) of every row of `docs`: how likely it is good text; trained on `labels` (id, quality)."""
    odds, bias = train(docs, labels, id_col, text_col, **options)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(scored(odds, bias), f"`{id_col}` {kind}, score double")
