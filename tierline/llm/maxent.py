"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

Counting: all training tokens are counted in Spark, per word hash (64 bits stand for a word). The commonest
words (at most `HEAD`; words of the count at the border by their hash) become a bounded table that tasks get; the counts of all
other words are joined to the texts that have them, pre-aggregated per text. These rare words cannot be hot keys, since
hot words are in the table.

Model: classes form a tree. Its leaves are all words of the table that occur `LEAST_COUNT` times or more, and 64 buckets by word
ending for all others; the rarest `FAN` classes are joined into a class of their own until one is left, so a frequent word has few
decisions and any word about log(words). P(word) is the product of the softmaxes on its path. Within a bucket a
word has its share of the training count, (c + 0.5) over the bucket's sum, with 0.5 kept for a word never seen. So
probabilities sum to one. Features of a decision are rows of weights, hashed from the class and the previous word, the one before
it (a skip), or both together. The number of rows grows with the training tokens, one per `TOKENS_PER_ROW`, from 2^13 to 2^20 (64 MB).

Training: the training texts are dealt into `TRAIN_ROUNDS` by a hash of the text. In each round every task passes once over
its texts of that round with per-row adaptive gradient updates in numpy, from the weights that the rounds before ended with
(the first one from the counted frequencies). What the tasks add to a row is averaged over the tasks that touched it, by how often
they did, in Spark, 64 tasks at a time; a context met by few tasks keeps its weight. There are at most two tasks a core, however many
partitions the texts have, so what is exchanged grows with rows times cores.

Defined cases: a null or empty text has the end token only; rows with a null id count as training rows; repeated rows
count again and are scored alike; without training rows all words share the bucket masses of unseen words; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import LOWER, blocks, hashes, mix, words
from tierline.session import materialize

#: Words in the bounded table, count from which a word is a leaf of its own, buckets of the other words, branches of a class.
HEAD, LEAST_COUNT, WIDTH, FAN = 1 << 18, 8, 64, 16
#: Training tokens per row of weights, and the bits of the least and greatest number of rows.
TOKENS_PER_ROW, ROW_BITS = 256, (13, 20)
#: Tokens per gradient step; its size.
STEP_TOKENS, RATE = 8192, 0.3
#: Runs of equal rows up to this length are summed place by place, longer ones at once.
SHORT_RUN = 12
#: Rows of weights that travel together, and tasks whose weights are averaged at once.
ROWS_TOGETHER, TASKS_TOGETHER = 1024, 64
TRAIN_ROUNDS = 3

ONES = np.ones(FAN, np.float32)
END, BEFORE = np.uint64(0x5EED5EED5EED5EED), np.uint64(0x0B0E0B0E0B0E0B0E)


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Word hash, ending bucket and text number of every token, each text closed by END; and where each text begins."""
    data = LOWER[data]
    starts, ends, text = words(data, offsets)
    n = len(offsets) - 1
    per_text = np.bincount(text, minlength=n) + 1
    begins = np.concatenate([[0], np.cumsum(per_text)])
    h = np.full(begins[-1], END, np.uint64)
    bucket = np.zeros(begins[-1], np.int64)
    slot = np.arange(len(text)) + text
    h[slot] = hashes(data, starts, ends)
    ending = np.zeros(len(starts), np.uint64)
    for k in (3, 2, 1):
        ending = ending * np.uint64(256) + np.where(ends - starts >= k, data[np.maximum(ends - k, 0)], 0).astype(np.uint64)
    bucket[slot] = (mix(ending) & np.uint64(WIDTH - 1)).astype(np.int64)
    return h, bucket, np.repeat(np.arange(n), per_text), begins


def counted(batches):
    """(text) to (word, bucket, n), summed per block."""
    for batch in batches:
        for _, _, data, offsets in blocks(batch.column(0)):
            h, bucket, _, _ = tokens(data, offsets)
            order = np.argsort(h)
            h, bucket = h[order], bucket[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(bucket[first]), pa.array(np.diff(np.append(first, len(h))))], ["word", "bucket", "n"])


class ClassTree:
    """A tree of classes over leaves of given masses: the decisions that lead to each leaf, and the shares they start from."""

    def __init__(self, masses: np.ndarray):
        n = len(masses)
        heap = [(float(m), k) for k, m in enumerate(masses)]
        heapq.heapify(heap)
        parent, branch, shares = {}, {}, []
        take = (n - 2) % (FAN - 1) + 2  # the first class may be smaller, then all are full
        while len(heap) > 1:
            below = [heapq.heappop(heap) for _ in range(take)]
            take, mass = FAN, sum(m for m, _ in below)
            row = np.full(FAN, -60.0, np.float32)
            for k, (m, child) in enumerate(below):
                parent[child], branch[child], row[k] = len(shares), k, np.log(m / mass)
            heapq.heappush(heap, (mass, n + len(shares)))
            shares.append(row)
        self.shares = np.array(shares)
        inner = n + len(shares)
        up = np.array([parent.get(k, -1) for k in range(inner)])
        way = np.array([branch.get(k, 0) for k in range(inner)])
        leaf, at, steps = np.arange(n), np.arange(n), []
        while len(at):
            steps.append((leaf, up[at], way[at]))
            at = n + up[at]
            going = up[at] >= 0
            leaf, at = leaf[going], at[going]
        leaf, node, branch = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.argsort(leaf, kind="stable")
        self.node, self.branch = node[order], branch[order]
        self.depth = np.bincount(leaf, minlength=n)
        self.begins = np.cumsum(self.depth) - self.depth

    def decisions(self, leaf: np.ndarray):
        """Token, class and branch of every decision, and where each token's begin."""
        depth = self.depth[leaf]
        ends = np.cumsum(depth)
        begins = ends - depth
        step = np.repeat(self.begins[leaf] - begins, depth) + np.arange(ends[-1])
        return np.repeat(np.arange(len(leaf)), depth), self.node[step], self.branch[step], begins


class Vocabulary:
    """The bounded table of the commonest words: hash, count, and leaf of the class tree (or -1)."""

    def __init__(self, rows, total: int, different: int, masses: np.ndarray):
        rows = sorted(rows, key=lambda r: (-r["n"], r["word"]))
        n = np.array([r["n"] for r in rows], np.int64)
        h = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(h)
        self.own = int((n >= LEAST_COUNT).sum())
        self.hash, self.count = h[order], n[order]
        self.leaf = np.where(order < self.own, order, -1)
        self.total, self.different, self.masses = total, different, masses
        self.tree = ClassTree(np.concatenate([n[: self.own] + 0.5, masses]))
        # the row at which hashes with the same first bits begin
        self.bits = np.uint64(64 - max(4, len(rows).bit_length()))
        self.first = np.searchsorted(self.hash >> self.bits, np.arange((1 << (64 - int(self.bits))) + 1, dtype=np.uint64))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, or -1."""
        out = np.full(len(h), -1)
        at, end = (self.first[(h >> self.bits).astype(np.int64) + k] for k in (0, 1))
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        while len(left):
            hit = self.hash[at] == h
            out[left[hit]] = at[hit]
            go = ~hit & (at + 1 < end)
            left, at, end, h = left[go], at[go] + 1, end[go], h[go]
        return out

    def leaves(self, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Leaf of each token: its own, or that of its bucket."""
        leaf = np.where(row >= 0, self.leaf[row] if len(self.leaf) else -1, -1)
        return np.where(leaf >= 0, leaf, self.own + bucket)


def sorted_places(rows: np.ndarray) -> np.ndarray:
    """Places in the order of their numbers (below 2^32), equal ones as they come."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    high = (rows >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def row_sums(table: np.ndarray, place: np.ndarray, first: np.ndarray):
    """Of each run of `place`: where it begins, its length, and the sum of the rows of `table` at its places. Longest runs first."""
    size = np.diff(np.append(first, len(place)))
    order = np.argsort((65535 - np.minimum(size, 65535)).astype(np.uint16), kind="stable")
    first, size = first[order], size[order]
    total = np.take(table, place[first], axis=0)
    for k in range(1, SHORT_RUN):
        m = int(np.searchsorted(-size, -k))
        total[:m] += np.take(table, place[first[:m] + k], axis=0)
    m = int(np.searchsorted(-size, -SHORT_RUN))
    if m:
        rest = size[:m] - SHORT_RUN
        ends = np.cumsum(rest)
        at = np.repeat(first[:m] + SHORT_RUN - (ends - rest), rest) + np.arange(ends[-1])
        total[:m] += np.add.reduceat(np.take(table, place[at], axis=0), ends - rest, axis=0)
    return first, size, total


class Model:
    """Weights: rows for hashed features, added to the logarithms of the counted shares."""

    def __init__(self, vocabulary: Vocabulary):
        self.tree = vocabulary.tree
        self.bits = int(np.clip(max(vocabulary.total // TOKENS_PER_ROW, 1).bit_length() - 1, *ROW_BITS))
        self.weights = np.zeros((1 << self.bits, FAN), np.float32)

    @staticmethod
    def contexts(h: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Feature hashes (3, token): previous word, the one before, both."""
        one, two = np.roll(h, 1), np.roll(h, 2)
        one[begins[:-1]] = BEFORE
        two[begins[:-1]] = BEFORE
        second = begins[:-1][np.diff(begins) > 1] + 1
        two[second] = BEFORE
        return np.stack([mix(one), mix(two ^ np.uint64(0x77)), mix(one * np.uint64(31) + two)])

    def forward(self, f: np.ndarray, token: np.ndarray, node: np.ndarray):
        """Rows of weights (3, decision), and the probabilities of each decision's branches."""
        key = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        rows = ((f[:, token] + key) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(64 - self.bits)).astype(np.int64)
        y = np.take(self.tree.shares, node, axis=0)
        for r in rows:
            y += np.take(self.weights, r, axis=0)
        np.exp(np.clip(y, -70, 70, out=y), out=y)
        y /= (y @ ONES)[:, None]
        return rows, y

    def log10(self, f, leaf) -> np.ndarray:
        out = np.empty(len(leaf))
        for a in range(0, len(leaf), STEP_TOKENS):
            token, node, branch, begins = self.tree.decisions(leaf[a : a + STEP_TOKENS])
            _, y = self.forward(f[:, a : a + STEP_TOKENS], token, node)
            p = np.log10(np.maximum(y[np.arange(len(node)), branch], 1e-37).astype(np.float64))
            out[a : a + len(begins)] = np.add.reduceat(p, begins)
        return out

    def learn(self, f, leaf, squares, seen) -> None:
        """Updates of the weights; `squares` and `seen` add up each row's squared gradients and how often it was met."""
        for a in range(0, len(leaf), STEP_TOKENS):
            token, node, branch, _ = self.tree.decisions(leaf[a : a + STEP_TOKENS])
            rows, error = self.forward(f[:, a : a + STEP_TOKENS], token, node)
            error[np.arange(len(node)), branch] -= 1
            flat = rows.ravel()
            order = sorted_places(flat)
            flat = np.take(flat, order)
            first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            touched, size, g = row_sums(error, np.tile(np.arange(len(node)), 3)[order], first)
            touched = flat[touched]
            seen[touched] += size
            squares[touched] += np.einsum("ij,ij->i", g, g)
            g *= (RATE / np.sqrt(1 + squares[touched]))[:, None]
            self.weights[touched] = np.take(self.weights, touched, axis=0) - g


WEIGHTS = "weights binary, seen binary, squares binary"


def learned(vocabulary: Vocabulary, start: np.ndarray, past: np.ndarray):
    """(text) to what this task adds to the weights it starts from, as (part, team, weights, seen, squares)."""

    def run(batches):
        model = Model(vocabulary)
        model.weights, squares, seen = start.copy(), past.copy(), np.zeros(len(start), np.float32)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                h, bucket, _, begins = tokens(data, offsets)
                model.learn(model.contexts(h, begins), vocabulary.leaves(vocabulary.find(h), bucket), squares, seen)
        team = TaskContext.get().partitionId() // TASKS_TOGETHER
        for i in range(0, len(start), ROWS_TOGETHER):
            own = slice(i, i + ROWS_TOGETHER)
            if seen[own].any():
                added = (model.weights[own] - start[own]).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // ROWS_TOGETHER], pa.int32()), pa.array([team], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (added, seen[own], squares[own]))],
                    ["part", "team", "weights", "seen", "squares"])

    return run


def averaged(key, table):
    """The means of each row's additions and squares over the parts, by how often each part met the row."""
    seen = [np.frombuffer(x.as_py(), np.float32) for x in table.column("seen")]
    total = np.sum(seen, axis=0)
    weights, squares = 0.0, 0.0
    for n, w, s in zip(seen, table.column("weights"), table.column("squares"), strict=True):
        share = n / np.maximum(total, 1)
        weights = weights + share[:, None] * np.frombuffer(w.as_py(), np.float16).reshape(len(n), -1)
        squares = squares + share * np.frombuffer(s.as_py(), np.float32)
    names = [f for f in table.schema.names if f not in ("weights", "seen", "squares")]
    return pa.table({**{c: table.column(c)[:1] for c in names}, **{c: pa.array([x.tobytes()], pa.binary()) for c, x in
                     (("weights", weights.astype(np.float16)), ("seen", total), ("squares", squares.astype(np.float32)))}})


def trained(training: DataFrame, vocabulary: Vocabulary) -> Model:
    """The model after all rounds."""
    model = Model(vocabulary)
    squares = np.zeros(len(model.weights), np.float32)
    tasks = 2 * training.sparkSession.sparkContext.defaultParallelism
    for k in range(TRAIN_ROUNDS):
        own = training.filter(F.pmod(F.xxhash64("text"), F.lit(TRAIN_ROUNDS)) == k).coalesce(tasks)
        weights = own.mapInArrow(learned(vocabulary, model.weights, squares), f"part int, team int, {WEIGHTS}")
        weights = weights.groupBy("part", "team").applyInArrow(averaged, f"part int, team int, {WEIGHTS}")
        weights = weights.drop("team").groupBy("part").applyInArrow(averaged, f"part int, {WEIGHTS}")
        for r in weights.collect():  # the rows of weights, of which there are at most 2^20
            rows = slice(r["part"] * ROWS_TOGETHER, (r["part"] + 1) * ROWS_TOGETHER)
            model.weights[rows] += np.frombuffer(r["weights"], np.float16).reshape(ROWS_TOGETHER, -1)
            met = np.frombuffer(r["seen"], np.float32) > 0
            squares[rows][met] = np.frombuffer(r["squares"], np.float32)[met]
    return model


def scored(vocabulary: Vocabulary, model: Model):
    """(key, text) to tokens, known tokens, sums over the words of the table, and the other words with how often each occurs."""

    def run(batches):
        space = np.log10(vocabulary.total + 0.5 * (vocabulary.different + 1))
        masses = np.log10(vocabulary.masses)
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column("text")):
                h, bucket, text, begins = tokens(data, offsets)
                n = j - i
                row = vocabulary.find(h)
                leaf = vocabulary.leaves(row, bucket)
                p = model.log10(model.contexts(h, begins), leaf)
                inside = row >= 0
                log_count = np.where(inside, np.log10((vocabulary.count[row] if len(vocabulary.count) else np.zeros(len(row))) + 0.5), 0.0)
                base = log_count - space  # a word outside the table lacks its count's logarithm here, in p too
                p += np.where(leaf >= vocabulary.own, log_count - masses[bucket], 0.0)
                total = lambda x: np.bincount(text, weights=x, minlength=n)  # noqa: E731, B023
                # the words that are not in the table, once per text
                out = np.flatnonzero(~inside)
                order = out[np.lexsort((h[out], text[out]))]
                new = np.append(True, (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])) if len(order) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                lists = np.searchsorted(text[order[first]], np.arange(n + 1))
                rest = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays([pa.array(h[order[first]].view(np.int64)), pa.array(times)], ["word", "n"]))
                part = batch.slice(i, n).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.diff(begins)), pa.array(total(inside).astype(np.int64)), pa.array(total(base)), pa.array(total(p)), rest],
                    [*part.schema.names, "n_tokens", "n_known", "base_score", "score", "rest"])

    return run


def commonest(counts: DataFrame) -> DataFrame:
    """The commonest words, at most HEAD: all of the counts that fit, and of the next ones those with the smallest hashes."""
    count_bin, hash_bin = F.floor(F.log2("n") * 16), F.shiftrightunsigned("word", 48)
    room, least = HEAD, None
    for r in counts.groupBy(count_bin.alias("b")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("b")).collect():
        if r["k"] > room:
            least = r["b"]
            break
        room -= r["k"]
    if least is None:
        return counts
    upto = -1
    for r in counts.filter(count_bin == least).groupBy(hash_bin.alias("h")).agg(F.count(F.lit(1)).alias("k")).orderBy("h").collect():  # at most 2^16 rows
        room -= r["k"]
        if room < 0:
            break
        upto = r["h"]
    return counts.filter((count_bin > least) | ((count_bin == least) & (hash_bin <= upto)))


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row. `held_out`: a boolean column of `docs`."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text.alias("text"))
    training = source.filter(~F.col("held_out")).select("text")
    counts = materialize(spark, training.mapInArrow(counted, "word long, bucket long, n long").groupBy("word").agg(F.first("bucket").alias("bucket"), F.sum("n").alias("n")))
    total, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = commonest(counts).collect()  # at most HEAD rows
    masses = np.full(WIDTH, 0.5)
    for r in counts.groupBy("bucket").agg((F.sum("n") + 0.5 * F.count(F.lit(1))).alias("m")).collect():
        masses[r["bucket"]] += float(r["m"])
    for r in head:
        if r["n"] >= LEAST_COUNT:
            masses[r["bucket"]] -= r["n"] + 0.5
    vocabulary = Vocabulary(head, total, different, masses)

    model = trained(training, vocabulary)

    kind = source.schema["doc_id"].dataType.simpleString()
    keyed = source.withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "held_out", "text")
    parts = materialize(spark, keyed.mapInArrow(scored(vocabulary, model), f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<word: long, n: long>>"))
    # words outside the table: what their counts add to both scores, summed per text
    rest = parts.select("key", F.explode("rest").alias("r")).select("key", "r.word", "r.n")
    looked = rest.join(counts.select("word", F.col("n").alias("c")), "word", "left")
    added = looked.groupBy("key").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"), F.sum("n").alias("n"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"))
    out = parts.drop("rest").join(added, "key", "left")
    extra = F.coalesce("logs", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
                      (F.col("base_score") + extra).alias("base_score"), (F.col("score") + extra).alias("score"))
