"""Best-fit packing by exact-complement hashing.

Texts become token ids, then pieces of at most `capacity` ids. How many pieces there are of each
length is all that the plan needs: at most `capacity` counts, whatever the size of the corpus. From
the longest length down, a gap is filled by one, two or three lengths that sum to it exactly, as
often as the counts allow; what has no exact complement is filled with the longest length that fits.
Each step uses up the count of some length (or leaves fewer than it needs), so the plan has a few
rows per length. Pieces find their place by their number among the pieces of their length, which is
counted per task and carried over tasks by a sum of counts: no piece is moved for it.

Defined cases: a null or empty text is the single closing id; a repeated row is packed again; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.batches import ALNUM, LOWER, SIGN, blocks, distinct_words, words
from tierline.session import materialize

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
#: Words whose ids a task remembers; then it starts anew.
REMEMBERED = 2_000_000
SPECIAL = re.compile(rb"<\|[a-z]+\|>")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


class Memory:
    """Ids of the words that a task has met, by word hash: sorted hashes, and each word's place in a pool of ids."""

    def __init__(self):
        self.hash, self.at, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the hashes, and which of them are known."""
        if not len(self.hash):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        row = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return row, self.hash[row] == h

    def add(self, h: np.ndarray, ids: list[np.ndarray]) -> None:
        size = np.array([len(x) for x in ids], np.int64)
        at = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, *ids])
        merged = np.concatenate([self.hash, h])
        order = np.argsort(merged, kind="stable")
        self.hash, self.at, self.size = merged[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]


def token_ids(tokenizer, memory: Memory, data: np.ndarray, offsets: np.ndarray, close: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, each closed by `close`, and where each text's ids begin.

    The tokenizer folds case and splits at white space and between ASCII letters or digits and the ASCII signs after
    them until it merges, so equal pieces have equal ids wherever they stand. Bytes from 128 on may be signs or marks,
    which it keeps together with the signs after them: there is no cut behind one. It composes marks before it folds, so
    a capital before such a byte stays. Where a text spells one of its special tokens, words are left as they are.
    """
    folded, kept = LOWER[data], np.flatnonzero(data[1:] >= 128)
    folded[kept] = data[kept]
    if SPECIAL.search(folded.tobytes()):
        starts, ends, text = words(data, offsets)
    else:
        data, sign = folded, SIGN[folded]
        starts, ends, text = words(data, offsets, cut=np.append(False, sign[1:] & ALNUM[folded[:-1]])[: len(data)])
    first, inverse, h = distinct_words(data, starts, ends)
    if not memory.look(h)[1].all():
        if len(memory.hash) > REMEMBERED:
            memory.__init__()
        new = np.flatnonzero(~memory.look(h)[1])
        cut_out = [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
        memory.add(h[new], [np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast(cut_out, add_special_tokens=False)])
    row = memory.look(h)[0]
    at, sizes = memory.at[row], memory.size[row]
    pool = np.append(memory.pool, np.uint32(close))
    # the words of each text, then one closing entry
    n = len(offsets) - 1
    per_text = np.bincount(text, minlength=n)
    slot = np.arange(len(text)) + text
    entry_at, entry_n = np.full(len(text) + n, len(pool) - 1, np.int64), np.ones(len(text) + n, np.int64)
    entry_at[slot], entry_n[slot] = at[inverse], sizes[inverse]
    begins = np.cumsum(entry_n) - entry_n
    ids = pool[np.repeat(entry_at - begins, entry_n) + np.arange(int(entry_n.sum()))]
    closing = np.cumsum(per_text + 1) - 1
    return ids.astype("<u4"), np.concatenate([[0], begins[closing] + 1])


def cut(tokenizer_path: str | None, capacity: int, close: int):
    """Batches of (doc_id, text) to batches of pieces."""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if tokenizer_path is None:
            import public_tokenizers

            tokenizer = Tokenizer.from_file(str(public_tokenizers.path(TOKENIZER)))
        else:
            tokenizer = Tokenizer.from_file(tokenizer_path)
        memory = Memory()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for i, j, data, offsets in blocks(batch.column(1)):
                ids, begins = token_ids(tokenizer, memory, data, offsets, close)
                rows = []
                for doc, a, b in zip(docs[i:j], begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                    for k, s in enumerate(range(a, b, capacity)):
                        part = ids[s : min(s + capacity, b)]
                        rows.append((doc, k, s - a, len(part), zlib.crc32(part.tobytes()), task, int(seen[len(part)])))
                        seen[len(part)] += 1
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth")
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))

    return run


def exact(left: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three lengths that sum to the gap and are left; the longest first."""
    if gap <= 0 or gap >= len(left) + len(left):
        return None
    if gap < len(left) and left[gap] > 0:
        return [gap]

    def pair(total: int) -> list[int] | None:
        high = np.arange(min(total - 1, len(left) - 1), (total + 1) // 2 - 1, -1)
        low = total - high
        ok = (left[high] > 0) & (left[low] > np.where(high == low, 1, 0)) & (low > 0)
        if not ok.any():
            return None
        k = int(ok.argmax())
        return [int(high[k]), int(low[k])]

    if gap < 2:
        return None
    if found := pair(gap):
        return found
    there = (left > 0).astype(np.int64)
    there[0] = 0
    sums = np.convolve(there[:gap], there[:gap]) > 0  # which pair sums there are, without regard to counts
    longest = np.arange(gap - 2, 0, -1)
    for a in longest[(there[longest] > 0) & sums[gap - longest]].tolist():
        left[a] -= 1
        found = pair(gap - a) if gap - a >= 2 else None
        left[a] += 1
        if found:
            return [a, *found]
    return None


def pack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """How often which lengths go together: (times, [(length, how many of it), ...]) by counts of lengths."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    for longest in range(capacity, 0, -1):
        while left[longest] > 0:
            before, used, gap = left.copy(), [longest], capacity - longest
            left[longest] -= 1
            while gap > 0:
                if found := exact(left, gap):
                    used += found
                    break
                fits = np.flatnonzero(left[1 : gap + 1] > 0)
                if not len(fits):
                    break
                best = int(fits[-1]) + 1
                used.append(best)
                left[best] -= 1
                gap -= best
            left, need = before, Counter(used)
            times = min(int(left[k]) // m for k, m in need.items())
            for k, m in need.items():
                left[k] -= times * m
            plan.append((times, sorted(need.items(), reverse=True)))
    return plan


def place(plan: list[tuple[int, list[tuple[int, int]]]], capacity: int):
    """Batches with (length, rank) to batches with sequence_id and offset."""
    rows, base, cursor = [], 0, np.zeros(capacity + 1, np.int64)
    for times, parts in plan:
        offset = 0
        for length, m in parts:
            rows.append((length, int(cursor[length]), base, m, offset))
            cursor[length] += times * m
            offset += length * m
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    first = {k: int(i) for i, k in reversed(list(enumerate(table[:, 0].tolist())))}
    last = {k: i + 1 for i, k in enumerate(table[:, 0].tolist())}

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in ("length", "rank"))
            at = np.zeros(len(length), np.int64)
            for k in np.unique(length).tolist():
                own = length == k
                at[own] = first[k] + np.searchsorted(table[first[k] : last[k], 1], rank[own], "right") - 1
            row = table[at]
            nth = rank - row[:, 1]
            kept = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = CAPACITY, close: int = 0) -> DataFrame:
    """One row per piece with the sequence and the place that it gets."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(spark, source.mapInArrow(cut(tokenizer_path, capacity, close), PIECES))
    per_task = materialize(spark, pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(carried, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("before"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place(pack_plan(counts, capacity), capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
