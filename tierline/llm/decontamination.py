"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are compared without case (A-Z), white space and ASCII signs. An item of n
bytes may differ by e = 6 % edits. Then an occurrence shares at least n - q + 1 - q*e of the item's
q-grams with the text, all of them on diagonals (place in the text minus place in the item) that lie
within e of each other. So shared q-grams are counted per text, item and diagonal band; bands are
2e + 1 wide at least and overlap by half, so that each occurrence falls into one whole band. Bands that
reach the bound are verified by banded alignment of the item with the region.

The benchmark is indexed in shards of about `shard_bytes` (a longer item is a shard's alone at worst); each shard's index, 16 bytes
for each of its bytes and a table of 4 MB, is broadcast for a job of its own that writes the texts it finds, by digest, and then
let go. So what is held has a fixed bound however large the benchmark is. A q-gram that many items share meets all of
them: shared q-grams are counted `MOST_SHARED` at a time, and the counts of a text are let go when the next one begins.

Defined cases: null and empty texts are clean; an item with no letters or digits matches nothing;
items shorter than q must occur exactly, as must any for which the bound is not positive; items of
equal text are all reported; items without an id count, and are reported as one null at the end of the list; ids that are
whole numbers are reported as longs, others as they are; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.batches import LOWER, PLAIN, WHITE, blocks, column_of, mix
from tierline.session import materialize

Q, EDIT_SHARE, SHARD_BYTES = 10, 0.06, 8 << 20
TABLE_BITS = 22
#: Shared q-grams that are counted at once.
MOST_SHARED = 1 << 21


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = ~WHITE[PLAIN[data]]
    before = np.concatenate([[0], np.cumsum(keep)])
    return LOWER[data[keep]], before[offsets]


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes from each place on (the last Q - 1 places have none)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    first = np.ndarray((n,), "<u8", data, strides=(1,)).astype(np.uint64)
    rest = np.ndarray((n,), "<u2", data, 8, strides=(1,)).astype(np.uint64)
    return mix(first + rest * np.uint64(0xC2B2AE3D27D4EB4F))


class Index:
    """The q-grams of a bounded set of items."""

    def __init__(self, items: list[tuple[object, str]], share: float):
        self.ids, self.texts = [], []
        for item, text in items:
            raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
            data, _ = squeezed(raw, np.array([0, len(raw)]))
            if len(data):
                self.ids.append(item)
                self.texts.append(data)
        n = np.array([len(x) for x in self.texts], np.int64)
        self.edits = np.floor(n * share).astype(np.int64)
        self.least = n - Q + 1 - Q * self.edits
        exact = self.least <= 0
        self.edits[exact], self.least[exact] = 0, (n - Q + 1)[exact]
        self.band = 2 * (2 * self.edits + 1)
        parts = [grams(x) for x in self.texts]
        at = np.concatenate([np.arange(len(p)) for p in parts] or [np.zeros(0, np.int64)])
        of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        key = np.concatenate([*parts, np.zeros(0, np.uint64)])
        order = np.argsort(key, kind="stable")
        self.key, self.at, self.of = key[order], at[order].astype(np.int32), of[order].astype(np.int32)
        self.maybe = np.zeros(1 << TABLE_BITS, bool)
        self.maybe[(self.key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        self.short = [k for k in range(len(n)) if n[k] < Q]


def aligned(item: np.ndarray, region: np.ndarray, edits: int, low: int, high: int) -> bool:
    """Whether the item occurs in the region with at most `edits` edits on diagonals low..high (both may start anywhere)."""
    if item.tobytes() in region.tobytes():
        return True
    if not edits:
        return False
    width = high - low + 1
    far = len(item) + 1
    cost = np.zeros(width, np.int64)  # before the first byte of the item any place costs nothing
    steps = np.arange(width)
    padded = np.full(len(item) + width + 2, 256, np.int64)
    for i, byte in enumerate(item.tolist()):
        # cell d is the place i + low + d in the region
        begin = i + low
        window = padded[:width]
        window[:] = 256
        a, b = max(begin, 0), min(begin + width, len(region))
        if b > a:
            window[a - begin : b - begin] = region[a:b]
        change = cost + (window != byte)
        skip_item = np.append(cost[1:], far) + 1
        new = np.minimum(change, skip_item)
        # then skip bytes of the region: the least of new[k] + (d - k) for k <= d
        cost = np.minimum.accumulate(new - steps) + steps
        if cost.min() > edits:
            return False
    return bool(cost.min() <= edits)


def bands(index: Index, offsets: np.ndarray, hit: np.ndarray, first: np.ndarray, n: np.ndarray, shift: int):
    """(text, item, band) that reach the item's bound, from the places of shared q-grams and their entries in the index."""
    span, items = 2 * shift + 4, len(index.texts)
    ends = np.cumsum(n)
    code, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = 0
    while a < len(hit):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - n[a] + MOST_SHARED, "right")))
        own = n[a:b]
        posting = np.repeat(first[a:b] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
        place = np.repeat(hit[a:b], own)
        text = np.searchsorted(offsets, place, "right") - 1
        inside = place + Q <= offsets[text + 1]
        posting, place, text = posting[inside], place[inside], text[inside]
        item = index.of[posting].astype(np.int64)
        half = (place - offsets[text] - index.at[posting] + shift) // (index.band[item] // 2)
        # band k holds the half bands k - 1 and k
        new = ((text * items + item) * span + half)[:, None] + np.arange(2)
        code, count = np.append(code, new.ravel()), np.append(count, np.ones(new.size, np.int64))
        order = np.argsort(code, kind="stable")
        code, count = code[order], count[order]
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        code, count = code[start], np.add.reduceat(count, start) if len(start) else count
        open_text = int(np.searchsorted(offsets, hit[b], "right")) - 1 if b < len(hit) else len(offsets)
        done = int(np.searchsorted(code, open_text * items * span))
        pair = code[:done] // span
        enough = count[:done] >= index.least[pair % items]
        yield from zip((pair[enough] // items).tolist(), (pair[enough] % items).tolist(), (code[:done][enough] % span).tolist(), strict=True)
        code, count = code[done:], count[done:]
        a = b


def matches(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """(text, item) of the items found."""
    data, offsets = squeezed(data, offsets)
    out = set()
    key = grams(data)
    if len(key) and len(index.key):
        hit = np.flatnonzero(index.maybe[(key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        first, last = np.searchsorted(index.key, key[hit], "left"), np.searchsorted(index.key, key[hit], "right")
        n = last - first
        hit, first, n = hit[n > 0], first[n > 0], n[n > 0]
        shift = len(data) + max((len(x) for x in index.texts), default=0)
        for t, k, b in bands(index, offsets, hit, first, n, shift):
            if (t, k) in out:
                continue
            edits, half = int(index.edits[k]), int(index.band[k]) // 2
            low, high = (b - 1) * half - shift - edits, (b + 1) * half - 1 - shift + edits
            whole = data[offsets[t] : offsets[t + 1]]
            begin = max(0, low)
            region = whole[begin : max(begin, high + len(index.texts[k]) + edits + 1)]
            if aligned(index.texts[k], region, edits, low - begin, high - begin):
                out.add((t, k))
    if index.short:
        raw = data.tobytes()
        for t in range(len(offsets) - 1):
            part = raw[offsets[t] : offsets[t + 1]]
            out |= {(t, k) for k in index.short if index.texts[k].tobytes() in part}
    return sorted(out)


def scanned(index: Index, kind: pa.DataType, name: str, kept: list[str], into: str):
    """Rows to their columns `kept` and the ids of the items in the text `name`: in order, null last."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(name)):
                found: dict[int, set] = {}
                for t, k in matches(index, data, offsets):
                    found.setdefault(t, set()).add(index.ids[k])
                ids = [sorted(found.get(t, ()), key=lambda x: (x is None, x)) for t in range(j - i)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in kept), pa.array(ids, pa.list_(kind))], [*kept, into])

    return run


def shards(items: DataFrame, shard_bytes: int):
    """Lists of (id, text) of about `shard_bytes` of text each, one list at the driver at a time."""
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 if total <= shard_bytes else int(2 * total // shard_bytes + 1)
    for k in range(n):
        own = items if n == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield n, [(r["i"], r["t"]) for r in own.distinct().collect()]


def contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 share: float = EDIT_SHARE, shard_bytes: int = SHARD_BYTES, into: str = "item_ids") -> DataFrame:
    """`docs` with the sorted ids of the benchmark items that each text contains (an empty list if none)."""
    spark, kind = docs.sparkSession, items.schema[item_id].dataType
    whole = isinstance(kind, T.IntegralType)
    pairs = items.select(F.col(item_id).cast("long" if whole else "string").alias("i"), F.coalesce(item_text, F.lit("")).alias("t"))
    arrow, element = (pa.int64(), T.LongType()) if whole else (pa.string(), T.StringType())
    digest, ids = column_of("_digest", docs.columns), column_of("_ids", docs.columns)
    kept, listed = [c for c in docs.columns if c != into], T.StructField(ids, T.ArrayType(element))
    back = F.col(ids) if whole else F.transform(ids, lambda x: x.cast(kind))
    parts = []
    for n, part in shards(pairs, shard_bytes):
        index = Index(part, share)
        if n == 1:
            found = docs.mapInArrow(scanned(index, arrow, text_col, kept, ids), T.StructType([*(docs.schema[c] for c in kept), listed]))
            return found.select(*kept, back.alias(into))
        texts = docs.select(F.md5(F.col(text_col).cast("binary")).alias(digest), text_col)
        found = texts.mapInArrow(scanned(index, arrow, text_col, [digest], ids), T.StructType([T.StructField(digest, T.StringType()), listed]))
        parts.append(materialize(spark, found.filter(F.size(ids) > 0).dropDuplicates([digest])))
    # one row per text that has any; copies of a text may be many, on the other side of the join
    every = functools.reduce(DataFrame.union, parts).groupBy(digest).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(ids)))).alias(ids))
    joined = docs.withColumn(digest, F.md5(F.col(text_col).cast("binary"))).join(every, digest, "left")
    return joined.select(*kept, F.coalesce(back, F.array().cast(T.ArrayType(element if whole else kind))).alias(into))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows whose text contains no benchmark item."""
    name = column_of("_item_ids", docs.columns)
    return contaminated(docs, items, into=name, **options).filter(F.size(name) == 0).drop(name)
