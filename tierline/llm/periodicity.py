"""Periodic runs of words by internal pattern matching.

A run is a maximal stretch of words with smallest period q and a length of at least max(12, 2q). Texts are
taken in blocks of about two megabytes; words of different texts never equal each other, and a closing symbol
of its own ends each text, so nothing is found across texts and exact copies do not slow each other down.

* Prefix doubling sorts the suffixes. What it knows after k rounds, the rank of each factor of 2^k words, is
  kept: two factors are equal if their ranks are, so a common extension of any length takes one look per level.
* A wavelet matrix over the suffix array answers the range successor: the next place, after a given one, where
  the factor with a given suffix range occurs.
* At level k, the aligned factors of m = 2^k words ask for their occurrences in the 4m words that follow. A
  run of length L and period q with L - q in [2m - 1, 4m - 2] contains an aligned factor with its copy q words
  on, so q is the distance to one of these occurrences. (At the lowest level, four words, the factors begin at every other
  word, so that the shortest runs, L - q = 6, contain one too.)
* Occurrences no more than m/2 apart form arithmetic progressions whose difference is the factor's period p,
  and there are at most nine of them in a window. Only those members of a progression can be periods that
  align the p-periodic stretches of the two places (their beginnings, their ends, or the outer or inner ends of
  both), so a progression of any length gives a few candidates.
* A candidate is extended to both sides. Stretches that several periods fit keep the smallest.

Defined cases: a null or empty text has no words and no run; a null id counts as an ordinary document whose words stay as they are (`repeat_tails`);
repeated rows get equal results; a text longer than a block is taken alone, whole, with memory of some hundred bytes a word; ties
between runs of equal length go to the smaller start, then the smaller period; further columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import BLOCK_BYTES, blocks

LEAST_LENGTH, LEAST_REPEATS = 12, 2
NEVER = np.int64(1) << 60


class Factors:
    """Suffix array of a text of numbers, and the ranks of its factors of 1, 2, 4, ... symbols.

    No factor may occur twice that reaches the last symbol; `symbol` is (text number, word number) in one.
    """

    def __init__(self, symbol: np.ndarray, word: np.ndarray, size: int):
        n = len(symbol)
        key = symbol * size + np.append(word[1:], 0)
        self.sa = np.argsort(key, kind="stable")
        key = key[self.sa]
        slots = np.arange(n)
        rank, slots, first = self._ranked(np.zeros(n, np.int64), slots, self.sa, key)
        self.ranks = [symbol, rank]
        #: Slots of the suffix array whose four-word factor occurs more than once.
        self.shared = np.zeros(0, np.int64)
        #: For level k >= 2: place, first slot and last slot + 1 of each aligned factor that occurs more than once.
        self.aligned: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        while len(slots):
            pos = self.sa[slots]
            key = rank[pos] * n + rank[pos + (1 << (len(self.ranks) - 1))]
            order = np.argsort(key, kind="stable")
            pos = pos[order]
            self.sa[slots] = pos
            rank, slots, first = self._ranked(rank.copy(), slots, pos, key[order])
            self.ranks.append(rank)
            k = len(self.ranks) - 1
            if k == 2:
                self.shared = slots
            if len(slots):
                ends = np.append(slots[np.flatnonzero(first)[1:] - 1], slots[-1]) + 1
                here = self.sa[slots]
                mine = here % (2 if k == 2 else 1 << k) == 0
                self.aligned[k] = here[mine], rank[here[mine]], ends[np.cumsum(first) - 1][mine]

    @staticmethod
    def _ranked(rank, slots, pos, key):
        """Ranks of sorted places; the slots of those that are not alone, with a mark where a group begins."""
        new = key[1:] != key[:-1]
        first = np.append(True, new)
        rank[pos] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        many = ~(first & np.append(new, True))
        return rank, slots[many], first[many]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on are equal (i < j)."""
        i, j, n = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 2, -1, -1):
            step = (self.ranks[k][i] == self.ranks[k][j]).astype(np.int64) << k
            i += step
            j += step
            n += step
        return n

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j are equal (i < j)."""
        i, j, n = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 2, -1, -1):
            far = 1 << k
            same = (i >= far) & (self.ranks[k][np.maximum(i - far, 0)] == self.ranks[k][np.maximum(j - far, 0)])
            step = same.astype(np.int64) << k
            i -= step
            j -= step
            n += step
        return n


class WaveletMatrix:
    """Numbers in a fixed order; how many of a slice are below x, and its k-th smallest, in one look per bit."""

    def __init__(self, values: np.ndarray):
        self.zeros: list[tuple[int, np.ndarray, int]] = []
        for bit in range(max(1, int(values.max(initial=0)).bit_length()) - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~one, out=before[1:])
            self.zeros.append((bit, before, int(before[-1])))
            values = np.concatenate([values[~one], values[one]])
        self.top = np.int64(1) << len(self.zeros)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        n, all_of = np.zeros(len(lo), np.int64), hi - lo
        for bit, before, split in self.zeros:
            l0, h0 = before[lo], before[hi]
            one = (x >> bit & 1).astype(bool)
            n += np.where(one, h0 - l0, 0)
            lo, hi = np.where(one, split + lo - l0, l0), np.where(one, split + hi - h0, h0)
        return np.where(x >= self.top, all_of, n)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lo), np.int64)
        for bit, before, split in self.zeros:
            l0, h0 = before[lo], before[hi]
            one = k >= h0 - l0
            k = np.where(one, k - (h0 - l0), k)
            lo, hi = np.where(one, split + lo - l0, l0), np.where(one, split + hi - h0, h0)
            out |= one.astype(np.int64) << bit
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest number of each slice that is at least x, or NEVER."""
        k = self.below(lo, hi, x)
        there = k < hi - lo
        return np.where(there, self.smallest(lo, hi, np.where(there, k, 0)), NEVER)


def candidates(f: Factors, w: WaveletMatrix, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of factors of 2^k words and copies that may be a period away."""
    m, (b, lo, hi) = 1 << k, f.aligned[k]
    lo = np.searchsorted(f.shared, lo)
    hi = lo + (f.aligned[k][2] - f.aligned[k][1])
    places, distances = [], []

    def add(at, q, where):
        places.append(at[where])
        distances.append(q[where])

    def progression(c, s, lo, hi):
        """For occurrences c and the next ones s: difference (0 if alone), number of further members, the occurrence after the last."""
        p, t, after = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64), s.copy()
        i = np.flatnonzero(s - c <= m // 2)
        if len(i):
            p[i] = s[i] - c[i]
            t[i] = (s[i] + f.forward(c[i], s[i]) - c[i] - m) // p[i]
            after[i] = w.successor(lo[i], hi[i], c[i] + t[i] * p[i] + 1)
        return p, t, after

    s = w.successor(lo, hi, b + 1)
    near = s - b <= 4 * m
    b, lo, hi, s = b[near], lo[near], hi[near], s[near]
    p, _, c = progression(b, s, lo, hi)
    add(b, p, p > 0)
    while True:
        near = c - b <= 4 * m
        b, lo, hi, c = b[near], lo[near], hi[near], c[near]
        if not len(b):
            break
        p, t, after = progression(c, w.successor(lo, hi, c + 1), lo, hi)
        add(b, c - b, slice(None))
        i = np.flatnonzero(t > 0)
        if len(i):
            bi, ci, pi, ti = b[i], c[i], p[i], t[i]
            left, right = bi - f.backward(bi, bi + pi), bi + pi + f.forward(bi, bi + pi)
            left2, right2 = ci - f.backward(ci, ci + pi), ci + pi + f.forward(ci, ci + pi)
            half = (right2 - left) // 2
            for q in (left2 - left, right2 - right, half - (half - ci + bi) % pi):
                j = q - (ci - bi)
                add(bi, q, (j >= 0) & (j % pi == 0) & (j // pi <= ti))
            inner = np.flatnonzero((right >= left2) & (right - left2 < pi))
            of = np.repeat(inner, ti[inner])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(ti[inner]) - ti[inner], ti[inner]) + 1
            add(bi[of], ci[of] - bi[of] + nth * pi[of], slice(None))
        c = after
    return np.concatenate(places), np.concatenate(distances)


def runs(symbol: np.ndarray, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period."""
    f = Factors(symbol, word, size)
    none = np.zeros(0, np.int64)
    if not len(f.shared):
        return none, none, none
    w = WaveletMatrix(f.sa[f.shared])
    found = []
    for k in f.aligned:
        if k < 2:
            continue
        at, q = candidates(f, w, k)
        both = np.unique((at << 32) | q)
        at, q = both >> 32, both & ((1 << 32) - 1)
        start = at - f.backward(at, at + q)
        end = at + q + f.forward(at, at + q)
        long = end - start >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * q)
        found.append(np.stack([start[long], end[long], q[long]]))
    start, end, q = np.concatenate(found, axis=1) if found else (none,) * 3
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    least = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else np.zeros(0, bool)
    start, end, q = start[least], end[least], q[least]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def tail_repeated(doc_id, n: int) -> np.ndarray | None:
    """For one id in ten, which word stands at each place once a tail of the text repeats itself; else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


EMPTY = hashlib.sha256(b"").hexdigest()
SCHEMA = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def described(ids: list, texts: list[bytes]) -> list[tuple]:
    """The row of each text of a block, in the order of NAMES; `ids` are given where tails are to be repeated."""
    words = []
    for doc_id, text in zip(ids, texts):
        found = text.split()
        order = tail_repeated(doc_id, len(found))
        words.append(found if order is None else [found[i] for i in order.tolist()])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(lengths + 1) - lengths - 1
    numbers = pa.array(chain.from_iterable(words), pa.large_binary(), size=int(lengths.sum())).dictionary_encode()
    text_of = np.repeat(np.arange(len(words)), lengths + 1)
    word = np.zeros(len(text_of), np.int64)  # 0 closes a text
    inside = np.ones(len(word), bool)
    inside[begins + lengths] = False
    word[inside] = numbers.indices.to_numpy().astype(np.int64) + 1
    size = len(numbers.dictionary) + 1
    start, length, period = runs(text_of * size + word, word, size)

    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change) == 0
    of = np.searchsorted(begins, start, "right") - 1
    first = np.searchsorted(of, np.arange(len(words) + 1))
    out = []
    for t, found in enumerate(words):
        i, j = first[t], first[t + 1]
        if i == j:
            out.append((len(found), 0, None, None, None, None, EMPTY, hashlib.sha256(b" ".join(found)).hexdigest()))
            continue
        s, n, q = start[i:j] - begins[t], length[i:j], period[i:j]
        best = np.lexsort((q, s, -n))[0]
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), q.tolist()))
        left = np.flatnonzero(kept[begins[t] : begins[t] + len(found)]).tolist()
        out.append((len(found), int(j - i), int(s[best]), int(n[best]), int(q[best]), int(1000 * n[best] // q[best]),
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join([found[x] for x in left])).hexdigest()))
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeat_tails: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_runs, the longest run, digests of all runs and of the text without the repetitions) of every row.

    `repeat_tails` first replaces the tail of one document in ten, chosen by its id, by repetitions of itself.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            given = ids.to_pylist() if repeat_tails else [None] * len(ids)
            for i, j, data, offsets in blocks(batch.column(1), block_bytes):
                texts = [data[offsets[t] : offsets[t + 1]].tobytes() for t in range(j - i)]
                rows = described(given[i:j], texts)
                columns = [pa.array(c, pa.string() if name.endswith("sha256") else pa.int64()) for name, c in zip(NAMES, zip(*rows))]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *columns], ["id", *NAMES])

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {SCHEMA}")
    return found.withColumnRenamed("id", id_col)
