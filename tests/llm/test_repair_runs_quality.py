"""Conversation repair and periodic runs against brute force, the quality classifier against held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import conversation, embedding, periodicity
from tierline.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string, pid string, _n long"


# ---- conversation repair ---------------------------------------------------------------------


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        here = out[conv]
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 1:
            text = ""
        elif how == 2:
            text = re.sub("[.!?]", "", text)
        elif how == 4:
            role = "user"
        here += [(turn, role, text)] * {0: 0, 3: 2}.get(how, 1)
    return out


def repaired(rows):
    """All edits of all rows, one after the other: the least (cost, audit) of each state, with the rows it leaves."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def move(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, left) in list(best.items()):
                for role in ("user", "assistant"):
                    to = move(state, role[0])
                    if to:
                        new = (cost + 5, audit + "I", left + [f"{role}:"])
                        best[to] = min(best.get(to, new), new, key=lambda x: x[:2])
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def take(state, new):
            after[state] = min(after.get(state, new), new, key=lambda x: x[:2])

        for state, (cost, audit, left) in inserted(best).items():
            take(state, (cost + 2, audit + "D", left))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if move(state, role[:1]):
                take(move(state, role[:1]), (cost + more, audit + "K", left + [f"{role}:{text}"]))
            for other in ("user", "assistant"):
                if move(state, other[0]):
                    take(move(state, other[0]), (cost + more + 1, audit + "R", left + [f"{other}:{text}"]))
        best = after
    best = inserted(best)
    cost, audit, left = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())


def invented():
    rng, rows = random.Random(4), []
    texts = ["Yes.", "No!", "What?", "so be it", "go on", "", " \t", "Ünd? ", "x" * 5000 + ".", None]
    roles = ["user", "assistant", "system", "tool", "", "Assistant", None]
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 14)):
            if rng.random() < 0.1:
                continue
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn if rng.random() < 0.95 or turn != 3 else None, role, rng.choice(texts) if rng.random() < 0.5 else f"Line {rng.random()}."))
    # one conversation with a third of all rows, a long stretch that is all cut short, and one that is all blank
    rows += [(500, t, ("user", "assistant")[(t + t // 7) % 2], f"w {t}" if 40 < t < 90 else f"w {t}.") for t in range(150)]
    rows += [(501, t, "user", " ") for t in range(40)] + [(502, 7, "user", "Same.")] * 1 + [(503, 0, "user", "a."), (503, 1, "user", "a.")]
    return rows


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in invented()], ROWS)


@pytest.mark.parametrize("how", [{}, {"piece_rows": 3}, {"piece_rows": 3, "passes": 0}, {"piece_rows": 5, "passes": 1}, {"piece_bytes": 10}])
def test_repair_equals_trying_all_edits(talk, how):
    got = conversation.repair(conversation.damage(talk).repartition(5), **how).collect()
    want = damaged(invented())
    assert Counter(r.conv_id for r in got) == Counter(want.keys())
    for r in got:
        assert tuple(r)[1:] == repaired(want[r.conv_id]), r.conv_id


def test_repair_takes_copies_of_one_row(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 1)] * 400 + [(1, 1, "assistant", "Ho.", 3), (2, 5, "user", "Hi.", 0)], "conv long, turn long, role string, text string, copies int")
    got = {r.conv_id: r for r in conversation.repair(rows.repartition(7), piece_rows=16).collect()}
    assert (got[1].duplicate, got[1].cost, got[1].audit) == (401, 802, "K" + "D" * 399 + "KDD")
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_nothing(talk):
    assert conversation.repair(conversation.damage(talk.limit(0))).count() == 0


def test_speculative_runs_meet(spark):
    rng = random.Random(1)
    for _ in range(200):
        codes, kinds = bytes(rng.choices(range(4), k=30)), bytes(rng.choices(range(4), k=30))
        end, other = conversation.back(conversation.END, rng.randrange(2), rng.randrange(4)), (0, 0, 0, 0)
        old = conversation.backward(codes, kinds, other)[-1]
        want = conversation.backward(codes, kinds, end)[-1]
        assert conversation.run_again(codes, kinds, other, old, end) == want
        m = conversation.transfer(codes, kinds)
        v = [min(end[t] + m[4 * t + s] for t in range(4)) for s in range(4)]
        assert tuple(x - min(v) for x in v) == want


def test_registered_repair_on_the_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, sf).collect()
    want = damaged(rows)
    assert len(got) == len(want)
    assert all(tuple(r)[1:] == repaired(want[r.conv_id]) for r in got)


# ---- periodic runs ---------------------------------------------------------------------------


def all_runs(w):
    out, seen, n = [], set(), len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q) and (s, i + q) not in seen:
                seen.add((s, i + q))
                out.append((s, i + q - s, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def wanted(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = all_runs(w)
    gone = {x for s, length, q in found for x in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t ", "one", "a " * 500, "a b " * 300 + "c", "x\x1cy z " * 9, "ü ö\v" * 20 + "  ü ö " * 9, "word" * 20_000]
    for _ in range(150):
        size = rng.choice([1, 2, 3, 5, 40])
        w = [f"w{rng.randrange(size)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 5)):
            u = [f"w{rng.randrange(size)}" for _ in range(rng.randint(1, 20))]
            w += (u * rng.randint(1, 3) + [f"w{rng.randrange(size)}"]) * rng.randint(1, 5)
            if rng.random() < 0.3:
                w += w[::-1]
            w = w[:500]
        out.append(" ".join(w))
    # stretches of one period that meet in the middle: many runs in one place
    out += [" ".join(("b a " * k + "a b " * k).split()) for k in (5, 9, 40)] + [" ".join(["a"] * 30 + ["b"] + ["a"] * 31 + ["b"] + ["a"] * 30 + ["b"] + ["a"] * 40)]
    return out


@pytest.mark.parametrize("block_bytes", [1 << 21, 300])
def test_runs_equal_all_comparisons(spark, block_bytes):
    rows = [(i, t, i) for i, t in enumerate(texts())] + [(None, "a b c " * 8, 1), (3, "one", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs long")
    got = periodicity.find(docs, repeat_tails=True, block_bytes=block_bytes).drop("n_words").collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *wanted(i, t)) for i, t, _ in rows)
    assert periodicity.find(docs.limit(0)).count() == 0


def test_registered_runs_on_the_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    small = {r.doc_id for r in docs if len(r.text or "") < 12_000}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if r.doc_id in small:
            assert got[r.doc_id] == wanted(r.doc_id, r.text), r.doc_id


# ---- quality ---------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op12_quality_classifier"](spark, sf).join(labels, "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.predicted for r in rows])
    assert len(rows) > 50 and p[y == 1].mean() > 0.97 and p[y == 0].mean() < 0.25
    s = np.array([r.score for r in rows])
    assert ((s[y == 1][:, None] > s[y == 0][None]).mean()) > 0.97 and s.min() >= 0 and s.max() <= 1


def test_quality_scores_equal_the_mean_of_vectors():
    """The shortened scoring against all features of a text, one by one."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    odds = rng.normal(size=1 << embedding.BITS)
    texts = ["Ärger, ärger und\tWut", "one", "", None, "the the THE cat", "ab " * 50 + "c" * 300]

    def row(raw):
        return int(embedding.hashes(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0] >> np.uint64(64 - embedding.BITS))

    got = next(embedding.scored(odds, 0.25)(iter([pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["id", "text"])]))).column("score").to_pylist()
    for text, score in zip(texts, got):
        found = []
        w = [bytes(x + 32 if 65 <= x <= 90 else x for x in t) for t in (text or "").encode().split()]
        for t in w:
            found.append(row(b"\xfe" + t + b"\xff"))
            c = [b"\xfe", *(x.encode() for x in t.decode()), b"\xff"]
            found += [row(b"".join(c[i : i + n])) for n in embedding.GRAMS for i in range(len(c) - n + 1)]
        h = [embedding.hashes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0] for t in w]
        with np.errstate(over="ignore"):
            pairs = [embedding.SAME if a == b else embedding.mix(np.array([a * np.uint64(31) + b]))[0] for a, b in zip(h, h[1:])]
        found += [int(x >> np.uint64(64 - embedding.BITS)) for x in pairs]
        x = 0.25 + (odds[found].mean() if found else 0)
        assert abs(1 / (1 + np.exp(-x)) - score) < 1e-9, text


def test_quality_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "word " * 30_000, 3), (4, "good text here", 4), (4, "good text here", 4), (None, "no id", 5), (5, "bad !! bad", 6)],
                                 "doc_id long, text string, score long")
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 1), (3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = embedding.quality(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.score)
    assert all(len(v) == 1 for v in by.values()) and by[1] == by[2]
    assert embedding.quality(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert embedding.quality(docs.limit(0), labels).count() == 0
