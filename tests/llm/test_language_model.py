"""The language model against plain Python, one decision and one feature at a time."""

import math

import numpy as np

from tierline.llm import maxent

TEXTS = ["the cat sat on the mat", "", "a cat", "zebra", "the the the the", "on a mat the cat sat unheardof"]


def arrays(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def counted(texts):
    h, bucket, _, _ = maxent.tokens(*arrays(texts))
    u, at, n = np.unique(h, return_index=True, return_counts=True)
    return [{"word": int(w), "n": int(k), "bucket": int(bucket[i])} for w, i, k in zip(u.view(np.int64), at, n, strict=True)]


def vocabulary_of(texts):
    rows = counted(texts)
    masses = np.full(maxent.WIDTH, 0.5)
    for r in rows:
        if r["n"] < maxent.LEAST_COUNT:
            masses[r["bucket"]] += r["n"] + 0.5
    return maxent.Vocabulary(rows, sum(r["n"] for r in rows), len(rows), masses)


def test_scores_agree_with_plain_softmaxes():
    vocabulary = vocabulary_of(TEXTS * 9 + [f"word{k}" for k in range(300) for _ in range(9)])
    model = maxent.Model(vocabulary)
    model.weights += np.random.default_rng(3).standard_normal(model.weights.shape).astype(np.float32)
    texts = [*TEXTS, *(" ".join(f"word{k * j % 310}" for k in range(j)) for j in range(44))]
    h, bucket, _, begins = maxent.tokens(*arrays(texts))
    leaf = vocabulary.leaves(vocabulary.find(h), bucket)
    f = model.contexts(h, begins)
    got = np.add.reduceat(model.log10(f, leaf), begins[:-1])
    tree, mask = vocabulary.tree, (1 << 64) - 1
    for k in range(len(texts)):
        want = 0.0
        for i in range(begins[k], begins[k + 1]):
            p = 1.0
            for step in range(tree.begins[leaf[i]], tree.begins[leaf[i]] + tree.depth[leaf[i]]):
                node = int(tree.node[step])
                scores = [float(x) for x in tree.shares[node]]
                for x in f[:, i]:
                    row = (((int(x) + node * 0x9E3779B97F4A7C15) & mask) * 0xFF51AFD7ED558CCD & mask) >> (64 - model.bits)
                    scores = [a + float(b) for a, b in zip(scores, model.weights[row], strict=True)]
                p *= math.exp(scores[int(tree.branch[step])]) / sum(map(math.exp, scores))
            want += math.log10(p)
        assert abs(got[k] - want) < 1e-3 * max(1, -want), texts[k]


def test_sums_of_rows_agree_with_loops():
    rng = np.random.default_rng(5)
    table = rng.standard_normal((500, maxent.FAN)).astype(np.float32)
    rows = np.sort(np.minimum(rng.pareto(0.7, 1500).astype(np.int64), 400))
    place = rng.integers(0, 500, 1500)
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    at, size, total = maxent.row_sums(table, place, first)
    assert sorted(at) == sorted(first) and size.sum() == 1500 and size.max() > maxent.SHORT_RUN
    for a, n, g in zip(at, size, total, strict=True):
        assert np.allclose(g, sum(table[p] for p in place[a : a + n]), atol=1e-3)
    big = rng.integers(0, 1 << 20, 3000)
    assert (maxent.sorted_places(big) == np.argsort(big, kind="stable")).all()


def test_the_context_of_a_word_far_down_the_list_counts(spark):
    """Of 3,000 words that occur ten times each or more, number 2,000 follows always the same word."""
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(3000) for _ in range(10 + (3000 - k) // 100)]
    rng.shuffle(words)
    words = " ".join(w if w != "w2000" else "signal w2000" for w in words).split()
    rows = [(k, " ".join(words[k * 100 : k * 100 + 100])) for k in range(len(words) // 100 + 1)]
    rows += [(10_000, "signal w2000"), (10_001, "w5 w2000")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score - r.base_score for r in maxent.score(docs, docs.doc_id >= 10_000).filter("doc_id >= 10000").collect()}
    assert got[10_000] > got[10_001] + 0.3, got


def test_the_table_of_common_words_is_filled_when_counts_tie(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 50)
    rng = np.random.default_rng(2)
    words = [(int(h), 0, 1000 + k if k < 20 else 3) for k, h in enumerate(rng.integers(-(1 << 62), 1 << 62, 400))]
    counts = spark.createDataFrame(words, "word long, bucket long, n long")
    got = {r.word for r in maxent.commonest(counts).collect()}
    assert {w for w, _, n in words if n > 3} < got and 40 <= len(got) <= 50
    few = counts.filter("n > 3")
    assert maxent.commonest(few).count() == 20
    tied = maxent.commonest(counts.filter("n = 3")).count()
    assert 40 <= tied <= 50
