"""The q-gram filter against an exhaustive search, and benchmarks of several shards, without ids and with ids that are texts."""

import numpy as np
import pytest

from tierline.llm import decontamination, similarity


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def arrays(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def damaged(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at = int(rng.integers(0, len(out)))
        kind = int(rng.integers(0, 3))
        out[at : at + (kind != 0)] = [] if kind == 2 else ["abcd"[int(rng.integers(0, 4))]]
    return "".join(out)


@pytest.mark.parametrize("at_once", [7, 1 << 21])
def test_filter_agrees_with_trying_all_places(monkeypatch, at_once):
    monkeypatch.setattr(decontamination, "MOST_SHARED", at_once)
    rng = np.random.default_rng(11)
    word = lambda n: "".join("abcd"[int(k)] for k in rng.integers(0, 4, n))
    common = word(24)  # q-grams that many items share
    items = [word(int(n)) for n in rng.integers(5, 120, 12)] + [common + word(40) for _ in range(8)] + [common * 3]
    texts = ["", word(3), common * 6]
    for item in items:
        for edits in (0, len(item) // 20, len(item) // 12):
            texts.append(word(int(rng.integers(0, 30))) + damaged(rng, item, edits) + word(int(rng.integers(0, 30))))
    index = decontamination.Index([(k, x) for k, x in enumerate(items)], decontamination.EDIT_SHARE)
    got = decontamination.matches(index, *arrays(texts))
    want = [(t, k) for t, text in enumerate(texts) for k, item in enumerate(items) if least_edits(item, text) <= index.edits[k]]
    assert got == want and len(want) > 40


def rows_of(frame):
    return sorted((r.doc_id, r.item_ids) for r in frame.collect())


def test_items_without_ids_with_text_ids_and_in_shards(spark):
    rng = np.random.default_rng(3)
    word = lambda n: "".join("abcdefgh"[int(k)] for k in rng.integers(0, 8, n))
    items = [(str(k) if k else None, word(80)) for k in range(10)]
    texts = [(k, f"before {items[k % 10][1]} after") for k in range(20)] + [(20, items[0][1] + items[1][1] + items[9][1]), (21, "clean"), (22, None), (22, None)]
    docs = spark.createDataFrame([(k, t, [k]) for k, t in texts], "doc_id long, text string, ids array<int>")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = sorted([(k, [items[k % 10][0]]) for k in range(20)] + [(20, ["1", "9", None]), (21, []), (22, []), (22, [])])
    whole = decontamination.contaminated(docs, bench)
    assert rows_of(whole) == want and whole.columns == ["doc_id", "text", "ids", "item_ids"]
    sharded = decontamination.contaminated(docs, bench, shard_bytes=200)
    assert rows_of(sharded) == want and sharded.columns == whole.columns
    assert "MapInArrow" not in sharded._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.doc_id for r in decontamination.clean(docs, bench).collect()) == [21, 22, 22]
    assert sorted(r.doc_id for r in decontamination.clean(docs, bench, shard_bytes=200).collect()) == [21, 22, 22]


def test_near_duplicates_keep_a_column_of_their_helpers_name(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b", "y"), (3, None, "z")], "doc_id long, text string, _kept_by string")
    got = similarity.one_of_each(docs)
    assert got.columns == docs.columns and sorted((r.doc_id, r._kept_by) for r in got.collect()) == [(1, "x"), (3, "z")]
