"""Cases in which an operator once did less than its whole job."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tierline.llm import maxent, packing, similarity, warc


def test_packing_keeps_non_ascii_signs_and_marks_with_the_signs_after_them(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["hello”, he", "है, और", "wow😀!", "end…)", "«a». “It’s,” she said…!", "50€. 5², x", "H̱, é. T̈!", "J̌Å' é's ”'s x'S", "caf́é,b a ,b", "a!́,", "plain, it's (a) 'b', 1,2."]
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert got[k] == (len(ids), zlib.crc32(ids.tobytes())), text


def test_warc_payloads_that_end_in_line_breaks(spark, tmp_path):
    ends = ["\r", "\n", "\r\n", "\n\r", "\r\n\r", "\r\n\r\n", "\r\n\r\n\r", "\r\n\r\r\n\r\n", "\r\n" * 40_001, "\n\r\n\r\n"]
    texts = {k: f"<html>{k}</html>{end}" for k, end in enumerate(ends)} | {100 + k: end for k, end in enumerate(ends)}
    pages = spark.createDataFrame([(k, "u", text) for k, text in texts.items()], "page_id long, url string, html string")
    for roll_bytes in (200, 1 << 20):
        folder = f"file://{tmp_path}/{roll_bytes}"
        warc.write(pages, folder, roll_bytes=roll_bytes)
        assert {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, folder).collect()} == texts


def test_a_weak_link_does_not_depend_on_the_links_of_others(spark, monkeypatch):
    used = []
    prefixes = similarity.prefixes
    monkeypatch.setattr(similarity, "prefixes", lambda trees, depth, k: used.append(k) or prefixes(trees, depth, k))
    hot = [(i, " ".join([f"w{k}" for k in range(100)] + [f"v{i}"])) for i in range(30)]
    similarity.similarity_join(spark.createDataFrame(hot, "doc_id long, text string"))
    assert 1 - (1 - similarity.SIMILARITY ** used[-1]) ** similarity.TREES >= similarity.TARGET_RECALL


def test_near_copies_without_an_id_are_linked(spark):
    base = {x: [f"{x}{k}" for k in range(60)] for x in "abc"}
    text = lambda x, v: " ".join([*base[x], v])
    rows = [(None, text("a", "one")), (None, text("a", "two")), (None, text("b", "one")), (7, text("b", "two")), (None, text("b", "one")), (8, text("c", "one")), (9, "alone"), (None, "alone too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in similarity.similarity_join(docs).collect())
    assert got == sorted([(0, 0, 1), (0, 0, 1), (0, 7, 1), (7, 7, 1), (0, 7, 1), (8, 8, 0), (9, 9, 0), (0, 0, 0)])
    kept = [r.text for r in similarity.one_of_each(docs).collect()]
    assert len(kept) == 5 and rows[3][1] in kept and rows[2][1] not in kept and sum(x in kept for x in (rows[0][1], rows[1][1])) == 1


def test_a_context_of_one_partition_keeps_its_weight(spark):
    rng = np.random.default_rng(4)
    plain = [" ".join(f"w{k}" for k in rng.integers(0, 50, 200)) for _ in range(120)]
    rows = [(k, " ".join(["zeta omega"] * 100)) for k in range(8)] + [(k + 8, x) for k, x in enumerate(plain)] + [(1000, "zeta omega zeta omega")]
    gain = []
    for tasks in (1, 16):
        docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, tasks), "doc_id long, text string")
        (r,) = maxent.score(docs, docs.doc_id == 1000).filter("doc_id = 1000").collect()
        gain.append(r.score - r.base_score)
    assert gain[1] > 0.5 * gain[0] > 0, gain


def test_every_archive_has_a_task_of_its_own(spark, tmp_path):
    records = spark.range(3200).select((F.col("id") % 32).alias("file"), "id")
    got = warc.dealt(records, 32).select("file", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(got) == 32 and all(r.file == r.task for r in got)
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 40) for k in range(60)], "page_id long, url string, html string")
    limit = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        warc.write(pages, f"file://{tmp_path}/some", roll_bytes=200)
        assert len(list((tmp_path / "some").glob("*.warc.gz"))) > 3
        assert {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, f"file://{tmp_path}/some").collect()} == {k: f"page {k} " * 40 for k in range(60)}
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", limit)
