"""N-gram Jaccard join by a MinHash LSH forest.

Two texts are linked when the Jaccard similarity of their sets of five-word shingles is at least 0.8.
Equal texts are one text first (grouped by digest, with partial aggregation). Each text gets one
signature per tree; texts meet at prefixes of their signatures in the trie of a tree. A link of
similarity s shares a prefix of k values in one of L trees with probability 1 - (1 - s^k)^L. Prefixes
are as long as the weakest link that counts still reaches the target probability, so no link's chance
depends on what other links there are. Only texts that share a prefix are fetched and verified, with
their exact shingle sets.

Inside a prefix group, pairs are counted, not emitted: a task gets two blocks of a group (bounded by
members and by shingles, so a group of any size is split), intersects them exactly, and returns a
count per text and the edges of a spanning forest. A pair that several trees propose is counted in
the first of them only. Edges are linear in the members, and components come from them.

Defined cases: a null text counts as empty; texts of one to four words are one shingle; texts without
a word are linked to equal texts only; repeated rows are copies; a null id is kept, and a class takes
the smallest id that is not null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import blocks, column_of, hashes, mix, sorted_set, words
from tierline.session import materialize

WORDS, SIMILARITY, TREES, DEPTH, TARGET_RECALL = 5, 0.8, 16, 6, 0.999
#: What a task holds of a prefix group: two blocks of about so many texts and shingles each.
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 250_000

_MULTIPLY = mix(np.arange(1, 4096, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(5001, 9096, dtype=np.uint64))


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of each text, and where each text's begin. Shorter texts have one."""
    starts, ends, text = words(data, offsets)
    h = hashes(data, starts, ends)
    per_text = np.bincount(text, minlength=len(offsets) - 1)
    begins = np.cumsum(per_text) - per_text
    grams = np.where(per_text >= n, per_text - n + 1, (per_text > 0).astype(np.int64))
    out_begins = np.concatenate([[0], np.cumsum(grams)])
    at = np.repeat(begins - out_begins[:-1], grams) + np.arange(out_begins[-1])
    out = np.zeros(len(at), np.uint64)
    short = np.repeat(per_text < n, grams)
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    for k in range(n):
        inside = ~short | (np.repeat(per_text, grams) > k)
        out = np.where(inside, mix(out * np.uint64(31) + padded[at + k]), out)
    return out, out_begins


def signed(n: int, trees: int, depth: int):
    """(id, text) to (id, digest, shingle count, signature of trees x depth 32-bit minima)."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column("text")):
                grams, begins = shingles(data, offsets, n)
                full = np.flatnonzero(np.diff(begins))
                sig = np.zeros((j - i, trees * depth), np.uint32)
                if len(full):
                    for k in range(trees * depth):
                        values = ((grams * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)
                        sig[full, k] = np.minimum.reduceat(values, begins[full])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], batch.column("digest")[i:j], pa.array(np.diff(begins)),
                     pa.array([x.tobytes() for x in sig.astype("<u4")], pa.binary())],
                    ["doc_id", "digest", "n_shingles", "signature"],
                )

    return run


def prefixes(trees: int, depth: int, k: int):
    """(digest, n_shingles, signature) to one row per tree with the hash of its first k values."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            n = len(batch)
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(n, trees, depth).astype(np.uint64)
            h = np.zeros((n, trees), np.uint64)
            for d in range(k):
                h = mix(h * np.uint64(31) + sig[:, :, d] + np.uint64(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").take(pa.array(np.repeat(np.arange(n), trees))), pa.array(np.repeat(batch.column("n_shingles").to_numpy(), trees)),
                 pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), pa.array(h.ravel().view(np.int64))],
                ["digest", "n_shingles", "tree", "prefix"],
            )

    return run


def gram_sets(n: int):
    """(digest, text) to (digest, sorted distinct shingle hashes as bytes)."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column("text")):
                grams, begins = shingles(data, offsets, n)
                sets = [sorted_set(grams[a:b]).tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("digest")[i:j], pa.array(sets, pa.binary())], ["digest", "grams"])

    return run


def verified(least: float, trees: int, depth: int, k: int):
    """Two blocks of a prefix group to link counts and spanning edges."""

    def run(key, table):
        tree, left, right = key[1].as_py(), key[3].as_py(), key[4].as_py()
        table = table.sort_by("digest")
        digests, side = table.column("digest").to_pylist(), table.column("block").to_numpy()
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(len(digests), trees, depth)[:, :, :k]
        sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        flat = np.searchsorted(sorted_set(flat), flat)
        begins = np.cumsum(sizes) - sizes
        mark = np.zeros(int(flat.max()) + 1, np.int64)
        links, label, out = np.zeros(len(sets), np.int64), np.arange(len(sets)), []
        for i in range(len(sets)):
            other = np.zeros(len(sets), bool)
            other[:i] = (side[:i] != side[i]) if left != right else True
            if tree:
                other[:i] &= ~(sig[:i, :tree] == sig[i, :tree]).all(axis=2).any(axis=1)
            if not other.any():
                continue
            own = flat[begins[i] : begins[i] + sizes[i]]
            mark[own] = 1
            common = np.add.reduceat(mark[flat[: begins[i]]], begins[:i])
            mark[own] = 0
            similar = common / (sizes[:i] + sizes[i] - common)
            linked = np.flatnonzero(other[:i] & (similar >= least))
            if not len(linked):
                continue
            links[i] += len(linked)
            links[linked] += 1
            for joined in np.unique(label[linked]):
                out.append((digests[i], digests[int(linked[label[linked] == joined][0])], None))
            merged = np.isin(label, np.append(label[linked], label[i]))
            label[merged] = label[merged].min()
        out += [(d, None, int(x)) for d, x in zip(digests, links, strict=True) if x]
        names, types = ("a", "b", "links"), (pa.string(), pa.string(), pa.int64())
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], list(names))

    return run


def components(spark, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component. Rounds grow with the log of a chain's length."""
    both = materialize(spark, edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(spark, both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        spread = labels.join(near, labels.node == near.a).select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        at = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        new = materialize(spark, spread.join(at, spread.label == at["at"], "left").select("node", F.least("label", F.coalesce("jump", "label")).alias("label"), "old"))
        if not new.filter("label < old").take(1):
            return new.select("node", "label")
        labels = new.select("node", "label")


def prefix_length(least: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix by which a link of similarity `least` is found with the target probability; 1 if there is none."""
    return next((k for k in range(depth, 1, -1) if 1 - (1 - least**k) ** trees >= target), 1)


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, least: float = SIMILARITY,
                    trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, n_links (linked different texts), text_id (smallest id of the
    equal texts), label (names the class, also where it has no id) and digest (of the text)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("digest"), text.alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = materialize(spark, source.mapInArrow(signed(n, trees, depth), f"doc_id {id_type}, digest string, n_shingles long, signature binary"))
    texts = materialize(spark, rows.groupBy("digest").agg(F.min("doc_id").alias("text_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    wordy = texts.filter("n_shingles > 0").select("digest", "n_shingles", "signature")

    k = prefix_length(least, trees, depth, target)
    entries = wordy.mapInArrow(prefixes(trees, depth, k), "digest string, n_shingles long, tree int, prefix long")
    groups = entries.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("grams")).filter("members > 1")
    split = groups.withColumn("n_blocks", F.ceil(F.greatest(F.col("members") / BLOCK_TEXTS, F.col("grams") / BLOCK_SHINGLES)).cast("int"))
    shared = materialize(spark, entries.join(split, ["tree", "prefix"]).select("digest", "tree", "prefix", "n_blocks"))
    wanted = shared.select("digest").distinct()
    first = texts.join(wanted, "digest").select("text_id", F.col("digest").alias("text_digest"))
    first_rows = source.join(first, (F.col("digest") == F.col("text_digest")) & F.col("doc_id").eqNullSafe(F.col("text_id")), "left_semi")
    sets = materialize(spark, first_rows.select("digest", "text").mapInArrow(gram_sets(n), "digest string, grams binary").dropDuplicates(["digest"]))
    members = shared.join(sets, "digest").join(wordy.select("digest", "signature"), "digest")
    block = F.pmod(F.xxhash64("digest"), F.col("n_blocks")).cast("int")
    members = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    members = members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = materialize(spark, members.select("prefix", "tree", "n_blocks", "low", "high", "block", "digest", "signature", "grams")
                        .groupBy("prefix", "tree", "n_blocks", "low", "high")
                        .applyInArrow(verified(least, trees, depth, k), "a string, b string, links long"))

    links = found.filter("links is not null").groupBy(F.col("a").alias("digest")).agg(F.sum("links").alias("n_links"))
    label = components(spark, found.filter("b is not null"))
    named = texts.select("digest", "text_id").join(label.withColumnRenamed("node", "digest"), "digest", "left").join(links, "digest", "left")
    named = materialize(spark, named.select("digest", "text_id", F.coalesce("label", "digest").alias("label"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")))
    classes = named.groupBy("label").agg(F.min("text_id").alias("class_id"))
    by_text = materialize(spark, named.join(classes, "label").select("digest", "text_id", "label", "class_id", "n_links"))
    return rows.select("doc_id", "digest").join(by_text, "digest").select("doc_id", "class_id", "n_links", "text_id", "label", "digest")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near duplicates: of each class the row with the smallest id, once if it is repeated.

    A class in which no row has an id keeps the row with the smallest digest.
    """
    spark = docs.sparkSession
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    joined = similarity_join(docs, id_col, text_col)
    kept = joined.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest"))).alias("r"))
    kept = materialize(spark, kept.select(F.col("r.doc_id").alias("_kept_id"), F.col("r.digest").alias("_kept_digest")))
    own = column_of("_kept_by", docs.columns)
    named = docs.withColumn(own, digest)
    out = named.join(kept, (named[own] == kept["_kept_digest"]) & named[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
    return out.dropDuplicates([id_col, own]).drop(own)
