"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

The base patterns (e-mail, IP, card, phone) give seed entities. Around seeds and around other strings
that look like identifiers, the words before and after are lexical patterns. Spark builds the graph of
patterns and instances and scores it in rounds: a pattern is as good as the share of all occurrences
of its word in the corpus that stand beside a good instance (of enough different ones); an instance is as good as its patterns
together say; seeds stay certain. Identifiers that no base pattern matches are taken where a pattern
of high confidence stands beside them. Base spans always stay.

Only patterns that can reach the least number of good instances are scored: those beside enough seeds,
or beside enough instances that such patterns could make good. The others could never be accepted, so leaving
them out changes nothing. The word counts behind the shares cover all texts: tasks get the patterns' words as a bitmap of
fixed size and count the words whose bit is set; a join takes out those that only share a bit.

Spans are in code points, end exclusive. Defined cases: a null or empty text has no spans; equal texts have equal
spans; repeated rows give equal rows; very long texts and runs are scanned in linear time; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.batches import PLAIN, blocks, column_of, hashes, words
from tierline.session import materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS, LEAST_SUPPORT, LEAST_CONFIDENCE = 3, 4, 0.6
#: Bits of the bitmap of pattern words that tasks get (512 KB), in pieces of what Spark's bitmap aggregate holds.
WORD_BITS, PIECE_BITS = 22, 15
#: Words, with repeats, that a task adds up before it sends counts on.
HELD_WORDS = 1 << 18

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LIKE_NUMBER = re.compile(r"\(?[0-9][0-9().\x20-]*[0-9]")
LIKE_ADDRESS = re.compile(r"@|\[at\]|\(at\)", re.I)
EDGE = " \t\r\n.,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> list[tuple[int, int]]:
    """As the pattern finds them leftmost, but from each @ outwards, so that no run is scanned twice."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        last = m.end() if m else at + 1
        if m:
            out.append((start, last))
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = only_digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def lookalikes(text: str) -> list[tuple[str, int, int]]:
    """Strings in the shape of an identifier, whether or not a base pattern matches them."""
    out = []
    for m in LIKE_ADDRESS.finditer(text):
        left, right = text[max(0, m.start() - 65) : m.start()], text[m.end() : m.end() + 255]
        own = len(left.rstrip()) - len((left.rstrip().rsplit(None, 1) or [""])[-1]) if left.strip() else len(left)
        tail = re.match(r"\s?[^\s,;<>()\[\]\"']+", right)
        if own < len(left) and tail:
            start, stop = m.start() - len(left) + own, m.end() + tail.end()
            out.append(("email", start, stop))
    if DIGIT.search(text):
        for m in LIKE_NUMBER.finditer(text):
            found = m.group()
            n = len(only_digits(found))
            if 4 <= n <= 12 and found.count(".") == 3 and not re.search(r"[^0-9.]", found):
                out.append(("ip", *m.span()))
            elif 12 <= n <= 19:
                out.append(("card", *m.span()))
            elif 7 <= n <= 11:
                out.append(("phone", *m.span()))
    trimmed = []
    for kind, a, b in out:
        while a < b and text[a] in EDGE.replace("(", ""):
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        if a < b:
            trimmed.append((kind, a, b))
    return trimmed


def word_hash(word: str) -> int | None:
    """The hash of the last (or only) word of a piece of text in its plain form; None if there is none."""
    raw = PLAIN[np.frombuffer(word.encode("utf-8", "replace"), np.uint8)]
    starts, ends, _ = words(raw, np.array([0, len(raw)]))
    return None if not len(starts) else int(hashes(raw, starts, ends).view(np.int64)[-1])


def beside(text: str, a: int, b: int) -> list[tuple[str, int]]:
    """Lexical patterns around a span: the word before and the word after."""
    before = re.findall(r"\S+", text[max(0, a - 64) : a])
    after = re.findall(r"\S+", text[b : b + 64])
    out = []
    if before and (h := word_hash(before[-1])) is not None:
        out.append(("before", h))
    for piece in after[:2]:
        plain = piece.strip(EDGE)
        if plain:
            if (h := word_hash(re.split(r"[^\w]+", plain)[0] or plain)) is not None:
                out.append(("after", h))
            break
    return out


OCCURRENCE = "struct<kind: string, a: int, b: int, seed: boolean, instance: string, patterns: array<struct<side: string, word: long>>>"
_OCC = pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("seed", pa.bool_()), ("instance", pa.string()),
                           ("patterns", pa.list_(pa.struct([("side", pa.string()), ("word", pa.int64())])))]))
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32())]))


def scanned(batches):
    """(id, digest, text) to (id, digest, base spans, occurrences of seeds and lookalikes with their patterns)."""
    for batch in batches:
        spans, found = [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            spans.append([{"kind": k, "a": a, "b": b} for k, a, b in base])
            occurrences = [(k, a, b, True) for k, a, b in base]
            if base or "@" in text or "(at)" in text.lower() or "[at]" in text.lower() or DIGIT.search(text):
                taken = sorted((a, b) for _, a, b in base)
                occurrences += [(k, a, b, False) for k, a, b in lookalikes(text) if not any(x < b and a < y for x, y in near(taken, a, b))]
            found.append([{"kind": k, "a": a, "b": b, "seed": s, "instance": text[a:b].lower(), "patterns": [{"side": x, "word": w} for x, w in beside(text, a, b)]} for k, a, b, s in occurrences])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(spans, _SPAN), pa.array(found, _OCC)], ["doc_id", "digest", "spans", "found"])


def near(taken: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """The spans, sorted by start, that may overlap [a, b)."""
    import bisect

    i = bisect.bisect_left(taken, (a, a))
    out = taken[max(0, i - 4) : i]
    while i < len(taken) and taken[i][0] < b:
        out.append(taken[i])
        i += 1
    return out


def bitmap(asked: DataFrame) -> np.ndarray:
    """One bit per slot of a word's hash, packed in bytes; at most 2^(WORD_BITS - PIECE_BITS) pieces of 4 KB are fetched."""
    slot = F.col("word").bitwiseAND(F.lit((1 << WORD_BITS) - 1))
    pieces = asked.select(F.shiftright(slot, PIECE_BITS).alias("piece"), slot.bitwiseAND(F.lit((1 << PIECE_BITS) - 1)).alias("at"))
    out = np.zeros((1 << (WORD_BITS - PIECE_BITS), 1 << (PIECE_BITS - 3)), np.uint8)
    for r in pieces.groupBy("piece").agg(F.bitmap_construct_agg("at").alias("bits")).collect():
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def summed(word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(word, kind="stable")
    word, n = word[order], n[order]
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    return word[first], np.add.reduceat(n, first) if len(first) else n


def counted(bits: np.ndarray):
    """(text) to (word, n) of the words whose bit is set, added up within the task as far as `HELD_WORDS` go."""

    def run(batches):
        wanted = np.unpackbits(bits, bitorder="little").astype(bool)
        word, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                data = PLAIN[data]
                starts, ends, _ = words(data, offsets)
                h = hashes(data, starts, ends).view(np.int64)
                h = h[wanted[h & ((1 << WORD_BITS) - 1)]]
                word, n = np.concatenate([word, h]), np.concatenate([n, np.ones(len(h), np.int64)])
                if len(word) > HELD_WORDS:
                    word, n = summed(word, n)
                if len(word) > HELD_WORDS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])
                    word, n = word[:0], n[:0]
        word, n = summed(word, n)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])

    return run


def reachable(spark, edges: DataFrame, rounds: int, least_support: int) -> DataFrame:
    """The edges of the patterns that could be accepted in so many rounds if every share were high enough."""
    pattern, instance = ["kind", "side", "word"], ["kind", "instance"]
    good = edges.filter("seed").select(*instance).distinct()
    for _ in range(rounds):
        enough = edges.join(good, instance, "left_semi").groupBy(*pattern).agg(F.count(F.lit(1)).alias("support")).filter(F.col("support") >= least_support)
        kept = materialize(spark, edges.join(enough.drop("support"), pattern, "left_semi"))
        good = kept.select(*instance).union(edges.filter("seed").select(*instance)).distinct()
    return kept


def good_patterns(spark, texts: DataFrame, occurrences: DataFrame, rounds: int = ROUNDS, least_support: int = LEAST_SUPPORT,
                  least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """(kind, side, word, confidence) of the patterns that the graph of patterns and instances trusts."""
    edges = occurrences.select("kind", "instance", "seed", F.explode("patterns").alias("p")).select("kind", "instance", "seed", "p.side", "p.word")
    edges = materialize(spark, edges.groupBy("kind", "side", "word", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")))
    edges = reachable(spark, edges, rounds, least_support)
    asked = edges.select("word").distinct()
    counts = texts.mapInArrow(counted(bitmap(asked)), "word long, n long").groupBy("word").agg(F.sum("n").alias("all"))
    counts = materialize(spark, counts.join(asked, "word", "left_semi"))
    edges = materialize(spark, edges.join(counts, "word"))
    belief = materialize(spark, edges.groupBy("kind", "instance").agg(F.max("seed").alias("seed")).withColumn("belief", F.col("seed").cast("double")))
    for _ in range(rounds):
        rated = edges.drop("seed").join(belief, ["kind", "instance"]).groupBy("kind", "side", "word").agg(
            (F.sum(F.col("n") * F.col("belief")) / (F.first("all") + 1)).alias("confidence"), F.sum((F.col("belief") >= 0.5).cast("int")).alias("support"))
        patterns = materialize(spark, rated.filter(F.col("support") >= least_support).select("kind", "side", "word", F.least("confidence", F.lit(0.999)).alias("confidence")))
        said = edges.join(patterns, ["kind", "side", "word"]).groupBy("kind", "instance").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("said"))
        belief = materialize(spark, belief.select("kind", "instance", "seed").join(said, ["kind", "instance"], "left").select(
            "kind", "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("said", F.lit(0.0))).alias("belief")))
    return patterns.filter(F.col("confidence") >= least_confidence)


def discovered(spark, found: DataFrame, texts: DataFrame, **options) -> DataFrame:
    """(digest, extra): the spans that trusted patterns add to each text, once per different text."""
    occurrences = found.select("digest", F.explode("found").alias("o")).select("digest", "o.*")
    patterns = materialize(spark, good_patterns(spark, texts, occurrences, **options))
    unseen = occurrences.filter(~F.col("seed")).select("digest", "kind", "a", "b", F.explode("patterns").alias("p")).select("digest", "kind", "a", "b", "p.side", "p.word")
    return materialize(spark, unseen.join(patterns, ["kind", "side", "word"]).groupBy("digest").agg(F.collect_set(F.struct("kind", "a", "b")).alias("extra")))


def written(spans):
    """kind:start:end by kind as listed, then start, comma-joined."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(F.lit(list(KINDS)), s["kind"]).alias("k"), s["a"].alias("a"), s["b"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("digest"), text.alias("text"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, digest, spans (base) and extra (added by contexts), arrays of (kind, a, b), for every row."""
    spark = docs.sparkSession
    source = _source(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    found = materialize(spark, source.mapInArrow(scanned, f"doc_id {kind}, digest string, spans array<struct<kind: string, a: int, b: int>>, found array<{OCCURRENCE}>"))
    extra = discovered(spark, found.select("digest", "found"), source.select("text"), **options)
    return found.select("doc_id", "digest", "spans").join(extra, "digest", "left").withColumn("extra", F.coalesce("extra", F.array().cast("array<struct<kind: string, a: int, b: int>>")))


def replaced(name: str, extra: str):
    def run(batches):
        for batch in batches:
            texts = []
            for text, more in zip(batch.column(name).to_pylist(), batch.column(extra).to_pylist(), strict=True):
                if text:
                    spans = sorted((a, -b, k) for k, a, b in [*base_spans(text), *((s["kind"], s["a"], s["b"]) for s in more or [])])
                    parts, at = [], 0
                    for a, b, k in spans:
                        if a >= at:
                            parts += [text[at:a], f"[{k.upper()}]"]
                        at = max(at, -b)
                    text = "".join([*parts, text[at:]]) if spans else text
                texts.append(text)
            kept = batch.drop_columns([extra])
            yield kept.set_column(kept.schema.get_field_index(name), name, pa.array(texts, kept.schema.field(name).type))

    return run


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with each span replaced by its kind in brackets; overlapping spans are one. Other columns and null texts stay."""
    spark = docs.sparkSession
    source = _source(docs, id_col, text_col)
    found = materialize(spark, source.mapInArrow(scanned, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, digest string, spans array<struct<kind: string, a: int, b: int>>, found array<{OCCURRENCE}>").select("digest", "found"))
    extra_name, digest_name = column_of("_extra", docs.columns), column_of("_digest", docs.columns)
    extra = discovered(spark, found, source.select("text"), **options).select(F.col("digest").alias(digest_name), F.col("extra").alias(extra_name))
    joined = docs.withColumn(digest_name, F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).join(extra, digest_name, "left").drop(digest_name)
    return joined.mapInArrow(replaced(text_col, extra_name), docs.schema)
