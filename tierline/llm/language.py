"""Language identification by a bidirectional gated recurrent network over bytes.

A word's bytes run through one gated recurrent layer forwards and one backwards; from both states every
byte position gets a distribution over the languages, and a document's distribution is the mean over all its positions. The
network is trained here in numpy, by backpropagation through time with Adam, on the words of a bounded,
documented sample of labelled documents. The state starts anew at each word (long words are cut after
`LONGEST` bytes), so equal words have equal labels: within a block of texts each different word is run
once, and its positions count as often as it occurs. Every byte of every text is labelled.

Defined cases: a null text or one without a letter is `und` with score 0; rows with a null language are not learned from;
if nothing can be learned every text is `und`; with one language all texts with letters get it; ties go to the language that sorts first;
repeated rows are labelled alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.batches import blocks, column_of, distinct_words, words
from tierline.session import materialize

LONGEST, HIDDEN = 48, 16
#: The training sample: documents per language, and different words of these per language.
DOCS_PER_LANG, WORDS_PER_LANG = 600, 6000
EPOCHS, BATCH, RATE, SEED = 6, 256, 0.01, 20

UNKNOWN = "und"


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def start(n_langs: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shape = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0] if len(s) > 1 and s[0] != 256 else 4)).astype(np.float32)
    out = {"o": shape(2 * hidden, n_langs), "ob": np.zeros(n_langs, np.float32)}
    for way in "fb":
        out |= {f"{way}x": shape(256, 3 * hidden) * np.float32(0.5), f"{way}u": shape(hidden, 2 * hidden), f"{way}c": shape(hidden, hidden)}
    return out


def run_way(net, way: str, x: np.ndarray, keep: bool):
    """States of one direction at every position of a batch of equally long words; with what the way back needs."""
    n, length = x.shape
    hidden = net[f"{way}c"].shape[0]
    h, states, kept = np.zeros((n, hidden), np.float32), np.empty((length, n, hidden), np.float32), []
    for t in range(length) if way == "f" else range(length - 1, -1, -1):
        g = net[f"{way}x"][x[:, t]]
        zr = sigmoid(g[:, : 2 * hidden] + h @ net[f"{way}u"])
        z, r = zr[:, :hidden], zr[:, hidden:]
        rh = r * h
        c = np.tanh(g[:, 2 * hidden :] + rh @ net[f"{way}c"])
        if keep:
            kept.append((t, h, z, r, rh, c))
        h = h + z * (c - h)
        states[t] = h
    return states, kept


def positions(net, x: np.ndarray, keep: bool = False):
    """Probabilities (position, word, language), and the states with what training needs."""
    ways = [run_way(net, way, x, keep) for way in "fb"]
    states = np.concatenate([s for s, _ in ways], axis=2)
    y = states @ net["o"] + net["ob"]
    y = np.exp(y - y.max(axis=2, keepdims=True))
    return y / y.sum(axis=2, keepdims=True), states, [k for _, k in ways]


def gradients(net, x: np.ndarray, target: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
    """Backpropagation through time of the cross entropy at every position."""
    p, states, kept = positions(net, x, keep=True)
    hidden = net["fc"].shape[0]
    dy = (p - target[None]) * (importance / importance.sum() / x.shape[1])[None, :, None]
    flat = dy.reshape(-1, dy.shape[2])
    out = {"o": states.reshape(-1, 2 * hidden).T @ flat, "ob": flat.sum(axis=0)}
    from_output = dy @ net["o"].T
    for k, way in enumerate("fb"):
        u, c_ = net[f"{way}u"], net[f"{way}c"]
        du, dc_, dx = np.zeros_like(u), np.zeros_like(c_), np.zeros_like(net[f"{way}x"])
        dh = np.zeros((x.shape[0], hidden), np.float32)
        for t, h, z, r, rh, c in reversed(kept[k]):
            dh = dh + from_output[t, :, k * hidden : (k + 1) * hidden]
            d_c = dh * z * (1 - c * c)
            d_rh = d_c @ c_.T
            d_zr = np.concatenate([dh * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
            du += h.T @ d_zr
            dc_ += rh.T @ d_c
            hot = np.zeros((x.shape[0], 256), np.float32)
            hot[np.arange(x.shape[0]), x[:, t]] = 1
            dx += hot.T @ np.concatenate([d_zr, d_c], axis=1)
            dh = dh * (1 - z) + d_rh * r + d_zr @ u.T
        out |= {f"{way}x": dx, f"{way}u": du, f"{way}c": dc_}
    return out


def train_network(examples: list[bytes], target: np.ndarray, importance: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Adam over batches of equally long words. `target` has each word's distribution over the languages."""
    net, rng = start(target.shape[1]), np.random.default_rng(SEED)
    lengths = np.array([len(x) for x in examples])
    order = np.arange(len(examples))
    mean, square, step = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}, 0
    total = epochs * sum(-(-int(n) // BATCH) for n in np.bincount(lengths))
    for _ in range(epochs):
        rng.shuffle(order)
        batches = []
        for n in np.unique(lengths):
            own = order[lengths[order] == n]
            batches += [own[i : i + BATCH] for i in range(0, len(own), BATCH)]
        for b in rng.permutation(len(batches)):
            own = batches[b]
            x = np.frombuffer(b"".join(examples[i] for i in own), np.uint8).reshape(len(own), -1)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, g in gradients(net, x, target[own], importance[own]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                net[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def words_of(batches):
    """(lang, text) to (lang, word, how often) per batch."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for i, j, data, offsets in blocks(batch.column("text")):
            starts, ends, text = words(data, offsets, LONGEST)
            first, inverse, _ = distinct_words(data, starts, ends)
            number = {x: k for k, x in enumerate(sorted(set(langs[i:j])))}
            code = inverse * len(number) + np.array([number[x] for x in langs[i:j]])[text]
            count = np.bincount(code, minlength=len(first) * len(number))
            at = np.flatnonzero(count)
            names = list(number)
            found = [data[s:e].tobytes() for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in (at % len(number)).tolist()]), pa.array([found[k] for k in (at // len(number)).tolist()], pa.binary()), pa.array(count[at])],
                ["lang", "word", "n"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_lang: int = DOCS_PER_LANG, words_per_lang: int = WORDS_PER_LANG) -> tuple[list[str], dict]:
    """(languages, network) from the labelled rows given; at most docs_per_lang rows of each language are read."""
    spark = docs.sparkSession
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = materialize(spark, labelled.withColumn("nth", nth).filter(F.col("nth") <= docs_per_lang).select("doc_id", "lang").distinct())
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    # at most docs_per_lang rows of two values per language are broadcast
    found = text.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text").mapInArrow(words_of, "lang string, word binary, n long")
    counts = found.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), F.xxhash64("word"), "word"))
    rows = counts.withColumn("k", best).filter(F.col("k") <= words_per_lang).select("lang", "word", "n").collect()
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return [], {}
    table: dict[bytes, np.ndarray] = {}
    for r in sorted(rows, key=lambda r: (bytes(r["word"]), r["lang"])):
        table.setdefault(bytes(r["word"]), np.zeros(len(langs), np.float32))[langs.index(r["lang"])] += r["n"]
    target = np.stack(list(table.values()))
    total = target.sum(axis=1)
    return langs, train_network(list(table), target / total[:, None], np.sqrt(total))


def labelled(langs: list[str], net: dict, name: str, letters: str, into: tuple[str, str]):
    """Adds the language and its score, both from the mean over all positions."""

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(name)):
                n = j - i
                pooled = np.zeros((n, len(langs)))
                if len(langs):
                    starts, ends, text = words(data, offsets, LONGEST)
                    first, inverse, _ = distinct_words(data, starts, ends)
                    begin, size = starts[first], (ends - starts)[first]
                    sums = np.zeros((len(first), len(langs)), np.float32)
                    for length in np.flatnonzero(np.bincount(size, minlength=1)).tolist():
                        own = np.flatnonzero(size == length)
                        for a in range(0, len(own), 4096):
                            part = own[a : a + 4096]
                            sums[part] = positions(net, data[begin[part][:, None] + np.arange(length)])[0].sum(axis=0)
                    for k in range(len(langs)):
                        pooled[:, k] = np.bincount(text, weights=sums[inverse, k], minlength=n)
                    pooled /= np.maximum(1, np.bincount(text, weights=ends - starts, minlength=n))[:, None]
                    best, score = pooled.argmax(axis=1), pooled.max(axis=1).clip(0, 1)
                part = batch.slice(i, n)
                ok = np.array(part.column(letters).to_pylist(), bool) & bool(langs)
                pred = [langs[best[k]] if ok[k] else UNKNOWN for k in range(n)]
                kept = part.drop_columns([letters])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(pred, pa.string()), pa.array([float(score[k]) if ok[k] else 0.0 for k in range(n)])], [*kept.schema.names, *into])

    return run


def identify(docs: DataFrame, labelled_docs: DataFrame, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "lang_score"), **options) -> DataFrame:
    """`docs` with the predicted language and its score; the network is trained on `labelled_docs`."""
    langs, net = learn(labelled_docs, text_col=text_col, **options)
    letters = column_of("_letters", docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType())])
    return docs.withColumn(letters, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))).mapInArrow(labelled(langs, net, text_col, letters, into), schema)
