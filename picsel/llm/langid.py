"""Language identification by a small convolutional network over bytes.

Filters of 2, 3 and 4 bytes slide over windows of ``WINDOW`` bytes; each filter's largest response in the window, cut at zero, goes into a
softmax layer. The network is trained in numpy on labelled text, and applied to all windows of a whole text in batches; a
text's answer is the language with the largest mean probability over its windows.

A filter of k bytes is a table of weights for each place and byte value, so a response is a sum of k looked-up rows; only the
largest response of a window gets a gradient. For prediction, tables of neighbouring places are joined into tables of byte
pairs.

Training reads at most ``SAMPLE`` documents of each language (those with the smallest hash of the id) and ``PER_DOC`` windows of
each, spread over the text: a bounded sample, whatever the size of the table. Every language is learned; with so many that all would have more than
``SAMPLE_ALL`` documents, each has fewer.

A letter is a character of Unicode's general category L, in training and prediction alike: ``½``, ``²`` and ``ⅷ`` are none.

Odd rows: null texts and texts without a letter get ``und`` and score 0; rows without a language are not learned from; without
any labelled row every text gets ``und``; repeated rows get equal answers; a very long text is predicted from all its windows, 64 at a
time. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from picsel.llm.common import blocks, utf8

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 8
#: Documents of a language that are learned from, of all languages together, and windows of a document.
SAMPLE, SAMPLE_ALL, PER_DOC = 800, 160_000, 2
EPOCHS, RATE, SEED = 8, 0.01, 7


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def windows_of(raw: bytes) -> np.ndarray:
    """The text's windows, the last one filled with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class Network:
    """Weights of the network, and prediction."""

    def __init__(self, languages: list[str], tables, bias, dense, offset):
        self.languages, self.tables, self.bias, self.dense, self.offset = languages, tables, bias, dense, offset
        self.joined = None

    def __getstate__(self):
        return self.__dict__ | {"joined": None}

    def _responses(self, x: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each window."""
        if self.joined is None:
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(1 << 16, -1)
            t2, t3, t4 = self.tables
            self.joined = pair(t2[0], t2[1]), pair(t3[0], t3[1]), t3[2], pair(t4[0], t4[1]), pair(t4[2], t4[3])
        two, three, third, four, last = self.joined
        at = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        return np.concatenate([
            two.take(at, axis=0).max(axis=1),
            (three.take(at[:, :-1], axis=0) + third.take(x[:, 2:], axis=0)).max(axis=1),
            (four.take(at[:, :-2], axis=0) + last.take(at[:, 2:], axis=0)).max(axis=1)], axis=1) + self.bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for i in range(0, len(x), 64):
            z = np.maximum(self._responses(x[i:i + 64]), 0) @ self.dense + self.offset
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[i:i + 64] = z / z.sum(axis=1, keepdims=True)
        return out


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Network:
    """Train by Adam on cross-entropy."""
    rng = np.random.default_rng(SEED)
    n = FILTERS * len(WIDTHS)
    weights = [rng.normal(0, 0.1, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS]
    weights += [np.zeros(n, np.float32), rng.normal(0, 0.3, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), 32):
            x, y = windows[order[a:a + 32]], labels[order[a:a + 32]]
            best, top = [], []
            for w in weights[:len(WIDTHS)]:
                r = sum(w[j].take(x[:, j:WINDOW - len(w) + 1 + j], axis=0) for j in range(len(w)))
                best.append(r.argmax(axis=1))
                top.append(r.max(axis=1))
            act = np.concatenate(top, axis=1) + weights[3]
            h = np.maximum(act, 0)
            z = h @ weights[4] + weights[5]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ weights[4].T) * (act > 0)
            grads = []
            rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)
            for i, w in enumerate(weights[:len(WIDTHS)]):
                g, own = np.zeros_like(w), back[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(len(w)):
                    np.add.at(g[j], (x[rows, best[i] + j], np.broadcast_to(cols, own.shape)), own)
                grads.append(g)
            grads += [back.sum(axis=0), h.T @ p, p.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):
                mean[i] += 0.1 * (g - mean[i])
                square[i] += 0.001 * (g * g - square[i])
                weights[i] -= RATE * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return Network(languages, weights[:3], weights[3], weights[4], weights[5])


def _sample(docs: DataFrame) -> DataFrame:
    """``lang, window`` of the bounded sample.

    Ids are ranked by their hash within a language. A count first tells which hashes can be among the smallest (four times as
    many as needed on average), so that hardly more than the sample is shuffled, however large a language is. Should they be too
    few, as where an id repeats, all rows of the language are ranked.
    """
    own = docs.filter("lang is not null and text is not null").select("doc_id", "lang", "text").filter(has_letter(F.col("text")))
    own = own.withColumn("hash", F.xxhash64("doc_id"))
    spark, ddl = docs.sparkSession, "lang string, cut double"
    counts = own.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    size = max(1, min(SAMPLE, SAMPLE_ALL // max(1, len(counts))))
    cuts = {r.lang: -2.0 ** 63 + 2.0 ** 64 * min(1.0, 4.0 * size / r.n) for r in counts}

    def near():
        # a row for each language is broadcast
        return own.join(F.broadcast(spark.createDataFrame(list(cuts.items()), ddl)), "lang").filter(F.col("hash") <= F.col("cut"))

    large = {r.lang for r in counts if r.n > 4 * size}
    if large:
        found = {r.lang: r.n for r in near().groupBy("lang").agg(F.count("*").alias("n")).collect()}
        cuts.update({lang: 2.0 ** 63 for lang in large if found.get(lang, 0) < size})
    order = Window.partitionBy("lang").orderBy("hash", F.xxhash64("text"))
    own = near().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    schema = pa.schema([("lang", pa.string()), ("window", pa.binary())])

    def run(it):
        for batch in it:
            langs, out = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                all_ = windows_of(utf8(text))
                for i in sorted({k * len(all_) // PER_DOC for k in range(PER_DOC)}):
                    langs.append(lang)
                    out.append(all_[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], schema=schema)
    return own.select("lang", "text").mapInArrow(run, "lang string, window binary")


def train(docs: DataFrame) -> Network | None:
    """A network from the labelled rows of ``doc_id, lang, text``; None without any."""
    rows = sorted(_sample(docs).collect())  # SAMPLE * PER_DOC windows of each language
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    labels = np.array([languages.index(r[0]) for r in rows])
    return fit(np.stack([np.frombuffer(bytes(r[1]), np.uint8) for r in rows]), labels, languages)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``doc_id, held_out, text``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(network)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(it):
        net = shared.value
        for block in blocks(it, "text", 1 << 20):
            texts = block.column("text").to_pylist()
            known = [net is not None and k for k in block.column("known").to_pylist()]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            where = [i for i, k in enumerate(known) if k]
            if where:
                parts = [windows_of(utf8(texts[i])) for i in where]
                size = np.array([len(p) for p in parts])
                total = np.add.reduceat(net.probabilities(np.concatenate(parts)).astype(np.float64), np.cumsum(size) - size, axis=0)
                total /= size[:, None]
                for i, p in zip(where, total):
                    best = int(p.argmax())
                    langs[i], scores[i] = net.languages[best], float(min(p[best], 1.0))
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), pa.array(langs), pa.array(scores, pa.float64())], schema=schema)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), "held_out", text.alias("text"), has_letter(text).alias("known")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(id_col: str = "doc_id", mod: int = 5) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(mod)) == 0


def train_and_predict(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and predict all."""
    marked = docs.select("doc_id", held_out().alias("held_out"), "lang", "text")
    return predict(marked, train(marked.filter("not held_out").select("doc_id", "lang", "text")))
