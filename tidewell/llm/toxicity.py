"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score from its words; a document is
toxic if any sentence is, so its score is the noisy-or 1 - prod(1 - p). Only document labels are
known; the gradient of the bag's likelihood trains the sentence weights, which then point at the
offending sentences. Words are chosen by the log-likelihood ratio of their document counts, with a
threshold that chance rarely passes, and known by their 64-bit hash, so nothing is guessed for
words that were never seen.

Bounds. The model is fitted on at most max_train labelled documents, those with the smallest hash
of doc_id, and at most max_features words; scoring covers every whole text.

Edge cases. Null and empty texts, and texts without words, have no sentence: score 0, predicted 0.
Null doc_id counts as the text "" for the fold. Repeated rows are scored each. Of repeated labels
the toxic one counts. If no label of a kind is there, every score is 0. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqs
from .common import nullable, session

MAX_TRAIN, MAX_FEATURES, LEAST_G2 = 20_000, 4096, 16.0
_ENDS = np.zeros(256, bool)
_ENDS[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass
class Model:
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, seqs.U))  # sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -50.0

    def bitmap(self) -> np.ndarray:
        out = np.zeros(1 << 20, bool)
        out[self.hashes >> seqs.U(44)] = True
        return out

    def find(self, words: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words, and which they are."""
        at = np.flatnonzero(bitmap[words >> seqs.U(44)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.hashes, words[at]), len(self.hashes) - 1)
        good = self.hashes[k] == words[at]
        return at[good], k[good]


def _sentences(data, offs):
    """Words of a block, the sentence of each word (numbered through the block), the first sentence of each text."""
    w = seqs.Words(data, offs, seqs.LETTERS)
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    part = np.cumsum(_ENDS[data] | first[: len(data)])[w.starts] if len(data) else np.zeros(0, np.int64)
    new = np.ones(len(part), bool)
    new[1:] = part[1:] != part[:-1]
    number = np.cumsum(new) - 1
    return w, number, np.searchsorted(np.flatnonzero(new), w.offs)


def fold(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(5))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable=None, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Model:
    """Fit on the labelled rows that usable accepts (by default those whose fold isn't 0)."""
    spark = session(docs.sparkSession)
    usable = (fold() != 0) if usable is None else usable
    chosen = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max(label).alias("_toxic"))
    sample = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # bounded, so it may be broadcast
    bags = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def count(batches):
        for batch in batches:
            toxic = batch.column("_toxic").to_numpy()
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                w = seqs.Words(data, offs, seqs.LETTERS)
                pairs = np.unique(np.rec.fromarrays([w.hash(), seqs.spread(np.arange(lo, hi), w.offs)], names="h,d"))
                h, at = np.unique(pairs.h, return_index=True)
                n = np.diff(np.append(at, len(pairs)))
                pos = np.add.reduceat(toxic[pairs.d], at) if len(at) else n
                yield pa.RecordBatch.from_arrays([seqs.long(h), pa.array(pos.astype(np.int64)), pa.array(n.astype(np.int64))], names=["h", "pos", "n"])

    n_pos, n_all = (int(x or 0) for x in bags.agg(F.sum("_toxic"), F.count("*")).first())
    if not 0 < n_pos < n_all:
        return Model()
    words = bags.select("text", "_toxic").mapInArrow(count, "h long, pos long, n long").groupBy("h").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    cells = [("pos", F.col("n") * (n_pos / n_all)), (F.col("n") - F.col("pos"), F.col("n") * (1 - n_pos / n_all)), (n_pos - F.col("pos"), (n_all - F.col("n")) * (n_pos / n_all)), (n_all - n_pos - F.col("n") + F.col("pos"), (n_all - F.col("n")) * (1 - n_pos / n_all))]
    g2 = sum((2 * F.when((F.col(a) if isinstance(a, str) else a) > 0, (F.col(a) if isinstance(a, str) else a) * F.log((F.col(a) if isinstance(a, str) else a) / e)).otherwise(0.0) for a, e in cells), F.lit(0.0))
    best = words.withColumn("g2", g2).where(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "h").limit(max_features).select("h").toPandas()
    model = Model(np.sort(best["h"].to_numpy(np.int64).view(seqs.U)))
    if not len(model.hashes):
        return model

    def gather(batches):
        bitmap = model.bitmap()
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                w, number, starts = _sentences(data, offs)
                at, k = model.find(w.hash(), bitmap)
                ends = pa.array(np.searchsorted(at, w.offs).astype(np.int32))
                rows = pa.array(np.arange(lo, hi))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("_toxic").take(rows).cast(pa.int32()), pa.array(np.diff(starts).astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(number[at].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(k.astype(np.int32)))], names=["doc_id", "toxic", "n", "s", "f"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = bags.select("doc_id", "_toxic", "text").mapInArrow(gather, f"doc_id {kind}, toxic int, n int, s array<int>, f array<int>").toPandas().sort_values("doc_id", kind="stable")
    model.weights, model.bias = _fit(got["toxic"].to_numpy(float), got["n"].to_numpy(float), got["s"].to_list(), got["f"].to_list(), len(model.hashes))
    return model


def _fit(toxic, n, sentences, features, size, steps=1500, rate=0.1, decay=1e-4):
    """Weights and bias that maximise the bags' noisy-or likelihood, by Adam over all bags."""
    feature = np.concatenate([np.asarray(x, np.int64) for x in features])
    doc = np.repeat(np.arange(len(n)), [len(x) for x in features])
    raw = np.concatenate([np.asarray(x, np.int64) for x in sentences])
    _, sent = np.unique(doc << 32 | raw, return_inverse=True)
    m = int(sent.max()) + 1 if len(sent) else 0
    owner = np.zeros(m, np.int64)
    owner[sent] = doc
    plain = np.maximum(n - np.bincount(owner, minlength=len(n)), 0)
    w, b = np.zeros(size), -4.0
    mean, var = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(sent, w[feature], m)
        clean = -(plain * np.logaddexp(0, b) + np.bincount(owner, np.logaddexp(0, z), len(n)))  # log of prod(1 - p)
        clean = np.minimum(clean, -1e-9)
        # derivative of the log likelihood by the log of prod(1 - p)
        g = np.where(toxic > 0, -np.exp(clean) / -np.expm1(clean), 1.0)
        p, p0 = np.exp(-np.logaddexp(0, -z)), np.exp(-np.logaddexp(0, -b))
        gz = g[owner] * -p
        grad = np.append(np.bincount(feature, gz[sent], size), gz.sum() + (g * plain).sum() * -p0) / len(n)
        grad[:-1] -= decay * w / 10 / max(1, len(n) / 400)
        mean, var = 0.9 * mean + 0.1 * grad, 0.999 * var + 0.001 * grad * grad
        move = rate * mean / (1 - 0.9**t) / (np.sqrt(var / (1 - 0.999**t)) + 1e-8)
        w, b = w + move[:-1], b + move[-1]
    return w, float(b)


def score(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, and the offending sentences: number in the text, first and last byte in UTF-8, own score; carry: also row, all columns of docs."""
    spark = session(docs.sparkSession)
    shared, rows = spark.sparkContext.broadcast(model), ["row"] * carry

    def run(batches):
        m = shared.value
        bitmap = m.bitmap()
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                w, number, starts = _sentences(data, offs)
                at, k = m.find(w.hash(), bitmap)
                sent, own = np.unique(number[at], return_inverse=True)
                z = m.bias + np.bincount(own, m.weights[k], len(sent)) if len(at) else np.zeros(0)
                doc = np.searchsorted(starts, sent, "right") - 1
                n = np.diff(starts)
                clean = -(n - np.bincount(doc, minlength=len(n))) * np.logaddexp(0, m.bias)
                clean -= np.bincount(doc, np.logaddexp(0, z), len(n))
                p = np.exp(-np.logaddexp(0, -z))
                bad = p >= 0.5
                first = np.searchsorted(number, sent[bad])
                last = np.searchsorted(number, sent[bad], "right") - 1
                d = doc[bad]
                spans = pa.StructArray.from_arrays([pa.array((sent[bad] - starts[d]).astype(np.int32)), pa.array((w.starts[first] - offs[d]).astype(np.int64)), pa.array((w.ends[last] - offs[d]).astype(np.int64)), pa.array(p[bad])], names=["sentence", "start", "end", "score"])
                ends = pa.array(np.searchsorted(d, np.arange(len(n) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "held_out")), *(nullable(batch.column(c)).slice(lo, hi - lo) for c in rows), pa.array(-np.expm1(clean)), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(ends, spans)], names=["doc_id", "held_out", *rows, "score", "n_sentences", "offending"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", (fold() == 0).alias("held_out"), "text", *([F.struct("*").alias("row")] if carry else []))
    of_rows = "".join(f"{r} {given.schema[r].dataType.simpleString()}, " for r in rows)
    out = given.mapInArrow(run, f"doc_id {kind}, held_out boolean, {of_rows}score double, n_sentences long, offending array<struct<sentence:int,start:long,end:long,score:double>>")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending", *rows)
