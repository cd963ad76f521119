"""Spelling of words by logistic mixing of bit predictors over their bytes.

Each bit of a word's bytes and of its closing mark is predicted from counts under several contexts
inside the word (none, the last one to four bytes, and all bytes so far), kept in hashed tables. The
predictions, as log odds, are mixed by weights that a gate selects by how much the longest contexts
have seen; the mix is refined by an adaptive map from (bits of the byte so far, log odds) to what
followed. Every distinct word of the vocabulary counts once, for it is new words that are spelled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqs

U = np.uint64
#: Bits of the tables of contexts: none, 1, 2, 3, 4 bytes, the whole token so far.
SIZES = (8, 16, 17, 18, 18, 18)
OFFSETS = np.append(0, np.cumsum([1 << b for b in SIZES]))
N, GATES, STEPS, PIECE, GATED, RATE = len(SIZES), 64, 33, 1 << 15, (3, 4), 0.03


@dataclass
class Model:
    """While it learns, counts (zeros and ones seen in each slot); after that what they say: log odds and how much was seen."""

    counts: np.ndarray | None  # (2, slots), float32
    odds: np.ndarray | None = None  # (slots,), float16
    level: np.ndarray | None = None  # (slots,), uint8
    weights: np.ndarray | None = None  # (GATES, N + 1)
    refined: np.ndarray | None = None  # (256 * STEPS)


def _bytes_of(words: list[bytes]):
    """Bytes with closing marks, the word of each byte, and for every context its hash base at each byte."""
    data = np.frombuffer(b"".join([w + b" " for w in words]), np.uint8)
    size = np.array([len(w) + 1 for w in words])
    start = np.repeat(np.cumsum(size) - size, size)
    word, at = np.repeat(np.arange(len(words)), size), np.arange(len(data))
    wide = data.astype(U)
    bases, h = [np.zeros(len(data), U)], np.zeros(len(data), U)
    for k in range(1, 5):
        before = np.zeros(len(data), U)
        before[k:] = wide[:-k]
        h = h << U(8) | np.where(at - k >= start, before + U(1), U(0))
        bases.append(h.copy())
    total = np.zeros(len(data) + 1, U)
    up, down = seqs.powers(len(data) + 1)
    np.cumsum((wide + U(1)) * up[: len(data)], out=total[1:])
    bases.append((total[at] - total[start]) * down[start] + (at - start).astype(U))
    return data, word, bases


def _slots(data, bases, bit: int, part: slice):
    """The slot of each table for a bit of each byte."""
    node = (data[part].astype(np.int64) | 256) >> (8 - bit)
    out = [node]
    for k in range(1, N):
        h = seqs.mix((bases[k][part] << U(8) | node.astype(U)) + U(k * 0x9E3779B97F4A7C15 % (1 << 64))) if k > 1 else None
        out.append(((bases[1][part] & U(255)).astype(np.int64) << 8 | node) if k == 1 else (h >> U(64 - SIZES[k])).astype(np.int64))
    return node, [s + int(OFFSETS[k]) for k, s in enumerate(out)]


def _log_odds(zeros, ones):
    return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))


def _level(seen):
    return np.minimum(7, np.log2(seen + 1)).astype(np.uint8)


def _settle(model: Model) -> Model:
    """The model as scoring needs it, in an eighth of the size."""
    slots = model.counts.shape[1]
    model.odds, model.level = np.empty(slots, np.float16), np.empty(slots, np.uint8)
    for a in range(0, slots, 1 << 18):
        part = slice(a, a + (1 << 18))
        zeros, ones = model.counts[:, part]
        model.odds[part], model.level[part] = _log_odds(zeros, ones), _level(zeros + ones)
    model.counts = None
    return model


def _inputs(model, slots, bit=None):
    """Log odds of every context (a last column of ones), and the gate; while learning, as if the bit had been seen once less."""
    x, level = [], {}
    for k, s in enumerate(slots):
        if bit is None:
            x.append(model.odds[s].astype(np.float32))
            if k in GATED:
                level[k] = model.level[s]
        else:
            zeros, ones = np.maximum(model.counts[0][s] - (bit == 0), 0), np.maximum(model.counts[1][s] - (bit == 1), 0)
            x.append(_log_odds(zeros, ones))
            if k in GATED:
                level[k] = _level(zeros + ones)
    x.append(np.full(len(x[0]), 0.3, np.float32))
    return np.stack(x, 1), level[GATED[1]].astype(np.int64) * 8 + level[GATED[0]]


def _place(node, z):
    """Buckets around a log odds, and the share of the upper one."""
    y = (np.clip(z, -8, 7.999) + 8) * 2
    low = y.astype(np.int64)
    return node * STEPS + low, y - low


def _predict(model, node, x, gate):
    z = np.einsum("ij,ij->i", x, model.weights[gate])
    p = 1 / (1 + np.exp(-z))
    at, up = _place(node, z)
    fine = model.refined[at] * (1 - up) + model.refined[at + 1] * up
    return z, np.clip(0.5 * p + 0.5 * fine, 1e-6, 1 - 1e-6)


def costs(model: Model, words: list[bytes]) -> np.ndarray:
    """log10 probability of each word with its closing mark."""
    out = np.zeros(len(words))
    data, word, bases = _bytes_of(words)
    for a in range(0, len(data), PIECE):
        part = slice(a, min(a + PIECE, len(data)))
        total = np.zeros(part.stop - a)
        for bit in range(8):
            node, slots = _slots(data, bases, bit, part)
            x, gate = _inputs(model, slots)
            _, p = _predict(model, node, x, gate)
            b = data[part] >> (7 - bit) & 1
            total += np.log10(np.where(b == 1, p, 1 - p))
        out += np.bincount(word[part], total, len(words))
    return out


def _batches(batch, size=1 << 14):
    """Words and counts of a batch, in runs of about so many bytes."""
    words = [w.encode() for w in batch.column("token").to_pylist()]
    n = batch.column("c").to_numpy()
    lo, held = 0, 0
    for i, w in enumerate(words):
        held += len(w) + 1
        if held >= size:
            yield words[lo : i + 1], n[lo : i + 1]
            lo, held = i + 1, 0
    if lo < len(words):
        yield words[lo:], n[lo:]


BLOCKS = 64


def _tables(vocab: DataFrame) -> np.ndarray:
    """Counts of zeros and ones in every slot, from all tokens."""
    slots = int(OFFSETS[-1])
    width = -(-2 * slots // BLOCKS)

    def count(batches):
        pairs = [np.zeros(2 << b, np.float64) for b in SIZES]
        for batch in batches:
            for words, n in _batches(batch, 1 << 18):
                data, word, bases = _bytes_of(words)
                weight, again = np.ones(len(word)), (n > 1)[word]
                for a in range(0, len(data), PIECE * 4):
                    part = slice(a, min(a + PIECE * 4, len(data)))
                    for bit in range(8):
                        _, at = _slots(data, bases, bit, part)
                        one = (data[part] >> (7 - bit) & 1).astype(np.int64)
                        for k, place in enumerate(at):
                            own = 2 * (place - int(OFFSETS[k])) + one
                            n_own = weight[part]
                            if k == N - 1:  # words seen once would only crowd this table
                                own, n_own = own[again[part]], n_own[again[part]]
                            if k < 3:
                                pairs[k] += np.bincount(own, n_own, len(pairs[k]))
                            else:
                                np.add.at(pairs[k], own, n_own)
        total = np.concatenate([p.reshape(-1, 2) for p in pairs]).T.astype(np.float32)
        flat = np.zeros(width * BLOCKS, np.float32)
        flat[: 2 * slots] = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([x.tobytes() for x in flat.reshape(BLOCKS, width)], pa.binary())], names=["block", "n"])

    def add(key, table):
        total = np.zeros(width, np.float64)
        for x in table.column("n"):
            total += np.frombuffer(x.as_buffer(), np.float32)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["block", "n"])

    part = vocab.mapInArrow(count, "block int, n binary")
    # first within salts, so that no task adds up what all tasks sent
    some = part.withColumn("salt", (F.spark_partition_id() % 8)).groupBy("block", "salt").applyInArrow(add, "block int, n binary")
    rows = some.groupBy("block").applyInArrow(add, "block int, n binary").collect()  # as many numbers as slots
    out = np.zeros(width * BLOCKS, np.float32)
    for r in rows:
        out[r.block * width : (r.block + 1) * width] = np.frombuffer(r.n, np.float32)
    return out[: 2 * slots].reshape(2, slots)


def _fit(vocab: DataFrame, model: Model) -> None:
    """Weights and map, learned online by every task over its tokens, then averaged by how many bits each has seen."""
    spark = vocab.sparkSession
    shared = spark.sparkContext.broadcast(model.counts)

    def learn(batches):
        m = Model(shared.value)
        w = np.full((GATES, N + 1), 0.3, np.float64)
        w[:, -1] = 0
        energy = np.full(w.shape, 1.0)
        seen, ones = np.zeros(256 * STEPS + 1), np.zeros(256 * STEPS + 1)
        used = np.zeros(GATES)
        for batch in batches:
            for words, _ in _batches(batch):
                data, word, bases = _bytes_of(words)
                for a in range(0, len(data), PIECE):
                    part = slice(a, min(a + PIECE, len(data)))
                    for bit in range(8):
                        node, slots = _slots(data, bases, bit, part)
                        b = data[part] >> (7 - bit) & 1
                        x, gate = _inputs(m, slots, b)
                        z = np.einsum("ij,ij->i", x, w[gate])
                        p = 1 / (1 + np.exp(-z))
                        err = b - p
                        for j in range(N + 1):
                            g = np.bincount(gate, err * x[:, j], GATES)
                            energy[:, j] += g * g
                            w[:, j] += RATE * g / np.sqrt(energy[:, j])
                        used += np.bincount(gate, minlength=GATES)
                        at, up = _place(node, z)
                        for s, share in ((at, 1 - up), (at + 1, up)):
                            seen += np.bincount(s, share, len(seen))
                            ones += np.bincount(s, share * b, len(ones))
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (w * used[:, None], used, seen, ones)], names=["w", "used", "seen", "ones"])

    def add(key, table):
        cols = [sum(np.frombuffer(x.as_buffer(), float) for x in table.column(c)) for c in ("w", "used", "seen", "ones")]
        return pa.table([pa.array([x.tobytes()], pa.binary()) for x in cols], names=["w", "used", "seen", "ones"])

    kind = "w binary, used binary, seen binary, ones binary"
    some = vocab.mapInArrow(learn, kind).groupBy((F.spark_partition_id() % 8).alias("salt")).applyInArrow(add, kind).collect()  # 8 rows at most
    shared.unpersist()
    w, used, seen, ones = (sum((np.frombuffer(r[i], float) for r in some), np.zeros(1)) for i in range(4))
    if not np.size(used) or used.sum() == 0:
        model.weights, model.refined = np.zeros((GATES, N + 1), np.float32), np.full(256 * STEPS + 1, 0.5, np.float32)
        return
    w = w.reshape(GATES, N + 1)
    start = np.append(np.full(N, 0.3), 0.0)
    model.weights = ((w + start) / (used[:, None] + 1)).astype(np.float32)
    centre = np.tile(1 / (1 + np.exp(-(np.arange(STEPS) / 2 - 8))), 256)
    model.refined = ((ones + 4 * np.append(centre, 0.5)) / (seen + 4)).astype(np.float32)


def train(vocab: DataFrame) -> Model:
    """The model of the words in vocab (token, c)."""
    model = Model(_tables(vocab))
    _fit(vocab, model)
    return _settle(model)
