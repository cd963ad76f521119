"""Language-model scores by logistic mixing of hashed-context bit predictors.

Texts are tokens (lower-case words, then one end). A token is told in bits: the frequent tokens, the
end and one mark for "any other" have a Huffman code. Each bit is predicted from counts under
several contexts, kept in hashed tables: the code so far alone (which is the dictionary), with the
last frequent word before, with the previous word, and with the two previous words. The
predictions, as log odds, are mixed by weights that a gate selects by how much the contexts have
seen, and the mix is refined by an adaptive map from (place in the code, what the gate saw, log odds)
to what followed. A token behind the mark "any other" is told by its share of the training tokens
behind that mark, mixed with its spelling, which bit predictors over bytes give (spelling.py). All
bits' log probabilities add up to the text's.

Everything is learned from all training texts: token counts first, then the tables, then weights
(online, one step a chunk, each bit seen as if it had occurred once less, so that trust in rare
contexts is learned honestly) and the map. Token counts stay distributed; the frequent tokens are at
most HEAD, taken by a threshold on the count, and the tables grow with the number of training tokens
up to 2 ** 21 slots a context. Partial sums of tables, weights and map are added up in blocks.

Edge cases. Null and empty texts have the end only. Null doc_id counts as the text "" for the fold.
Rows that repeat doc_id and text get the same result each. Words and texts of any length are taken
whole. Without training texts all counts are 0 and every bit of a spelling costs one. Other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqs, spelling
from .common import materialize, session, text_key, tidy
from .toxicity import fold

U = np.uint64
HEAD, FLUSH, CHUNK, BLOCKS, FREQUENT = 1 << 18, 400_000, 1 << 11, 64, 128
LEVELS, DEPTHS, STEPS = 8, 16, 33
GATES, ROWS = LEVELS * LEVELS, DEPTHS * LEVELS
END = b"\t"  # in no word
STOP, OTHER = 0, 1  # symbols before those of frequent tokens
#: Contexts: none, last frequent word, previous word, two previous words.
CONTEXTS = 4


@dataclass
class Model:
    names: np.ndarray  # hashes of the frequent tokens, sorted
    counts: np.ndarray  # of all symbols
    codes: np.ndarray
    lengths: np.ndarray
    frequent: np.ndarray  # whether a symbol is a frequent word
    least: np.ndarray  # whether a symbol would be behind the mark, had it occurred once less
    bits: tuple[int, ...]  # of the contexts' tables
    tables: np.ndarray | None = None  # zeros << 8 | ones of every slot
    weights: np.ndarray | None = None  # (CONTEXTS + 1, GATES)
    refined: np.ndarray | None = None
    rare: tuple[int, float] = (0, 0.0)  # training tokens behind the mark; the share of such tokens, each seen once less, that are no new ones
    spelled: spelling.Model | None = None
    at: np.ndarray = field(init=False)
    longest: int = field(init=False)  # code

    def __post_init__(self):
        self.longest = int(self.lengths.max())
        self.at = np.append(0, np.cumsum([1 << b for b in self.bits]))


def _lut():
    """Log odds and level of every pair of counts."""
    zeros, ones = np.divmod(np.arange(1 << 16), 256)
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32), np.minimum(LEVELS - 1, np.log2(zeros + ones + 1)).astype(np.uint8)


ODDS, LEVEL = _lut()


def _once_less():
    """ODDS and LEVEL of pairs of counts as they are, then with a one, then with a zero less (large counts keep theirs): what _inputs looks up while learning."""
    v = np.arange(1 << 16)
    ones, zeros = v & 255, v >> 8
    v = np.concatenate([v, v - ((ones > 0) & (ones < 128)), v - 256 * ((zeros > 0) & (zeros < 128))])
    return ODDS[v], LEVEL[v]


ODDS_LESS, LEVEL_LESS = _once_less()


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Of a Huffman code, by two queues."""
    n = len(counts)
    order = np.argsort(counts, kind="stable")
    leaf, made, up = counts[order].tolist(), [], [0] * (2 * n - 1)
    i = j = 0
    for node in range(n, 2 * n - 1):
        total = 0
        for _ in range(2):
            if j >= len(made) or (i < n and leaf[i] <= made[j]):
                total, up[i], i = total + leaf[i], node, i + 1
            else:
                total, up[n + j], j = total + made[j], node, j + 1
        made.append(total)
    deep = [0] * (2 * n - 1)
    for node in range(2 * n - 3, -1, -1):
        deep[node] = deep[up[node]] + 1
    out = np.empty(n, np.int64)
    out[order] = deep[:n]
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes of these lengths, short ones first."""
    out, code, last = np.zeros(len(lengths), U), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, a, b in zip(sizes.tolist(), first, np.append(first[1:], len(order)), strict=True):
        code <<= size - last
        out[order[a:b]] = U(code) + np.arange(b - a, dtype=U)
        code, last = code + int(b - a), size
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """token, c: how often each token (the end is a tab) stands in docs."""

    def count(batches):
        table, counts = seqs.LOWER.tobytes(), Counter()

        def told():
            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["token", "c"])
            counts.clear()

        for batch in batches:
            for text in batch.column("text"):
                counts.update((text.as_py() or "").encode().translate(table).split())
                counts[END] += 1
                if len(counts) > FLUSH:
                    yield from told()
        yield from told()

    return docs.select("text").mapInArrow(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _token_hash(data, offs):
    """The hash of whole tokens, the same as Words.hash gives them in a text."""
    up, down = seqs.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=total[1:])
    return seqs.mix((total[offs[1:]] - total[offs[:-1]]) * down[offs[:-1]] + np.diff(offs).astype(U))


def _head(vocab: DataFrame, most: int):
    """Hashes and counts of the most frequent tokens with two occurrences or more, at most so many, by a threshold on the count; and that threshold."""
    level = F.floor(F.log2("c") * 8).cast("int")  # 8 levels a doubling
    words = vocab.where((F.col("token") != END.decode()) & (F.col("c") > 1))
    least, held = None, 0
    for r in sorted(words.groupBy(level.alias("l")).count().collect(), reverse=True):
        if held + r["count"] > most:
            break
        least, held = r["l"], held + r["count"]
    if least is None:
        return np.zeros(0, U), np.zeros(0, np.int64), F.lit(False)

    def name(batches):
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("token")):
                yield pa.RecordBatch.from_arrays([seqs.long(_token_hash(data, offs)), batch.column("c").slice(lo, hi - lo)], names=["h", "c"])

    got = words.where(level >= least).select("token", "c").mapInArrow(name, "h long, c long").toArrow()
    h, c = got.column("h").to_numpy().view(U), got.column("c").to_numpy()
    o = np.argsort(h)
    return h[o], c[o], (F.col("c") > 1) & (level >= least)


class Sequence:
    """The tokens of a block's texts, each text closed by its end: symbols, the text of each, and what each context knows before it."""

    def __init__(self, model: Model, data, offs):
        self.words = w = seqs.Words(data, offs, seqs.LOWER)
        h = w.hash()
        k = np.minimum(np.searchsorted(model.names, h), max(len(model.names) - 1, 0))
        known = model.names[k] == h if len(model.names) else np.zeros(len(h), bool)
        rows = len(offs) - 1
        n = np.diff(w.offs)
        self.text = np.repeat(np.arange(rows), n + 1)
        self.first = np.cumsum(n + 1) - (n + 1)  # of each text
        place = np.arange(len(h)) + np.repeat(np.arange(rows), n)  # of the words
        self.symbol = np.full(len(self.text), STOP, np.int64)
        self.symbol[place] = np.where(known, k + 2, OTHER)
        self.word = np.full(len(self.text), -1)
        self.word[place] = np.arange(len(h))
        own = np.zeros(len(self.text) + 1, np.uint32)  # a short name of each token; the last one is that of none
        own[place] = (h >> U(32)).astype(np.uint32) | np.uint32(1)
        at = np.arange(len(self.text))
        start = self.first[self.text]
        one, two = np.where(at - 1 >= start, at - 1, -1), np.where(at - 2 >= start, at - 2, -1)
        last = np.maximum.accumulate(np.where(model.frequent[self.symbol], at, -1))
        last = np.append(-1, last[:-1])
        last = np.where(last >= start, last, -1)
        both = own[one] * np.uint32(0x9E3779B1) ^ own[two] * np.uint32(0x85EBCA77)
        self.contexts = [None, own[last] * np.uint32(0xC2B2AE3D) + np.uint32(1), own[one] * np.uint32(0x27D4EB2F) + np.uint32(2), both * np.uint32(0x165667B1) + np.uint32(3)]


def _events(model: Model, seq: Sequence, a: int, b: int, symbol=None):
    """Of the tokens a to b: the token, depth, and bit of each bit of their codes, and its slot in each table; without a sequence, in the first one only."""
    symbol = seq.symbol[a:b] if symbol is None else symbol
    size = model.lengths[symbol]
    token = np.repeat(np.arange(b - a, dtype=np.int32), size)
    ends = np.cumsum(size)
    depth = np.arange(len(token), dtype=np.int32)
    depth -= np.repeat((ends - size).astype(np.int32), size)
    kind = np.uint32 if model.longest < 31 else U
    rest = (np.repeat(size.astype(kind), size)) - depth.astype(kind)
    code = np.repeat(model.codes[symbol].astype(kind), size)
    node = kind(1) << depth.astype(kind) | code >> rest
    bit = (code >> (rest - kind(1)) & kind(1)).astype(np.uint8)
    if kind is U:
        node = node ^ node >> U(32)
    node = node.astype(np.uint32) * np.uint32(0x9E3779B1)
    slots = []
    for j, c in enumerate(seq.contexts if seq is not None else [None]):
        if c is None:
            h = node >> np.uint32(32 - model.bits[j])
        else:
            h = np.repeat(c[a:b], size)
            h ^= node
            h *= np.uint32(0x9E3779B1)
            h >>= np.uint32(32 - model.bits[j])
        h = h.astype(np.int64)
        h += int(model.at[j])
        slots.append(h)
    return token, ends, depth, bit, slots


def _inputs(model: Model, slots, bit=None, counted=None):
    """Log odds of every context and the gate; while learning, as if bits that were counted (1, others 0) had been seen once less."""
    x, level = [], []
    odds, levels = (ODDS, LEVEL) if bit is None else (ODDS_LESS, LEVEL_LESS)
    part = None if bit is None else (counted * (np.uint8(2) - bit)).astype(np.int64) << 16
    for j, s in enumerate(slots):
        v = model.tables.take(s).astype(np.int64)
        if bit is not None:
            v += part
        x.append(odds.take(v))
        if j > 1:
            level.append(levels.take(v))
    return x, level[1].astype(np.int64) * LEVELS + level[0], level[0]


def _mixed(weights, x, gate):
    z = weights[len(x)].take(gate)
    z *= np.float32(0.3)
    for w, y in zip(weights, x, strict=False):
        part = w.take(gate)
        part *= y
        z += part
    return np.clip(z, -12, 12, out=z)


def _place(depth, level, z):
    """Buckets around a log odds, and the share of the upper one."""
    y = (np.clip(z, -8, 7.999) + 8) * 2
    low = y.astype(np.int32)
    at = (np.minimum(depth, DEPTHS - 1) * np.uint8(LEVELS) + level).astype(np.int32)
    at *= STEPS
    at += low
    y -= low.astype(np.float32)
    return at.astype(np.int64), y


def _probability(model: Model, slots, depth):
    """Of a one, for each bit."""
    x, gate, level = _inputs(model, slots)
    z = _mixed(model.weights, x, gate)
    at, up = _place(depth, level, z)
    fine = model.refined.take(at) * (1 - up) + model.refined[1:].take(at) * up
    return np.clip(0.5 / (1 + np.exp(-z)) + 0.5 * fine, 1e-6, 1 - 1e-6)


def token_costs(model: Model, seq: Sequence) -> np.ndarray:
    """log10 probability of each token's code after what came before it; the bits' probabilities are multiplied, as far as these stay above the least number, and told in one logarithm a token."""
    out, short = [], model.longest <= 48  # of bits of 1e-6 at least
    for a in range(0, len(seq.symbol), CHUNK):
        b = min(a + CHUNK, len(seq.symbol))
        _, ends, depth, bit, slots = _events(model, seq, a, b)
        p = _probability(model, slots, depth)
        p = np.abs(p - (bit ^ np.uint8(1)))  # 1 - p for a zero
        first = np.append(0, ends[:-1])
        out.append(np.log10(np.multiply.reduceat(p, first, dtype=np.float64)) if short else np.add.reduceat(np.log10(p), first, dtype=np.float64))
    return np.concatenate(out) if out else np.zeros(0)


def _packed(counts: np.ndarray) -> np.ndarray:
    """zeros << 8 | ones of pairs of counts; large ones are scaled down together."""
    most = counts.max(1)
    small = np.round(counts / np.maximum(1, np.ceil(most / 255))[:, None]).astype(np.uint16)
    return small[:, 0] << np.uint16(8) | small[:, 1]


def _tables(docs: DataFrame, model: Model) -> np.ndarray:
    """Counts of zeros and ones in every slot, from all texts; those without a context follow from the symbols' counts."""
    slots = int(model.at[-1])
    width = -(-slots // BLOCKS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        m, n = shared.value, np.zeros(2 * width * BLOCKS, np.uint32)
        for batch in batches:
            for _, _, data, offs in seqs.blocks(batch.column("text")):
                seq = Sequence(m, data, offs)
                for a in range(0, len(seq.symbol), CHUNK):
                    _, _, _, bit, at = _events(m, seq, a, min(a + CHUNK, len(seq.symbol)))
                    for s in at[1:]:
                        s <<= 1
                        s += bit
                        np.add.at(n, s, np.uint32(1))
        # a block a batch, by planes of bytes, which the shuffle's compression makes small
        for i, x in enumerate(n.reshape(BLOCKS, -1)):
            planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([planes], pa.binary())], names=["block", "n"])

    def total(table):
        out = np.zeros(2 * width, np.int64)
        for x in table.column("n"):
            out += np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").ravel()
        return np.minimum(out, (1 << 32) - 1).astype("<u4")

    def add(key, table):
        part = np.ascontiguousarray(total(table).view(np.uint8).reshape(-1, 4).T).tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([part], pa.binary())], names=["block", "n"])

    def settle(key, table):
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([_packed(total(table).reshape(-1, 2)).tobytes()], pa.binary())], names=["block", "n"])

    kind = "block int, n binary"
    # first within salts, so that no task adds up what all tasks sent
    some = docs.select("text").mapInArrow(count, kind).withColumn("salt", F.spark_partition_id() % 8).groupBy("block", "salt").applyInArrow(add, kind)
    out = np.zeros(width * BLOCKS, np.uint16)
    for r in some.groupBy("block").applyInArrow(settle, kind).toLocalIterator():  # two bytes a slot in all
        out[r.block * width : (r.block + 1) * width] = np.frombuffer(r.n, np.uint16)
    shared.unpersist()
    out[: model.at[1]] = _packed(_alone(model))
    return out[:slots]


def _alone(model: Model) -> np.ndarray:
    """Zeros and ones in the slots of the table without a context, from the counts of symbols."""
    size = int(model.at[1])
    n = np.zeros(2 * size, np.int64)
    for a in range(0, len(model.counts), CHUNK):
        symbol = np.arange(a, min(a + CHUNK, len(model.counts)))
        token, _, _, bit, at = _events(model, None, 0, len(symbol), symbol)
        np.add.at(n, 2 * at[0] + bit, model.counts[symbol][token])
    return np.minimum(n, (1 << 32) - 1).reshape(-1, 2)


def _fit(docs: DataFrame, model: Model) -> None:
    """Weights and map, learned online by every task over its texts, then averaged by how many bits each has seen."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = (CONTEXTS + 1, GATES)
    start = np.full(shape, 0.3)
    start[-1] = 0

    def learn(batches):
        m = shared.value
        w, energy, used = start.copy(), np.ones(shape), np.zeros(GATES)
        hits, shares = np.zeros((ROWS * STEPS, 2)), np.zeros((ROWS * STEPS, 2))  # by place and bit: how often, and the sum of the upper places' shares
        for batch in batches:
            for _, _, data, offs in seqs.blocks(batch.column("text")):
                seq = Sequence(m, data, offs)
                for a in range(0, len(seq.symbol), CHUNK):
                    own = seq.symbol[a : a + CHUNK]
                    less = m.least[own]  # with one occurrence less they were behind the mark
                    token, _, depth, bit, slots = _events(m, seq, a, a + len(own), np.where(less, OTHER, own))
                    x, gate, level = _inputs(m, slots, bit, (~less).view(np.uint8)[token])
                    z = _mixed(w.astype(np.float32), x, gate)
                    err = bit - 1 / (1 + np.exp(-z))
                    for j in range(CONTEXTS + 1):
                        g = np.bincount(gate, err * x[j] if j < CONTEXTS else err * np.float32(0.3), GATES)
                        energy[j] += g * g
                        w[j] += 0.1 * g / np.sqrt(energy[j])
                    used += np.bincount(gate, minlength=GATES)
                    at, up = _place(depth, level, z)
                    at *= 2
                    at += bit
                    hits += np.bincount(at, minlength=hits.size).reshape(-1, 2)
                    shares += np.bincount(at, up, hits.size).reshape(-1, 2)
        lower, upper = np.append(hits - shares, [[0, 0]], 0), np.append([[0, 0]], shares, 0)
        ones = (lower + upper)[:, 1]
        seen = (lower + upper).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array([y.tobytes()], pa.binary()) for y in (w * used, used, seen, ones)], names=["w", "used", "seen", "ones"])

    def add(key, table):
        cols = [sum(np.frombuffer(y.as_buffer(), float) for y in table.column(c)) for c in ("w", "used", "seen", "ones")]
        return pa.table([pa.array([y.tobytes()], pa.binary()) for y in cols], names=["w", "used", "seen", "ones"])

    kind = "w binary, used binary, seen binary, ones binary"
    some = docs.select("text").mapInArrow(learn, kind).groupBy((F.spark_partition_id() % 32).alias("salt")).applyInArrow(add, kind).collect()  # 32 rows at most
    shared.unpersist()
    w, used, seen, ones = (sum((np.frombuffer(r[i], float) for r in some), np.zeros(1)) for i in range(4))
    if np.size(used) == 1:
        w, used, seen, ones = np.zeros(shape), np.zeros(GATES), np.zeros(ROWS * STEPS + 1), np.zeros(ROWS * STEPS + 1)
    model.weights = ((w.reshape(shape) + start) / (used + 1)).astype(np.float32)
    centre = np.tile(1 / (1 + np.exp(-(np.arange(STEPS) / 2 - 8))), ROWS)
    model.refined = ((ones + 4 * np.append(centre, 0.5)) / (seen + 4)).astype(np.float32)


def train(docs: DataFrame, usable=None, most: int = HEAD):
    """(model, vocabulary with the spelling's cost of each token behind the mark, N, V) from the documents that usable accepts (by default those whose fold isn't 1)."""
    spark = session(docs.sparkSession)
    docs = docs.where((fold() != 1) if usable is None else usable)
    vocab = materialize(vocabulary(docs), "vocabulary")
    total, distinct = (int(x) for x in vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first())
    names, counts, in_head = _head(vocab, most)
    is_rare = ~in_head & (F.col("token") != END.decode())
    ends, rare, again = (int(x or 0) for x in vocab.agg(F.sum(F.when(F.col("token") == END.decode(), F.col("c"))), F.sum(F.when(is_rare, F.col("c"))), F.sum(F.when(is_rare & (F.col("c") > 1), F.col("c")))).first())
    counts = np.concatenate([[ends, rare], counts])
    lengths = code_lengths(counts)
    frequent = np.zeros(len(counts), bool)
    frequent[2 + np.argsort(-counts[2:], kind="stable")[:FREQUENT]] = True
    wide = int(np.clip(np.ceil(np.log2(max(total, 1))) + 4, 16, 21))
    codes = int(np.clip(np.ceil(np.log2(len(counts))) + 2, 10, 20))  # nodes are fewer than symbols
    least = np.append([False, False], counts[2:] == counts[2:].min(initial=1 << 62))
    held = int(counts[least].sum())
    model = Model(names, counts, canonical(lengths), lengths, frequent, least, (codes, min(wide, codes + 2), wide, wide))
    model.tables = _tables(docs, model)
    tidy(spark)
    _fit(docs, model)
    model.rare = rare, (again + held + 0.5) / (rare + held + 1.0)
    tidy(spark)
    model.spelled = spelling.train(vocab)
    shared = spark.sparkContext.broadcast(model.spelled)

    def spell(batches):
        for batch in batches:
            cost = [spelling.costs(shared.value, words) for words, _ in spelling._batches(batch, 1 << 18)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(cost) if cost else np.zeros(0))], names=[*batch.schema.names, "cost"])

    spelled = vocab.where(is_rare).mapInArrow(spell, "token string, c long, cost double")
    return model, materialize(spelled, "vocabulary"), total, distinct


def score(docs: DataFrame, model: Model, rare: DataFrame, total: int, distinct: int) -> DataFrame:
    """doc_id, th, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte (of the tokens with their marks)."""
    spark = session(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    floor = float(np.log10(total + 0.5 * (distinct + 1)))

    def run(batches):
        m = shared.value
        base_of = np.log10(m.counts + 0.5) - floor
        for batch in batches:
            for lo, hi, data, offs in seqs.blocks(batch.column("text")):
                seq, rows = Sequence(m, data, offs), hi - lo
                w, known = seq.words, seq.symbol != OTHER
                base = np.bincount(seq.text[known], base_of[seq.symbol[known]], rows)
                cost = np.bincount(seq.text, token_costs(m, seq), rows)
                sure = np.bincount(seq.text[known & (seq.symbol != STOP)], minlength=rows) + (m.counts[STOP] > 0)
                size = np.bincount(seq.text, minlength=rows) + np.bincount(seq.text[seq.word >= 0], (w.ends - w.starts)[seq.word[seq.word >= 0]], rows)
                # tokens behind the mark: one row for each text and token
                lack = np.flatnonzero(~known)
                h = w.hash()[seq.word[lack]]
                u, at, inv = np.unique(h, return_index=True, return_inverse=True)
                pair, n = np.unique(seq.text[lack] * max(len(u), 1) + inv, return_counts=True)
                raw, spot = w.bytes.tobytes(), seq.word[lack][at]
                starts, ends = w.starts[spot].tolist(), w.ends[spot].tolist()
                # rows that tell of a text carry a token that is nowhere, so they spread over tasks
                token = [b"\t%d" % (lo + r) for r in range(rows)] + [raw[starts[x] : ends[x]] for x in (pair % max(len(u), 1)).tolist()]
                pad = lambda x, kind: pa.concat_arrays([pa.array(x, kind), pa.nulls(len(pair), kind)])  # noqa: B023, E731
                take = pa.array(np.concatenate([np.arange(rows), pair // max(len(u), 1)]) + lo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("th").take(take), pa.array(token, pa.binary()).cast(pa.string()), pa.array(np.concatenate([np.zeros(rows, np.int64), n])), pad(np.bincount(seq.text, minlength=rows), pa.int64()), pad(sure, pa.int64()), pad(base, pa.float64()), pad(size.astype(np.int64), pa.int64()), pad(cost, pa.float64())], names=["doc_id", "th", "token", "m", "n_tokens", "n_known", "base", "size", "cost"])

    def spell(batches):
        """What tokens behind the mark cost after it; the spelling of those that no training text has."""
        m = shared.value
        known, share = m.rare
        for batch in batches:
            own, n = batch.column("own").to_numpy(zero_copy_only=False).copy(), batch.column("m").to_numpy()
            lack = np.flatnonzero(np.isnan(own) & (n > 0))
            if len(lack):
                u, inv = np.unique(np.array(batch.column("token").take(pa.array(lack)).to_pylist(), object), return_inverse=True)
                words, found = [x.encode() for x in u], []
                a = held = 0
                for i, x in enumerate(words):
                    held += len(x) + 1
                    if held > 1 << 18 or i + 1 == len(words):
                        found.append(spelling.costs(m.spelled, words[a : i + 1]))
                        a, held = i + 1, 0
                own[lack] = np.concatenate(found)[inv]
            c = batch.column("c").fill_null(0).to_numpy(zero_copy_only=False)
            with np.errstate(divide="ignore"):
                tail = np.logaddexp(np.log(share * c / max(known, 1)), np.log1p(-share) + np.log(10) * np.where(n > 0, own, 0.0)) / np.log(10)
            held = [i for i, name in enumerate(batch.schema.names) if name != "own"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in held), pa.array(np.where(n > 0, n * tail, 0.0))], names=[*(batch.schema.names[i] for i in held), "tail"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, th long, token string, m long, n_tokens long, n_known long, base double, size long, cost double"
    told = docs.select("doc_id", text_key().alias("th"), "text").mapInArrow(run, fields)
    joined = told.join(rare.select("token", "c", F.col("cost").alias("own")), "token", "left").select(*told.columns, "c", "own").mapInArrow(spell, f"{fields}, c long, tail double")
    known = F.col("c").isNotNull() & (F.col("m") > 0)
    per = joined.groupBy("doc_id", "th").agg(
        F.count("n_tokens").alias("rows"), *(F.max(c).alias(c) for c in ("n_tokens", "n_known", "base", "size", "cost")),
        F.sum(F.when(known, F.col("m")).otherwise(0)).alias("more"),
        F.sum(F.when(F.col("m") > 0, F.col("m") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - floor)).otherwise(0.0)).alias("rest"),
        F.sum("tail").alias("tail"),
    )
    per = per.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))  # rows that repeat doc_id and text
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 1
    each = lambda c: F.col(c) / F.col("rows")
    out = per.select("doc_id", "th", held.alias("held_out"), "n_tokens", (F.col("n_known") + each("more")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + each("rest")).alias("base_score"), (F.col("cost") + each("tail")).alias("score"), "size")
    return out.withColumn("bits_per_byte", -F.col("score") / float(np.log10(2)) / F.col("size")).drop("size")
