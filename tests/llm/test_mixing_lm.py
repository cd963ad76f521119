import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, words
from tidewell.llm import mixing_lm, spelling


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("most", [1 << 18, 30, 0])
def test_base_against_brute_force(spark, most):
    df, rows = documents(spark, extra=[(800, "x" * 200_000), (801, "a b c d e a b"), (801, "a b c d e a b")])
    out = mixing_lm.score(df, *mixing_lm.train(df, most=most)).collect()
    fold = lambda d: zlib.crc32(str(d if d is not None else "").encode()) % 5
    c = Counter()
    for d, t in rows:
        if fold(d) != 1:
            c.update(tokens(t))
            c["\t"] += 1
    n, v = sum(c.values()), len(c)
    want = []
    for d, t in rows:
        w = [*tokens(t), "\t"]
        want.append((str(d), fold(d) == 1, len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == sorted(want)
    assert all(r.score < 0 and r.bits_per_byte > 0 for r in out)


def block(model, *texts):
    raw = [t.encode() for t in texts]
    offs = np.append(0, np.cumsum([len(t) for t in raw]))
    return mixing_lm.Sequence(model, np.frombuffer(b"".join(raw), np.uint8), offs)


def test_codes():
    rng = np.random.default_rng(3)
    for counts in ([0, 0], [5, 0, 1], rng.zipf(1.5, 500), np.ones(37, np.int64)):
        lengths = mixing_lm.code_lengths(np.asarray(counts))
        assert (0.5 ** lengths.astype(float)).sum() == 1
        own = sorted(format(c, f"0{n}b") for c, n in zip(mixing_lm.canonical(lengths).tolist(), lengths.tolist(), strict=True))
        assert not any(y.startswith(x) for x, y in zip(own, own[1:]))
        least = sorted(np.asarray(counts).tolist())  # of all codes the cheapest
        cost = 0
        while len(least) > 1:
            x = least.pop(0) + least.pop(0)
            cost, least = cost + x, sorted([*least, x])
        assert (np.asarray(counts) * lengths).sum() == cost


def test_probabilities_add_up_and_learn(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, 50, 60))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model, vocab, n, v = mixing_lm.train(df)
    # after any words, all tokens that can follow have a probability of 1 together
    known = sorted({x for _, t in rows for x in t.split()})
    for before in ("", "w3 ", "w3 new w5 "):
        last = [mixing_lm.token_costs(model, block(model, before + x))[-2] for x in [*known, "nowhere"]]
        end = mixing_lm.token_costs(model, block(model, before))[-1]
        assert sum(10 ** np.array([*last, end])) == pytest.approx(1, abs=1e-4)
    # all one-byte continuations of a token prefix: with a mark each, they can't weigh more than the prefix
    one = 10 ** spelling.costs(model.spelled, [bytes([b]) for b in range(256) if b != 32])
    assert one.sum() <= 1 + 1e-6
    out = mixing_lm.score(df, model, vocab, n, v).collect()
    held = [r for r in out if r.held_out]
    # words drawn independently: nothing beats the base here, and contexts that say nothing cost little
    assert np.mean([r.score for r in held]) > 1.02 * np.mean([r.base_score for r in held])
    long = [b"abc" * 40_000]
    assert spelling.costs(model.spelled, long)[0] == pytest.approx(spelling.costs(model.spelled, long + [b"x"])[0])


def test_contexts_cross_tokens(spark):
    rng = random.Random(6)
    follow = {f"w{i}": [f"w{(7 * i + j) % 80}" for j in range(3)] for i in range(80)}
    rows = []
    for i in range(300):
        w = [f"w{rng.randrange(80)}"]
        while len(w) < 60:
            w.append(rng.choice(follow[w[-1]]))
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    learned = mixing_lm.train(df)
    out = [r for r in mixing_lm.score(df, *learned).collect() if r.held_out]
    assert np.mean([r.score for r in out]) > 0.5 * np.mean([r.base_score for r in out])  # 3 of 80 words can follow
    held = [t for d, t in rows if zlib.crc32(str(d).encode()) % 5 == 1]
    mixed = [" ".join(rng.sample(t.split(), 60)) for t in held]
    cost = lambda texts: sum(mixing_lm.token_costs(learned[0], block(learned[0], *texts)))
    assert cost(held) > 0.7 * cost(mixed)  # the order of words counts


def test_chunks_and_blocks_do_not_matter(spark, monkeypatch):
    df, rows = documents(spark)
    learned = mixing_lm.train(df)
    get = lambda: sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in mixing_lm.score(df, *learned).collect())
    texts = [t or "" for _, t in rows]
    whole = np.bincount(block(learned[0], *texts).text, mixing_lm.token_costs(learned[0], block(learned[0], *texts)))
    each = [mixing_lm.token_costs(learned[0], block(learned[0], t)).sum() for t in texts]
    assert whole == pytest.approx(np.array(each), abs=1e-6)
    monkeypatch.setattr(mixing_lm, "CHUNK", 7)
    assert np.bincount(block(learned[0], *texts).text, mixing_lm.token_costs(learned[0], block(learned[0], *texts))) == pytest.approx(whole, abs=1e-6)
    assert get() == get()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables are not here")
def test_held_out_texts_beat_the_base(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = [r for r in mixing_lm.score(df, *mixing_lm.train(df)).collect() if r.held_out]
    assert np.mean([r.score for r in out]) > np.mean([r.base_score for r in out])
    model = mixing_lm.train(df)[0]
    held = [r.text for r in df.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 1]
    full = sum(mixing_lm.token_costs(model, block(model, t)).sum() for t in held)
    zero = model.at[1]
    model.tables = model.tables.copy()
    model.tables[zero:] = 0  # without the contexts
    assert full > sum(mixing_lm.token_costs(model, block(model, t)).sum() for t in held)


def test_nothing_to_learn_from(spark):
    df, _ = documents(spark)
    empty = df.limit(0)
    assert mixing_lm.score(empty, *mixing_lm.train(empty)).count() == 0
    out = mixing_lm.score(df, *mixing_lm.train(empty)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in out)


def test_repeated_rows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(40), 90)) + " new" + "x" * (i % 3) + str(i)) for i in range(60)]
    df = spark.createDataFrame([*rows, rows[7]], "doc_id long, text string")
    out = [tuple(r) for r in mixing_lm.score(df, *mixing_lm.train(df)).collect()]
    assert len(out) == 61 and len(set(out)) == 60


def test_table_without_context_follows_from_the_counts(spark):
    texts = ["a b a c", "b a zz", "", "c c a b yy"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = mixing_lm.train(df, usable=F.lit(True))[0]
    seq = block(model, *texts)
    _, _, _, bit, at = mixing_lm._events(model, seq, 0, len(seq.symbol))
    n = np.zeros(2 * int(model.at[1]), np.int64)
    np.add.at(n, 2 * at[0] + bit, 1)
    assert n.sum() and (mixing_lm._alone(model) == n.reshape(-1, 2)).all() and (model.tables[: model.at[1]] == mixing_lm._packed(n.reshape(-1, 2))).all()


def test_inputs_and_costs_match_one_bit_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)
    counts = np.array([9, 4, *rng.integers(2, 50, 40)])
    lengths = mixing_lm.code_lengths(counts)
    model = mixing_lm.Model(np.arange(40).astype(np.uint64), counts, mixing_lm.canonical(lengths), lengths, counts > 30, counts < 3, (8, 8, 8, 8))
    model.tables = rng.integers(0, 1 << 16, int(model.at[-1])).astype(np.uint16)
    slots, bit, counted = rng.integers(0, 1 << 10, (4, 500)), rng.integers(0, 2, 500).astype(np.uint8), rng.integers(0, 2, 500).astype(np.uint8)
    x, gate, level = mixing_lm._inputs(model, slots, bit, counted)
    for i in range(500):
        seen = []
        for s in slots[:, i]:
            zeros, ones = divmod(int(model.tables[s]), 256)
            ones -= bool(counted[i] and bit[i] and 0 < ones < 128)
            zeros -= bool(counted[i] and not bit[i] and 0 < zeros < 128)
            seen.append(zeros << 8 | ones)
        assert [y[i] for y in x] == [mixing_lm.ODDS[v] for v in seen]
        assert level[i] == mixing_lm.LEVEL[seen[2]] and gate[i] == int(mixing_lm.LEVEL[seen[3]]) * mixing_lm.LEVELS + level[i]
    depth, z = rng.integers(0, 40, 500), rng.normal(0, 6, 500).astype(np.float32)
    at, up = mixing_lm._place(depth.astype(np.int32), level, z.copy())
    y = (np.clip(z, -8, 7.999) + 8) * 2
    assert (at == (np.minimum(depth, mixing_lm.DEPTHS - 1) * mixing_lm.LEVELS + level) * mixing_lm.STEPS + np.floor(y)).all()
    assert up == pytest.approx(y - np.floor(y), abs=1e-5)
    seq = block(model, "a b c", "", "d")
    monkeypatch.setattr(mixing_lm, "_probability", lambda m, s, d: np.full(len(d), 0.25, np.float32))
    _, ends, _, bits, _ = mixing_lm._events(model, seq, 0, len(seq.symbol))
    want = np.add.reduceat(np.log10(np.where(bits, 0.25, 0.75)), np.append(0, ends[:-1]))
    assert mixing_lm.token_costs(model, seq) == pytest.approx(want)
