import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import documents, texts
from tidewell.llm import repeats, substring_dedup, suffix_dedup

INF = float("inf")


def brute_bytes(rows, length=50):
    rows = [(INF if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in rows:
        for i in range(len(t) - length + 1):
            k = t[i : i + length]
            first[k] = min(first.get(k, INF), d)
    out = []
    for d, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((d, len(t), sum(gone), len(re.findall("1+", "".join("01"[g] for g in gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def brute_words(rows, length=20):
    rows = [(INF if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in rows:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            first[k] = min(first.get(k, (INF, 0)), (d, i))
    out = []
    for d, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (d, i):
                gone[i : i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


LONG = "abc " * 40 + "x " * 300 + "aaaa" * 100
EXTRA = [(700, LONG), (701, "q" + LONG + "tail"), (702, LONG), (703, "é" * 60 + " ü"), (704, "z" + "é" * 60), (705, "only fifty bytes of text make one whole window...."), (706, "only fifty bytes of text make one whole window...."), (707, "only fifty bytes of text make one whole window..., or not")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    df, rows = documents(spark, extra=EXTRA, seed=seed, n=60)
    key = lambda rs: sorted((INF if r[0] is None else r[0], *r[1:]) for r in map(tuple, rs))
    assert key(suffix_dedup.digest(suffix_dedup.deduplicate(df)).collect()) == brute_bytes(rows)
    assert key(substring_dedup.digest(substring_dedup.deduplicate(df)).collect()) == brute_words(rows)


def test_repeated_rows_and_ids(spark):
    t = [x for x in texts(9, 30) if len(x) > 200][:3]
    rows = [(1, t[0]), (1, t[0]), (1, t[1]), (2, t[1]), (3, t[0] + t[2]), (None, t[2]), (None, t[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda rs: sorted((INF if r[0] is None else r[0], *r[1:]) for r in map(tuple, rs))
    assert key(suffix_dedup.digest(suffix_dedup.deduplicate(df)).collect()) == brute_bytes(rows)
    got = substring_dedup.digest(substring_dedup.deduplicate(df)).collect()
    assert len(got) == len(rows)
    for op in (suffix_dedup, substring_dedup):
        assert op.deduplicate(df.limit(0)).count() == 0


@pytest.mark.parametrize("inside", [True, False])
def test_short_passage_with_many_surroundings(spark, inside):
    """A passage shorter than a repeat that very many texts hold, all else random: nothing is removed."""
    rng = random.Random(7)
    letters, n = "abcdefghijklmnopqrstuvwxyz", 20_000
    if inside:
        make = lambda: " ".join("".join(rng.choices(letters, k=5)) for _ in range(14)) + " " + " ".join(f"same{i}" for i in range(12)) + " " + " ".join("".join(rng.choices(letters, k=5)) for _ in range(14))
    else:
        make = lambda: "".join(rng.choices(letters, k=40)) + "thirty bytes that all texts hold" + "".join(rng.choices(letters, k=40))
    df = spark.createDataFrame(((i, make()) for i in range(n)), "doc_id long, text string").repartition(8)
    op = substring_dedup if inside else suffix_dedup
    assert op.digest(op.deduplicate(df)).where("n_removed > 0").count() == 0


def test_texts_are_shuffled_once(spark):
    df, _ = documents(spark)
    out = substring_dedup.deduplicate(df)
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2 or "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("half", ["s", "s2"])
def test_equal_halves_of_segment_hashes(spark, monkeypatch, half):
    """Different surroundings of a gram that agree in all but the lower half of one hash are told apart."""
    anchors = repeats._anchors

    def poor(*args):
        at, g, s, sides = anchors(*args)
        cut = s["s" if half == "s2" else "s2"]
        cut[:] = 0
        s[half] &= np.uint64(0xFFFFFFFF)
        return at, g, s, sides

    monkeypatch.setattr(repeats, "_anchors", poor)
    kind = repeats.Kind(50, 16, False, False, None)
    passage = " a passage of more than fifty bytes that both documents hold, "
    text = ["The first has these words on its left side," + passage + "and these words on its right side, too.", "Another text begins in quite another manner:" + passage + "but it goes on with words of its own here."]
    docs = pa.table({"doc_id": [1, 2], "th": [1, 2], "th2": [1, 2], "text": text})
    cut = repeats._cut(kind, 1)([pa.scalar(0)], docs, docs.slice(0, 0))
    ranges = cut.column("rng").to_pylist()
    met = [row for r in sorted(set(ranges)) for row in repeats._meet(kind)([pa.scalar(r)], cut.filter(pa.array([x == r for x in ranges]))).to_pylist()]
    assert not any(row["pos"] for row in met) and any(row["mask"] for row in met)  # nothing is covered, all is open


def test_more_tasks_and_buckets_for_more_bytes(spark, monkeypatch, tmp_path):
    """Counts from bytes, very long texts, and columns with the names of helpers change nothing."""
    rng = random.Random(5)
    long = " ".join(f"word{rng.randrange(3000)}" for _ in range(60_000))
    df, rows = documents(spark, extra=[*EXTRA, (900, long), (901, "before " + long[: len(long) // 2] + " after")], seed=4, n=40)
    df = df.selectExpr("*", "1 as _null", "2 as _k", "3 as rng", "4 as bucket")
    df.write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(repeats, "BUCKET", 4096)
    key = lambda rs: sorted((INF if r[0] is None else r[0], *r[1:]) for r in map(tuple, rs))
    assert key(suffix_dedup.digest(suffix_dedup.deduplicate(df)).collect()) == brute_bytes(rows)
    assert key(substring_dedup.digest(substring_dedup.deduplicate(df)).collect()) == brute_words(rows)
    out = substring_dedup.cleaned(df)
    assert out.columns == df.columns and {(r._null, r._k) for r in out.collect()} == {(1, 2)}
