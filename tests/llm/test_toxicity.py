import random
import zlib

from tidewell.llm import toxicity


def make(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        s = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 9))] for _ in range(rng.randrange(1, 12))]
        toxic = rng.random() < 0.3
        if toxic:
            rng.choice(s).append(rng.choice(["vile", "awful", "nasty"]))
        rows.append((i, ". ".join(" ".join(x) for x in s)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_located_sentences(spark):
    rows, labels = make()
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, lab)).collect()
    truth, text = dict(labels), dict(rows)
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out) and len(out) == len(rows)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    for r in out:
        for s in r.offending:
            assert any(x in text[r.doc_id].encode()[s.start : s.end].decode() for x in ("vile", "awful", "nasty"))
            assert text[r.doc_id].split(". ")[s.sentence] == text[r.doc_id].encode()[s.start : s.end].decode()


def test_awkward_rows(spark):
    rows, labels = make(60)
    extra = [(None, "vile"), (900, None), (901, ""), (902, " ..!\n"), (903, "x" * 300_000), (1, rows[1][1])]
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in rows + extra], "doc_id long, text string, held_out string, score int")
    lab = spark.createDataFrame([*labels, (1, None), (2, 7), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, lab)).collect()
    assert len(out) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 for r in out)
    assert all(r.score == 0 and not r.predicted for r in out if r.doc_id in (900, 901, 902))
    assert toxicity.score(docs.limit(0), toxicity.train(docs, lab.limit(0))).count() == 0
