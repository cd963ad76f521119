"""Small documents with the awkward cases: null, empty, very long, repeated rows, ties, extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, th string, items string, pos int"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def texts(seed=1, n=40):
    """Random texts that share passages, near copies and exact copies."""
    rng = random.Random(seed)
    passage = [words(rng, rng.choice([14, 25, 40, 70])) for _ in range(6)]
    out = []
    for i in range(n):
        w = words(rng, rng.choice([0, 3, 8, 30, 120]), 5000)
        for p in passage:
            if rng.random() < 0.25:
                at = rng.randrange(len(w) + 1)
                a = rng.randrange(4)
                w[at:at] = p[a : len(p) - rng.randrange(4)]
        if out and i % 7 == 3:
            w = rng.choice(out).split()
            for k in range(i % 3 if w else 0):
                w[rng.randrange(len(w))] = f"edit{i}{k}"
        out.append(rng.choice([" ", " ", "\n", ", "]).join(w))
    return out


def documents(spark, extra=(), seed=1, n=40):
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts(seed, n))]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "Über Straße, ABC-def é1 x"), (504, "a b c d e"), (505, "a b c d e"), (None, "no id here at all but words"), *extra]
    return spark.createDataFrame([(d, t, None, None, None, "x", None, 3) for d, t in rows], DOCS), rows
