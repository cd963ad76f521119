import random
import re
from itertools import permutations

import pytest

from tidewell.llm import filter_audit

DOCS = "doc_id long, text string, source string, Mask int, digest string, good int, salt int"


def brute(rows, labels):
    """Counts by part, order and step, document by document."""
    failing = []
    for d, text, source in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in rows),
        }
        own = [(q, x) for e, q, x in labels if e is not None and e == d]
        failing.append((source or "", fails, any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    out = {}
    for part in {p for p, *_ in failing}:
        mine = [f for f in failing if f[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if f[1][letter]]
                left = [f for f in left if not f[1][letter]]
                removed_by[letter] += len(gone)
                only = sum(f[1][letter] and sum(f[1].values()) == 1 for f in mine)
                out[part, order, step] = [len(left), len(gone), sum(f[1][letter] for f in mine) - len(gone), only, sum(f[2] for f in gone), sum(f[3] for f in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(removed_by[order[step - 1]])
    return out


def sample():
    rng = random.Random(3)
    texts = [None, "", "ABC", "a # b", "x " * 60, " ".join(f"w{i}" for i in range(60)), " ".join(f"W{i}" for i in range(70)), "\u00e9\u00c9 " * 30, "a\u00a0b \x0b c\x1cd", "tail| " + " ".join(f"w{i}" for i in range(80))]
    rows = [(rng.choice([*range(60), None]), rng.choice(texts), rng.choice(["s", "t", None, ""])) for _ in range(80)]
    return [*rows, rows[0], rows[0], (7, texts[5], "s"), (9, texts[5], "t")]


def run(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, s, 9, "x", 1, 2) for d, t, s in rows], DOCS)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): [r[c] for c in filter_audit.COUNTS] for r in filter_audit.audit(docs, told).collect()}


def test_equals_document_by_document(spark):
    rows = sample()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(1, 0, 1), (2, None, 1), (None, 1, 1)]
    got = run(spark, rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})
    assert got == brute(rows, labels)


def test_more_parts_than_a_task_keeps(spark, monkeypatch):
    rows = [(i, "a b" if i % 3 else "A | b", f"p{i % 11}") for i in range(60)]
    want = brute(rows, [(3, 1, 1)])
    monkeypatch.setattr(filter_audit, "PARTS", 2)
    assert run(spark, rows, [(3, 1, 1)]) == want


def test_empty_table(spark):
    assert run(spark, [], []) == {}


def test_long_texts_are_counted_by_slices(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(1000)).encode()
    whole = filter_audit.mask_of(text)
    monkeypatch.setattr(filter_audit, "SLICE", 37)
    assert filter_audit.mask_of(text) == whole == 0
    assert [w for s in filter_audit._words(text) for w in s] == text.split()


@pytest.mark.parametrize(("text", "mask"), [(b"", 1), (b"w " * 50, 2), (b" ".join(b"v%d" % i for i in range(50)), 0), (b"A" * 5 + b"b" * 95, 1), (b"A" * 6 + b"b" * 94, 5), (b"*", 9)])
def test_borders_of_the_conditions(text, mask):
    assert filter_audit.mask_of(text) == mask
