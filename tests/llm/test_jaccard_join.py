import random
import re

import pytest

from tests.llm.fixtures import documents, words
from tidewell.llm import jaccard_join
from tidewell.llm.components import components
from tidewell.llm.jaccard_join import near_duplicates


def brute(rows, k=5):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def family(rng, n, base, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("few", [64, 2])
def test_against_brute_force(spark, few):
    """Also with almost all shingles counted as shared by many, so that the second round does the work."""
    rng = random.Random(4)
    extra = [(1000 + i, t) for i, t in enumerate(family(rng, 30, words(rng, 90, 9999), 6) + family(rng, 15, words(rng, 40, 9999), 3) + family(rng, 12, words(rng, 200, 50), 12))]
    extra += [(1100, extra[0][1]), (1100, extra[0][1]), (1101, extra[0][1].upper()), (None, extra[3][1]), (1102, "A b c"), (1103, "a B c")]
    df, rows = documents(spark, extra=extra)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.near_duplicates(df, few=few).drop("th", "label").collect())
    assert got == brute(rows)


def test_empty(spark):
    df, _ = documents(spark)
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0
    assert jaccard_join.near_duplicates(df.where("doc_id in (500, 501)")).count() == 2


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (5, 3)] + [(300, 300 + i) for i in range(1, 40)]
    rng = random.Random(1)
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"))[0].collect()}
    assert all(got[i] == 0 for i in range(61)) and got[200] == got[150] == 100 and all(got[i] == 300 for i in range(300, 340))
    assert components(spark.createDataFrame([], "a long, b long"))[0].count() == 0


def test_hubs_are_dealt_over_tasks(spark):
    edges = [(1, i) for i in range(2, 1800)] + [(i, 5000 + i) for i in range(2, 50)] + [(5002, 9000), (9001, 9000)]
    label, hubs = components(spark.createDataFrame(edges, "a long, b long"))
    assert hubs == [1]
    assert {r.label for r in label.collect()} == {1}


def test_hot_classes_and_families(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, base) for i in range(1500)] + [(2000 + i, base + f" end{i}") for i in range(1200)] + [(4000, "other words than those before here"), (None, base), (4001, None)]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert {c for (d, _), c in got.items() if d is None or d < 4000} == {0}
    assert got[4000, 2] == 4000 and got[4001, 0] == 4001
