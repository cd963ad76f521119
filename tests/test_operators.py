import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import graph, skew, store
from tidewell.operators.kept import kept, numbered
from tidewell.plans import identity, reports


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, v string, s int")
    new = spark.createDataFrame([(2, "x", 5), (2, "y", 6), (3, "z", 5), (None, "m", 7)], "k int, v string, s int")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    up = store.upsert(old, new, ["k"], [F.desc("s")])
    assert key(up) == [(1, "a", 1), (2, "y", 6), (3, "z", 5), (None, "m", 7)]
    assert key(store.upsert(up, new, ["k"], [F.desc("s")])) == key(up)
    first = store.insert_absent(old, new, ["k"], [F.asc("s")])
    assert key(first) == [(1, "a", 1), (2, "b", 1), (3, "z", 5), (None, "n", 1)]
    assert key(store.insert_absent(first, new, ["k"], [F.asc("s")])) == key(first)
    assert key(store.not_done(new, old, ["k"])) == [(3, "z", 5)]
    assert key(store.replace_children(old, new.limit(0), spark.createDataFrame([(1,)], "k int"), ["k"])) == [(2, "b", 1), (None, "n", 1)]
    assert store.add_missing_columns(old, {"v": "string", "w": "int"}).columns == ["k", "v", "s", "w"]


def test_components_partition_all_nodes(spark):
    nodes = spark.createDataFrame([(c,) for c in "abcdefgh"], "node string")
    edges = spark.createDataFrame([("a", "b"), ("c", "b"), ("c", "a"), ("e", "d"), ("f", "f")], "a string, b string")
    got = {r.node: r.component for r in graph.components(nodes, edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f", "g": "g", "h": "h"}


def test_components_that_still_change_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    with pytest.raises(RuntimeError):
        graph.components(None, edges, rounds=1)


def test_coauthors_skip_crowded_works_and_authors_without_id(spark):
    rows = [("w1", "b", "B"), ("w1", "a", "A"), ("w1", "a", "A2"), ("w1", None, "N"), ("w2", "a", "A0"), ("w2", "b", "B")] + [("w3", f"x{i:03}", "X") for i in range(101)]
    got = graph.coauthor_edges(spark.createDataFrame(rows, "work_id string, author_id string, author_name string")).collect()
    assert [tuple(r) for r in got] == [("a", "b", "A", "B", 2, "w1; w2")]


def test_markdown(spark):
    assert reports.markdown(spark.createDataFrame([("a|b", None)], "x string, y string")) == "| x | y |\n|---|---|\n| a\\|b |  |"


def test_report_helpers(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 3) for i in range(50)], "k int, v int")
    assert [tuple(r) for r in reports.breakdown(rows, "v").collect()] == [(0, 17), (1, 17), (2, 16)]
    picked = sorted(r.k for r in reports.sample_rows(rows, "k", 5).collect())
    assert len(picked) == 5 and picked == sorted(r.k for r in reports.sample_rows(rows.repartition(7), "k", 5).collect())
    assert [r.k for r in reports.top_rows(rows, [F.desc("v"), F.asc("k")], 2).collect()] == [2, 5]
    rows.createOrReplaceTempView("some_rows")
    counts = {r.table_name: r for r in reports.table_counts(spark, ["some_rows", "no_rows"]).collect()}
    assert counts["some_rows"].row_count == 50 and counts["no_rows"].error
    reports.export_csv(rows.limit(2), str(tmp_path / "x"))
    assert len(next((tmp_path / "x").glob("part-*.csv")).read_text().splitlines()) == 3


@pytest.mark.parametrize("least", [skew.LEAST, 20])
def test_components_with_hubs_and_chains(spark, monkeypatch, least):
    """A hub, a long chain, random edges and loops against union-find; with a small bound hubs are dealt over tasks."""
    monkeypatch.setattr(skew, "LEAST", least)
    monkeypatch.setattr(skew, "MOST", 10)
    rng = random.Random(6)
    pairs = [(0, i) for i in range(100, 300)] + [(i, i + 1) for i in range(1000, 1060)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)] + [(5000, 5000)]
    parent = {n: n for p in pairs for n in p}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    edges = spark.createDataFrame(pairs, "a long, b long")
    assert {r.node: r.component for r in graph.components(None, edges).collect()} == {n: root(n) for n in parent}


def test_a_name_that_half_of_all_people_have(spark, monkeypatch):
    """Its block is told as dropped; the others' pairs are those without it."""
    monkeypatch.setattr(skew, "LEAST", 50)
    monkeypatch.setattr(skew, "MOST", 10)
    rows = [(f"A{i:03}", "Same Name" if i % 2 else f"Own{i % 40} Name{i % 40}", None, 1, 1, None, None, None) for i in range(160)]
    people = kept(identity.with_keys(spark.createDataFrame(rows, "author_id string, author_name string, orcid string, works long, citations long, main_ror string, main_institution_name string, top_topics string")))
    hot = skew.hot_keys(people, "name_key")
    assert [r.name_key for r in hot.collect()] == ["same name"]
    got = {(r.a, r.b) for r in identity._block(people, *identity.BASES[0]).collect()}
    own = [r for r in rows if r[1] != "Same Name"]
    assert got == {(x[0], y[0]) for x in own for y in own if x[0] < y[0] and x[1] == y[1]}
    assert ("same_normalised_name", "same name", 80) in {tuple(r) for r in identity.dropped_blocks(people).collect()}


def test_coauthor_samples_are_limited_before_the_shuffle(spark):
    rows = [(f"w{i:03}", a, a) for i in range(70) for a in "ab"]
    edges = graph.coauthor_edges(spark.createDataFrame(rows, "work_id string, author_id string, author_name string"))
    assert "WindowGroupLimit" in edges._jdf.queryExecution().executedPlan().toString()
    got = edges.first()
    assert got.shared_work_count == 70 and got.sample_work_ids == "; ".join(f"w{i:03}" for i in range(50))


def test_numbers_run_through_all_ranges(spark):
    keys = spark.createDataFrame([(i * 7 % 501,) for i in range(501)], "k int").repartition(9)
    assert sorted((r._n, r.k) for r in numbered(keys, "k").collect()) == [(i + 1, i) for i in range(501)]
    assert numbered(keys.limit(0), "k").count() == 0


def test_breakdowns_of_a_layer_in_one_shuffle(spark):
    rows = spark.createDataFrame([("x", 1), ("x", None), (None, 1), (None, 1)], "a string, b int")
    found = reports.breakdowns(rows, {"all": (), "a": ("a",), "b": ("b",), "both": ("a", "b")}, F.count("*").alias("n"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Expand") == 1
    got = sorted(((r.breakdown, r.a, r.b, r.n) for r in found.collect()), key=str)
    assert got == sorted([("all", None, None, 4), ("a", "x", None, 2), ("a", None, None, 2), ("b", None, 1, 3), ("b", None, None, 1), ("both", "x", 1, 1), ("both", "x", None, 1), ("both", None, 1, 2)], key=str)
