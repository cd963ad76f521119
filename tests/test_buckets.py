import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators import store
from tidewell.operators.buckets import Buckets

ROWS = "k string, n int, v int"


def files(path):
    """Data files of each bucket, with their times."""
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(f"{path}/rows") for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i % 40}", i, i) for i in range(40)] + [(None, 100, 1)], ROWS)
    return Buckets.create(df, str(tmp_path / "t"), ["k"], 16), df


def test_merges_equal_those_of_whole_tables(spark, table):
    t, df = table
    new = spark.createDataFrame([("k1", 1, 7), ("k1", 2, 8), ("new", 3, 9), (None, 4, 4)], ROWS)
    t.upsert(new, [F.desc("n")])
    want = store.upsert(df, new, ["k"], [F.desc("n")])
    assert rows(t.rows(spark)) == rows(want)
    t.upsert(new, [F.desc("n")])
    assert rows(t.rows(spark)) == rows(want)
    more = spark.createDataFrame([("k2", 1, 7), ("newer", 1, 1), ("newer", 2, 2)], ROWS)
    want = rows(store.insert_absent(spark.createDataFrame(rows(want), ROWS), more, ["k"], [F.asc("n")]))
    t.insert_absent(more, [F.asc("n")])
    assert rows(Buckets.open(spark, t.path).rows(spark)) == want


def test_only_touched_buckets_are_read_and_written(spark, table):
    t, _ = table
    before = files(t.path)
    new = spark.createDataFrame([("k1", 1, 7)], ROWS)
    touched = t.upsert(new, [F.desc("n")])
    after = files(t.path)
    assert len(touched) == 1
    folder = f"bucket_of_key={touched[0]}/"
    assert {f for f in before if folder not in f} == {f for f in after if folder not in f}
    assert all(before[f] == after[f] for f in before if folder not in f)
    plan = t.old(spark, touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket_of_key#" in plan.split("PartitionFilters")[1]


def test_children_and_buckets_that_lose_their_last_row(spark, table):
    t, df = table
    parents = spark.createDataFrame([("k3",), ("k4",), (None,), ("absent",)], "k string")
    new = spark.createDataFrame([("k3", 1, 1), ("k3", 2, 2), ("other", 9, 9)], ROWS)
    t.replace_children(new, parents)
    want = [r for r in rows(df) if r[0] not in ("k3", "k4", None)] + [("k3", 1, 1), ("k3", 2, 2)]
    assert rows(t.rows(spark)) == sorted(want, key=str)
    t.delete(t.rows(spark).select("k"))
    assert t.rows(spark).count() == 0
    assert t.upsert(new, [F.desc("n")]) and t.rows(spark).count() == 2
    assert t.upsert(new.limit(0), [F.desc("n")]) == []


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 9)), max_size=6), min_size=1, max_size=3))
def test_batches_in_a_row(spark, tmp_path_factory, batches):
    t = Buckets.create(spark.createDataFrame([], ROWS), str(tmp_path_factory.mktemp("b") / "t"), ["k"], 3)
    held = {}
    for n, batch in enumerate(batches):
        new = [(k, n * 10 + i, v) for i, (k, v) in enumerate(batch)]
        t.upsert(spark.createDataFrame(new, ROWS), [F.desc("n")])
        held |= {r[0]: r for r in new}
    assert rows(t.rows(spark)) == sorted(held.values(), key=str)


def test_wide_rows_are_put_as_by_an_upsert(spark, table):
    """The first batch replaces nothing, the second some rows, the third is the second again."""
    t, df = table
    held = df.where("k is not null")
    t = Buckets.create(held, t.path + "2", ["k"], 16)
    for batch in ([("new1", 1, 7), ("new2", 2, 8)], *[[("k1", 1, 7), ("new2", 3, 9), ("newer", 4, 4)]] * 2):
        new = spark.createDataFrame(batch, ROWS)
        held = spark.createDataFrame(rows(store.upsert(held, new, ["k"], [F.desc("n")])), ROWS)
        t.put(new)
        assert rows(t.rows(spark)) == rows(held)
    assert t.put(new.limit(0)) == []
