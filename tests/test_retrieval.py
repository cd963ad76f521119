import os

from pyspark.sql import functions as F

from tidewell.plans import retrieval


def test_only_the_ledgers_asked_for_and_no_payload_but_for_records(spark, tmp_path):
    rows = [("r1", "s", "topic", "T1", "n", "c", "core", "2024", f'{{"id":"W{i % 3}","title":"t{i}","doi":"10.1/{i % 3}"}}') for i in range(5)]
    batch = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*retrieval.CONTEXT, "raw_json")))
    known = spark.createDataFrame([("W1",)], "work_id string")
    whole = retrieval.Store(str(tmp_path / "whole"), buckets=2)
    whole.apply(batch, "b", known)
    for name in retrieval.KEYS:
        assert ("raw_json" in retrieval.parsed(batch, (name,)).columns) == (name == "records")
        one = retrieval.Store(str(tmp_path / name), buckets=2)
        for _ in range(2):
            one.apply(batch, "b", known, names=(name,))
        assert os.listdir(tmp_path / name) == [name]
        got, want = (sorted(map(tuple, s.table(spark, name).collect()), key=str) for s in (one, whole))
        assert got == want and got
    assert whole.table(spark, "counters").agg(F.sum("seen_count")).first()[0] == 5 and whole.table(spark, "events").where("already_present").count() == 1


def test_payloads_are_sent_once(spark, tmp_path):
    """One shuffle ranks retrievals and tells what was known of their works."""
    batch = spark.createDataFrame([("r1", "s", "topic", "T1", "n", "c", "core", "2024", '{"id":"W1"}')], ", ".join(f"{c} string" for c in (*retrieval.CONTEXT, "raw_json")))
    known = spark.createDataFrame([("W1",)], "work_id string")
    rows = retrieval.knowing(retrieval.parsed(batch, ("records",)), known)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    sent = [x for x in plan.splitlines() if "Exchange" in x]
    assert sum("REPARTITION_BY_COL" in x for x in sent) == 1 and len(sent) <= 2 and "Broadcast" not in plan and rows.first().already_present
