import pytest
from pyspark.sql import functions as F

from tidewell.operators import store
from tidewell.plans import ledgers, runs, schemas
from tidewell.sources import harvest


def test_published_batches(spark, tmp_path):
    root = str(tmp_path / "corpus")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.publish({"works": rows, "topics": rows.select("k")}, root, "b1")
    store.publish({"works": rows.limit(0), "topics": rows.select("k")}, root, "b1")  # published already: nothing changes

    def broken(k):
        raise ValueError("no")

    bad = spark.createDataFrame([(3,)], "k int").select(F.udf(broken, "int")("k").alias("k"))
    with pytest.raises(Exception, match="no"):
        store.publish({"works": rows.withColumn("v", F.lit("z")), "topics": bad}, root, "b2")
    assert sorted((r.k, r.v, r.batch) for r in store.published(spark, root, "works").collect()) == [(1, "a", "b1"), (2, "b", "b1")]
    store.publish({"works": rows.where("k = 1"), "topics": rows.select("k")}, root, "b2")
    assert sorted((r.k, r.batch) for r in store.published(spark, root, "works").collect()) == [(1, "b1"), (1, "b2"), (2, "b1")]


def test_tables_are_made_once_and_appended_to(spark, tmp_path):
    root = str(tmp_path)
    assert schemas.create(spark, root, "raw_works", "run_log") == ["raw_works", "run_log"] and schemas.create(spark, root, "raw_works") == []
    assert spark.read.parquet(f"{root}/raw_works").columns == ["work_id", "raw_json", "harvested_at"]
    new = spark.createDataFrame([("w1", "{}", "t1"), ("w1", "{1}", "t2"), ("w2", "{}", "t1")], "work_id string, raw_json string, harvested_at string")
    for _ in range(2):
        store.append_absent(new, f"{root}/raw_works", ["work_id"], [F.asc("harvested_at")])
    assert sorted(map(tuple, spark.read.parquet(f"{root}/raw_works").collect())) == [("w1", "{}", "t1"), ("w2", "{}", "t1")]
    for columns, key in schemas.TABLES.values():
        assert set(key) <= set(spark.createDataFrame([], columns).columns)


def test_deletes_keep_rows_whose_condition_is_null(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted((r.k or 0) for r in store.delete_where(rows, F.col("k") == 1).collect()) == [0, 2]


def test_tracked_runs(spark, tmp_path):
    log, flushed = str(tmp_path / "log"), []
    with runs.tracked(spark, log, "r1", {"n": 1}):
        pass
    with pytest.raises(KeyboardInterrupt), runs.tracked(spark, log, "r2", flush=lambda: flushed.append(2)):
        raise KeyboardInterrupt
    with pytest.raises(ValueError, match="bad"), runs.tracked(spark, log, "r3", flush=lambda: flushed.append(3)):
        raise ValueError("bad")
    got = {r.run_id: (r.status, r.parameters_json, r.notes) for r in runs.current(spark.read.parquet(log)).collect()}
    assert got == {"r1": ("complete", '{"n": 1}', None), "r2": ("partial", None, "interrupted"), "r3": ("failed", None, "bad")} and flushed == [2, 3]
    assert runs.progress(50, 100, 10.0) == "[50/100] 5.00 a second, 0.00 hours left" and runs.progress(0, 9, 0.0).endswith("? hours left")


def test_scan_plans_and_logs(spark):
    targets = spark.createDataFrame([("t1", "One"), ("t2", "Two")], "target_id string, title string")
    asked = {r.target_id: r for r in harvest.journal_filters(targets, spark.createDataFrame([("t1", "S1")], "target_id string, source_id string"), 1990).collect()}
    assert asked["t1"].filter == "primary_location.source.id:S1,from_publication_date:1990-01-01" and asked["t1"].status is None
    assert asked["t2"].filter is None and asked["t2"].status == "NO_SOURCE_RESOLVED"
    page = spark.createDataFrame([("t", "T1", 'a "q"', "core", 0, 5, "*", "ok", "")], "timestamp string, topic_id string, topic_display_name string, topic_tier string, page int, works_returned int, cursor string, status string, message string")
    assert harvest.log_rows(page).first().cursor_hash == "684888c0ebb17f374298b65ee2807526c066094c701bcc7ebbe1c1095f494fc1"
    calls = []
    call = harvest.authorised(lambda: calls.append(1) or "tok", lambda key, token: (200, key + token))
    assert (call("a"), call("b"), calls) == ((200, "atok"), (200, "btok"), [1])
    rows = spark.createDataFrame([(2, "T1", "a", "core", None), (1, "T1", "z", "core", None)], "line int, topic_id string, topic_name string, education_relevance_tier string, include_decision string")
    assert harvest.curated_topics(rows, first=F.asc("line")).first().topic_name == "z" and harvest.curated_topics(rows).first().topic_name == "a"


def test_ledgers_are_idempotent(spark):
    seeded = ledgers.runs(spark)
    assert store.upsert(seeded, seeded, ["harvest_run_id"], [F.asc("source_system")]).count() == len(ledgers.RUNS)
    works = spark.createDataFrame([("w2", "10.1/A"), ("w1", "https://doi.org/10.1/a"), ("w3", "")], "work_id string, doi string")
    found = ledgers.with_work(spark.createDataFrame([("10.1/a",), ("10.1/b",)], "doi_clean string"), works)
    assert sorted((r.doi_clean, r.work_id) for r in found.collect()) == [("10.1/a", "w1"), ("10.1/b", None)]
