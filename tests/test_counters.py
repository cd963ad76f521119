import random
import time

from tidewell.operators.buckets import Buckets
from tidewell.streaming import counters


def stream(spark, folder):
    return spark.readStream.schema("k string, r string, seen_at long").option("maxFilesPerTrigger", 1).parquet(folder)


def counts(rows):
    out = {}
    for k, r, s in rows:
        if s is not None:
            a, b, n = out.get((k, r), (s, s, 0))
            out[k, r] = min(a, s), max(b, s), n + 1
    return sorted(((*k, *v) for k, v in out.items()), key=str)


def test_counters_survive_a_restart(spark, tmp_path):
    """Three files before the restart, two after it; one key holds a third of all sightings, keys and times may be null."""
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice([None, *range(50)])) for _ in range(200)]
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    write = lambda part: spark.createDataFrame(part, "k string, r string, seen_at long").coalesce(1).write.mode("append").parquet(source)
    run = lambda: counters.keep(stream(spark, source), ["k", "r"], table, checkpoint, availableNow=True).awaitTermination()
    for n in range(3):
        write(rows[n * 40 : n * 40 + 40])
    run()
    held = lambda: sorted((tuple(r[:5]) for r in Buckets.open(spark, table).rows(spark).collect()), key=str)
    assert held() == counts(rows[:120])
    run()  # nothing new
    assert held() == counts(rows[:120])
    write(rows[120:160])
    write(rows[160:])
    run()
    assert held() == counts(rows)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_quiet_keys_are_told(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame([("a", "x", 1), ("a", "x", 4)], "k string, r string, seen_at long").coalesce(1).write.parquet(source)
    query = counters.keep(stream(spark, source), ["k"], table, str(tmp_path / "c"), quiet_ms=1, buckets=2, processingTime="1 second")

    def told():
        try:
            return {r.k: (r.seen_count, r.is_quiet) for r in Buckets.open(spark, table).rows(spark).collect()}
        except Exception:  # not there yet, or just being replaced
            return None

    end, held = time.time() + 60, None
    try:
        while held != {"a": (2, True)} and time.time() < end:
            time.sleep(1)
            held = told()
    finally:
        query.stop()
    assert held == {"a": (2, True)}
