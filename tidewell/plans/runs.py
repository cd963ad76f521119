"""Run lifecycle and per-retrieval provenance: statuses are appended, the latest of a run counts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import text
from tidewell.operators import store

STATUS = "run_id string, status string, parameters_json string, notes string, seq long, at string"


def status(spark: SparkSession, run_id: str, state: str, at: str, seq: int, parameters: dict | None = None, notes: str | None = None) -> DataFrame:
    return spark.createDataFrame([(run_id, state, json.dumps(parameters) if parameters is not None else None, notes, seq, at)], STATUS)


def current(log: DataFrame) -> DataFrame:
    """The latest status of each run, with the first parameters and the last notes that were given."""
    kept = log.groupBy("run_id").agg(F.min_by("parameters_json", F.when(F.col("parameters_json").isNotNull(), F.col("seq"))).alias("parameters_json"), F.max_by("notes", F.when(F.col("notes").isNotNull(), F.col("seq"))).alias("notes"))
    last = store.latest(log, ["run_id"], [F.desc("seq"), F.desc("at")])
    return last.drop("parameters_json", "notes").join(kept, "run_id")


@contextmanager
def tracked(spark: SparkSession, log: str, run_id: str, parameters: dict | None = None, flush: Callable[[], None] = lambda: None) -> Iterator[None]:
    """A run whose statuses are appended to the table at log: running, then complete, or partial (interrupted) or failed.

    However the run ends, flush writes what was fetched but not yet written; errors are raised again.
    """

    def note(state: str, given: dict | None = None, notes: str | None = None) -> None:
        now = datetime.now(UTC).isoformat(timespec="seconds")
        status(spark, run_id, state, now, time.time_ns(), given, notes).coalesce(1).write.mode("append").parquet(log)

    note("running", parameters)
    try:
        try:
            yield
        finally:
            flush()
    except KeyboardInterrupt:
        note("partial", notes="interrupted")
        raise
    except BaseException as e:
        note("failed", notes=str(e)[:2000])
        raise
    note("complete")


def progress(done: int, total: int, seconds: float) -> str:
    """One line: how far, how fast, how long still."""
    rate = done / seconds if seconds else 0.0
    left = f"{(total - done) / rate / 3600:.2f}" if rate else "?"
    return f"[{done}/{total}] {rate:.2f} a second, {left} hours left"


def require(spark: SparkSession, tables: list[str]) -> None:
    """Fail at once if a table is missing, naming all that are."""
    missing = [t for t in tables if not spark.catalog.tableExists(t)]
    if missing:
        raise ValueError("missing tables: " + ", ".join(missing))


def _id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16))


def retrievals(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Discovery events of fetched works (run_id, source_id, work_id, doi, and raw_json or its content_hash), with whether each was there before.

    Payloads are hashed before rows are sent. What was known may be as many works as there are, so it is never broadcast.
    """
    if "content_hash" not in rows.columns:
        rows = rows.select("run_id", "source_id", "work_id", "doi", F.sha1("raw_json").alias("content_hash"))
    before = known.select("work_id").distinct().withColumn("_known", F.lit(True)).hint("merge")
    key = [F.col(c) for c in ("run_id", "source_id", "work_id")]
    return rows.join(before, "work_id", "left").select(_id("disc_", *key).alias("event_id"), _id("oahr_", *key).alias("harvest_record_id"), _id("raw_openalex_retrieval_", *key).alias("raw_record_id"), _id("claim_openalex_retrieval_", *key).alias("claim_id"), "run_id", "source_id", "work_id", text.normalize_doi(F.col("doi")).alias("doi"), "content_hash", F.coalesce("_known", F.lit(False)).alias("already_present"))


def apply_works(old: DataFrame, new: DataFrame, update_existing: bool = False) -> DataFrame:
    """Known works are rewritten only if asked for; their rediscovery is in the ledger either way."""
    order = [F.asc_nulls_last(c) for c in new.columns if c != "work_id"]
    return store.upsert(old, new, ["work_id"], order) if update_existing else store.insert_absent(old, new, ["work_id"], order)
