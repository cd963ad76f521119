"""What a batch of retrieved works leaves behind: payloads, discovery events, counters, claims and the works themselves.

Every row has a key that run, source and work give, so a batch that is applied twice leaves the same
tables; counters remember the batch that they were last raised by. Each ledger is a bucketed table:
a batch reads and writes the buckets of its own keys, however much was retrieved before. The payload
is parsed once a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions import text
from tidewell.operators.buckets import Buckets
from tidewell.operators.kept import kept
from tidewell.sources import flatten

#: Columns of a batch beside its payload: who asked for what, and when it came.
CONTEXT = ("run_id", "source_id", "source_type", "source_identifier", "source_display_name", "discovery_context", "education_relevance_tier", "retrieved_at")
#: The ledgers with the keys that they are merged by.
KEYS = {
    "records": ["harvest_record_id"], "events": ["event_id"], "counters": ["work_id", "source_id"], "topics_seen": ["work_id", "topic_id"],
    "work_claims": ["claim_id"], "identifier_claims": ["claim_id"], "works": ["work_id"],
}


def _id(prefix: str, *more: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", "run_id", "source_id", "work_id", *more)), 1, 16))


#: The ledgers that are told from fields of the record.
TOLD = {"work_claims", "identifier_claims", "works"}


def parsed(batch: DataFrame, ledgers=tuple(KEYS)) -> DataFrame:
    """batch (CONTEXT and raw_json) with work_id and times: a row a run, source and work, the latest; payloads without an id leave nothing.

    The record's fields are told, and the payload is left behind, before rows are sent anywhere: of raw_json,
    content_hash, work (the columns of works) and source there is what these ledgers need. Rows are sent once, to their
    work, where they also meet what was known of it, see knowing().
    """
    rows = flatten.once_a_row(batch.where(F.ltrim("raw_json").startswith("{")), "v", F.try_parse_json("raw_json"))
    rows = rows.withColumn("work_id", F.try_variant_get("v", "$.id", "string")).where("work_id is not null")
    place = "$.primary_location.source"
    fields = [F.struct(*flatten.work_fields()).alias("work"), *(F.try_variant_get("v", f"{place}.{f}", "string").alias(n) for n, f in (("source_name", "display_name"), ("publisher", "publisher")))]
    payload = ["raw_json"] if "records" in ledgers else []
    rows = rows.select("work_id", *CONTEXT, F.sha1("raw_json").alias("content_hash"), *payload, *(fields if TOLD & set(ledgers) else [])).repartition("work_id")
    same = Window.partitionBy("run_id", "source_id", "work_id")
    ranked = rows.withColumns({"times": F.count("*").over(same), "_n": F.row_number().over(same.orderBy(F.desc("retrieved_at"), "content_hash"))})
    return ranked.where("_n = 1").drop("_n")


def knowing(rows: DataFrame, known: DataFrame) -> DataFrame:
    """A parsed batch with whether each work was there before it."""
    before = known.select("work_id").distinct().withColumn("_known", F.lit(True)).hint("merge")  # as many as there are works: never broadcast
    return rows.join(before, "work_id", "left").withColumn("already_present", F.coalesce("_known", F.lit(False))).drop("_known")


def ledgers(rows: DataFrame, known: DataFrame, batch: str, names=tuple(KEYS)) -> dict[str, DataFrame]:
    """The rows that a parsed batch adds to each of these ledgers; known: the work_ids that were there before the batch, unless rows already tell (knowing)."""
    made = _added(rows, known, batch)
    return {name: made[name]() for name in KEYS if name in names}  # works last: until they are in, known may be read from them


def _added(rows: DataFrame, known: DataFrame, batch: str) -> dict:
    """What makes the rows of each ledger."""

    def told_before() -> DataFrame:
        return rows if "already_present" in rows.columns else knowing(rows, known)

    def told() -> DataFrame:
        return rows.select("*", *(f"work.{c}" for c in ("doi", "title", "publication_year", "publication_date", "work_type"))).drop("work")

    system, work, at = F.lit("openalex").alias("source_system"), F.col("work_id"), F.col("retrieved_at")
    raw, doi = _id("raw_openalex_retrieval_").alias("raw_record_id"), text.normalize_doi(F.col("doi"))

    def identifiers(having: DataFrame, key: Column, kind: str, value: Column, normal: Column, confidence: str) -> DataFrame:
        return having.select(
            key.alias("claim_id"), "work_id", system, "run_id", raw, F.lit(kind).alias("identifier_type"), value.alias("identifier"), normal.alias("identifier_normalised"),
            F.lit(confidence).alias("confidence"), F.col("discovery_context").alias("match_method"), at.alias("created_at"),
        )

    own = lambda: identifiers(told(), _id("idclaim_openalex_retrieval_"), "openalex_work_id", work, work, "native_record")
    dois = lambda: identifiers(told().where("trim(doi) != ''"), _id("idclaim_openalex_doi_retrieval_", doi), "doi", F.trim("doi"), doi, "source_supplied")
    return {
        "records": lambda: told_before().select(_id("oahr_").alias("harvest_record_id"), raw, "run_id", "source_id", "work_id", "retrieved_at", F.lit(200).alias("response_status"), "already_present", "raw_json", "content_hash"),
        "events": lambda: told_before().select(_id("disc_").alias("event_id"), "run_id", "source_id", system, work.alias("record_id"), F.lit("work").alias("record_type"), "discovery_context", "source_identifier", at.alias("discovered_at"), "already_present"),
        "counters": lambda: rows.groupBy("work_id", "source_id").agg(
            F.max("source_type").alias("source_type"), F.max("source_identifier").alias("source_identifier"), F.max("source_display_name").alias("source_display_name"),
            F.min("retrieved_at").alias("first_seen_at"), F.max("retrieved_at").alias("latest_seen_at"), F.sum("times").alias("seen_count"),
        ).withColumn("batch", F.lit(batch)),
        "topics_seen": lambda: rows.where("source_type = 'topic'").groupBy("work_id", F.col("source_identifier").alias("topic_id")).agg(
            F.min("source_display_name").alias("topic_name"), F.min("education_relevance_tier").alias("education_relevance_tier"), F.min("retrieved_at").alias("seen_at")
        ),
        "work_claims": lambda: told().select(
            _id("claim_openalex_retrieval_").alias("claim_id"), system, "run_id", raw, work.alias("source_work_id"), "work_id", "doi", "title", "publication_year", "publication_date", "work_type",
            F.col("source_name").alias("container_title"), "publisher", F.lit("native_record").alias("claim_confidence"), F.col("discovery_context").alias("match_method"), at.alias("created_at"),
        ),
        "identifier_claims": lambda: own().unionByName(dois()),
        "works": lambda: rows.select("work_id", "work.*"),
    }


@dataclass(frozen=True)
class Store:
    """The ledgers under a folder."""

    root: str
    buckets: int = 64

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return Buckets.open(spark, f"{self.root}/{name}").rows(spark)

    def apply(self, batch: DataFrame, name: str, known: DataFrame, update_existing: bool = False, names=tuple(KEYS)) -> None:
        """Applies a batch of this name to the ledgers of these names; works that are known are rewritten only if asked for, their rediscovery is told either way."""
        spark = batch.sparkSession
        # who knew a work is asked before this batch's works come in, also when it is applied a second time
        rows = parsed(batch, names)
        rows = knowing(rows, known) if {"records", "events"} & set(names) else rows
        new = ledgers(kept(rows, "retrieved", "zstd"), known, name, names)
        for ledger, rows in new.items():
            self._ledger(spark, ledger, rows, name, update_existing)

    def _ledger(self, spark: SparkSession, ledger: str, rows: DataFrame, batch: str, update_existing: bool) -> None:
        path, keys = f"{self.root}/{ledger}", KEYS[ledger]
        there = _open(spark, path) or Buckets.create(rows.limit(0), path, keys, self.buckets)
        order = [F.asc_nulls_last(c) for c in rows.columns if c not in keys]
        if ledger == "records":  # one row a key already; its payloads are long
            there.put(rows)
        elif ledger == "counters":
            there.merge(rows, lambda old: _raised(old, rows, batch))
        elif ledger == "topics_seen" or ledger == "works" and not update_existing:
            there.insert_absent(rows, order)
        else:
            there.upsert(rows, order)


def _open(spark: SparkSession, path: str) -> Buckets | None:
    try:
        return Buckets.open(spark, path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _raised(old: DataFrame, new: DataFrame, batch: str) -> DataFrame:
    """Counters of old and new sightings; those that the batch has raised before stay."""
    done = old.where(F.col("batch") == batch)
    todo = new.join(done.select("work_id", "source_id"), ["work_id", "source_id"], "left_anti")
    open_ = old.where(F.col("batch") != batch).withColumn("_old", F.lit(True)).unionByName(todo.withColumn("_old", F.lit(False)))
    latest = lambda c: F.max_by(c, F.struct("latest_seen_at", (~F.col("_old")).alias("n"))).alias(c)
    summed = open_.groupBy("work_id", "source_id").agg(
        *(latest(c) for c in ("source_type", "source_identifier", "source_display_name")),
        F.min("first_seen_at").alias("first_seen_at"), F.max("latest_seen_at").alias("latest_seen_at"), F.sum("seen_count").alias("seen_count"), F.max_by("batch", F.struct((~F.col("_old")).alias("n"))).alias("batch"),
    )
    return summed.unionByName(done)
