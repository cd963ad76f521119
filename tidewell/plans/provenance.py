"""Ledgers: raw records, work claims, identifier claims, sightings. Append-only; keys are hashes, so a second append changes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text


def raw_records(rows: DataFrame, key: str, payload: str, prefix: str, run: Column) -> DataFrame:
    """Raw record id, its key, the hash of what was stored, and the run that brought it."""
    return rows.select(text.hashed(prefix, F.col(key)).alias("raw_record_id"), F.col(key).alias("record_key"), F.sha1(F.col(payload)).alias("content_hash"), run.alias("run_id"))


def work_claims(works: DataFrame, prefix: str, source: str) -> DataFrame:
    return works.select(text.hashed(prefix, F.col("work_id")).alias("claim_id"), "work_id", F.lit(source).alias("claim_source"), "title", "publication_year", "work_type")


def identifier_claims(works: DataFrame) -> DataFrame:
    """The work's id, and its DOI where there is one."""
    own = works.select(text.hashed("idclaim_openalex_", F.col("work_id")).alias("claim_id"), "work_id", F.lit("openalex").alias("identifier_type"), F.col("work_id").alias("identifier"))
    doi = text.normalize_doi(F.col("doi"))
    dois = works.where("doi is not null and doi != ''").select(text.hashed("idclaim_openalex_doi_", F.col("work_id"), doi).alias("claim_id"), "work_id", F.lit("doi").alias("identifier_type"), doi.alias("identifier"))
    return own.unionByName(dois)


def discovery_summary(events: DataFrame) -> DataFrame:
    """Sightings by run and status, split by whether the record was already there."""
    first = events.groupBy("record_id").agg(F.min("event_id").alias("first_event"))
    return events.join(first, "record_id").groupBy("run_id", "status", (F.col("event_id") != F.col("first_event")).alias("already_present")).agg(F.count("*").alias("sightings"), F.count_distinct("record_id").alias("records"))
