"""Ledgers backfilled from the tables that are there: runs, sources, raw records, work claims, identifier claims, outputs.

All are keyed by hashes or fixed ids, so store.upsert() of a second backfill changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import text

BACKFILL = "historical_backfill"
#: Id, system, kind of retrieval.
RUNS = (
    ("hr_openalex_initial_topic_harvest", "openalex", "topic_harvest"),
    ("hr_crossref_all_dois_2026_05", "crossref", "doi_api"),
    ("hr_orcid_profile_harvest", "orcid", "profile_api"),
    ("hr_ror_snapshot_ingest", "ror", "bulk_or_api_ingest"),
)
#: Id, system, name, kind.
SOURCES = (
    ("hs_openalex_api", "openalex", "OpenAlex API", "api"),
    ("hs_crossref_api", "crossref", "Crossref REST API", "api"),
    ("hs_orcid_api", "orcid", "ORCID Public API", "api"),
    ("hs_ror_registry", "ror", "ROR Registry", "registry"),
)
#: Fixed values of raw records by system: prefix of the id, type, run, source.
RAW = {
    "openalex": ("raw_openalex_work_", "work", "hr_openalex_initial_topic_harvest", "hs_openalex_api"),
    "crossref": ("raw_crossref_work_", "work", "hr_crossref_all_dois_2026_05", "hs_crossref_api"),
    "orcid": ("raw_orcid_profile_", "person", "hr_orcid_profile_harvest", "hs_orcid_api"),
    "ror": ("raw_ror_record_", "institution", "hr_ror_snapshot_ingest", "hs_ror_registry"),
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def runs(spark: SparkSession) -> DataFrame:
    """The runs that older tables stem from; status and version say that they were inferred."""
    seeded = spark.createDataFrame(list(RUNS), "harvest_run_id string, source_system string, harvest_type string")
    return seeded.withColumn("status", F.lit(BACKFILL)).withColumn("parameters_json", F.lit('{"backfilled": true}'))


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SOURCES), "harvest_source_id string, source_system string, source_name string, source_type string")


def raw_records(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """tables: by system the raw table and its key; a table without response_status holds successes. A null payload is hashed as empty."""
    parts = []
    for system, (rows, key) in tables.items():
        prefix, kind, run, source = RAW[system]
        status = F.col("response_status") if "response_status" in rows.columns else F.lit(200)
        parts.append(rows.select(
            text.hashed(prefix, F.col(key)).alias("raw_record_id"), F.lit(run).alias("harvest_run_id"), F.lit(source).alias("harvest_source_id"), F.lit(system).alias("source_system"),
            F.col(key).alias("source_record_id"), F.lit(kind).alias("source_record_type"), status.cast("int").alias("response_status"), F.sha1(F.coalesce("raw_json", F.lit(""))).alias("content_hash"),
        ))
    return _union(parts)


def _claims(rows: DataFrame, claim: Column, system: str | None, key: Column, **columns: Column | str) -> DataFrame:
    """rows with the columns that all claims share; system gives run and raw record, none means derived."""
    none = F.lit(None).cast("string")
    prefix, _, run, _ = RAW[system] if system else (None, None, None, None)
    return rows.select(
        claim.alias("claim_id"), F.lit(system or "derived_current_database").alias("source_system"), F.lit(run).cast("string").alias("harvest_run_id"),
        (text.hashed(prefix, key) if prefix else none).alias("raw_record_id"), *(c.alias(n) if isinstance(c, Column) else F.lit(c).alias(n) for n, c in columns.items()),
    )


def work_claims(works: DataFrame, tags: DataFrame, lookups: DataFrame) -> DataFrame:
    """What each source says of a work. works: work_id and flat fields; tags: the output layer; lookups: doi_clean, work_id and flat fields."""
    c, none = F.col, F.lit(None).cast("string")
    shared = {"title": c("title"), "publication_year": c("publication_year"), "work_type": c("work_type")}
    native = _claims(
        works, text.hashed("claim_openalex_work_", c("work_id")), "openalex", c("work_id"), source_work_id=c("work_id"), canonical_work_id=c("work_id"), doi=c("doi"), **shared,
        container_title=none, source_name=none, publisher=none, claim_confidence="native_record", match_method="native_openalex_work_id",
    )
    derived = _claims(
        tags, text.hashed("claim_current_output_layer_", c("work_id")), None, c("work_id"), source_work_id=c("work_id"), canonical_work_id=c("work_id"), doi=c("doi"), **shared,
        container_title=c("canonical_source_name"), source_name=c("source_name"), publisher=c("publisher"), claim_confidence="derived", match_method="current_work_output_tags",
    )
    looked_up = _claims(
        lookups, text.hashed("claim_crossref_work_", c("doi_clean")), "crossref", c("doi_clean"), source_work_id=c("doi_clean"), canonical_work_id=c("work_id"), doi=c("doi"), title=c("title"), publication_year=c("year"), work_type=c("crossref_type"),
        container_title=c("container_title"), source_name=c("container_title"), publisher=c("publisher"), claim_confidence="doi_exact", match_method="doi",
    )
    return _union([native, derived, looked_up])


def identifier_claims(works: DataFrame, lookups: DataFrame) -> DataFrame:
    """Work ids, DOIs from both sides, and ISBNs; what is empty makes no claim."""
    c = F.col
    bare = F.lower(text.strip_doi_url(c("doi")))

    def claims(rows, claim, system, key, kind, value, normal, confidence, method):
        return _claims(rows, claim, system, key, canonical_work_id=c("work_id"), identifier_type=kind, identifier_value=value, identifier_normalised=normal, claim_confidence=confidence, match_method=method)

    key, doi = c("work_id"), c("doi_clean")
    return _union([
        claims(works, text.hashed("idclaim_openalex_", key), "openalex", key, "openalex_work_id", key, key, "native_record", "native_openalex_work_id"),
        claims(works.where("doi != ''"), text.hashed("idclaim_openalex_doi_", key, c("doi")), "openalex", key, "doi", c("doi"), bare, "source_supplied", "openalex_doi_field"),
        claims(lookups, text.hashed("idclaim_crossref_doi_", doi), "crossref", doi, "doi", c("doi"), doi, "native_record", "crossref_doi_endpoint"),
        claims(lookups.where("isbn != ''"), text.hashed("idclaim_crossref_isbn_", doi, c("isbn")), "crossref", doi, "isbn", c("isbn"), c("isbn"), "source_supplied", "crossref_isbn_field"),
    ])


def output_counts(outputs: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Rows of each table that a processing run made: run -> table -> rows."""
    return _union([
        df.agg(F.count("*").alias("row_count")).select(F.lit(run).alias("processing_run_id"), F.lit(name).alias("output_table"), "row_count")
        for run, made in outputs.items() for name, df in made.items()
    ])


def with_work(lookups: DataFrame, works: DataFrame) -> DataFrame:
    """Flat lookups with the work and the DOI as it was spelled; of several works of a DOI the smallest.

    Both sides are sent by DOI: works made of raw records look far smaller to Spark than they are, so it would broadcast them.
    """
    of = works.where("doi != ''").groupBy(text.normalize_doi(F.col("doi")).alias("doi_clean")).agg(F.min(F.struct("work_id", "doi")).alias("w"))
    return lookups.join(of.hint("merge"), "doi_clean", "left").select(lookups["*"], "w.work_id", "w.doi")
