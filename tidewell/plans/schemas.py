"""Schemas and keys of the stored tables; create() lays down those that are absent."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewell.operators import store
from tidewell.plans import runs

_CLAIM = "claim_id string, source_system string, harvest_run_id string, raw_record_id string, canonical_work_id string"
#: By table: columns, key.
TABLES = {
    "raw_works": ("work_id string, raw_json string, harvested_at string", ["work_id"]),
    "raw_lookups": ("doi_clean string, response_status int, raw_json string, error_text string, retrieved_at string", ["doi_clean"]),
    "raw_profiles": ("orcid string, response_status int, raw_json string, error_text string, retrieved_at string", ["orcid"]),
    "raw_organisations": ("ror_id string, raw_json string", ["ror_id"]),
    "works_seen": ("record_id string, run_id string, first_seen string, latest_seen string, seen_count long", ["record_id", "run_id"]),
    "harvest_log": ("timestamp string, topic_id string, topic_display_name string, topic_tier string, page int, works_returned int, cursor_hash string, status string, message string", []),
    "run_log": (runs.STATUS, ["run_id", "seq"]),
    "raw_source_records": ("raw_record_id string, harvest_run_id string, harvest_source_id string, source_system string, source_record_id string, source_record_type string, response_status int, content_hash string", ["raw_record_id"]),
    "source_work_claims": (
        f"{_CLAIM}, source_work_id string, doi string, title string, publication_year int, work_type string, container_title string, source_name string, publisher string, claim_confidence string, match_method string",
        ["claim_id"],
    ),
    "work_identifier_claims": (f"{_CLAIM}, identifier_type string, identifier_value string, identifier_normalised string, claim_confidence string, match_method string", ["claim_id"]),
}


def create(spark: SparkSession, root: str, *names: str) -> list[str]:
    """Empty Parquet tables under root for the names given (all, if none) that aren't there; returns those it made."""
    return [n for n in names or TABLES if store.create_absent(spark, f"{root}/{n}", TABLES[n][0])]
