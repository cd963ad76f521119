"""Ledger and run queries over the test tables, and the DuckDB SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import store
from tidewell.plans import ledgers, outputs, runs
from tidewell.plans.oracles import OUTPUT_LAYER, SIGHTINGS
from tidewell.plans.records import ORACLES as FLAT
from tidewell.plans.views import ctes, met
from tidewell.sources import flatten, harvest


def _works(t):
    return flatten.works(t.works_raw)


def _lookups(t):
    return ledgers.with_work(flatten.crossref(t.lookups_raw), _works(t))


def _tagged(t):
    """The output layer with the names of the canonical sources. These are met by their keys, without a list of numbers, and nothing that grows with customers is broadcast by the size of its file."""
    sources = met(t.spark, t.dir, "work_sources", "customer")
    names = outputs.canonical_sources(sources).select("source_key", F.col("source_name").alias("canonical_source_name"), "publisher")
    return outputs.work_output_tags(t.works_flat, sources).join(names.hint("merge"), "source_key", "left")


def _raw(t):
    return ledgers.raw_records({"openalex": (t.works_raw, "work_id"), "crossref": (t.lookups_raw, "doi_clean"), "orcid": (t.profiles_raw, "orcid"), "ror": (t.organisations_raw, "ror_id")})


def _retrievals(t):
    """All works as one run brought them; those with a source were there before. Payloads are hashed before rows are sent, and no side is broadcast."""
    hashed = t.works_raw.select("work_id", F.sha1("raw_json").alias("content_hash"))
    rows = hashed.join(_works(t).select("work_id", "doi").hint("merge"), "work_id").select(F.lit("r1").alias("run_id"), F.lit("hs_openalex_api").alias("source_id"), "work_id", "doi", "content_hash")
    return runs.retrievals(rows, t.work_sources.where("source_id is not null"))


def _counts(t):
    return ledgers.output_counts({
        "pr_publication_output_layer": {"canonical_sources": t.canonical, "work_output_tags": t.tags, "source_metrics": outputs.source_metrics(t.tags), "output_type_metrics": outputs.output_type_metrics(t.tags)},
        "pr_journal_registry_ingest": {"journal_registry": t.reg, "journal_registry_identifiers": outputs.registry_identifiers(t.reg), "journal_registry_current_coverage": t.coverage},
    })


PLANS = {
    "ledger_runs": lambda t: ledgers.runs(t.spark),
    "ledger_sources": lambda t: ledgers.sources(t.spark),
    "ledger_raw_records": _raw,
    "ledger_work_claims": lambda t: ledgers.work_claims(_works(t), _tagged(t), _lookups(t)),
    "ledger_identifier_claims": lambda t: ledgers.identifier_claims(_works(t), _lookups(t)),
    "ledger_output_counts": _counts,
    "ledger_retrievals": _retrievals,
    "delta_status_counts": lambda t: t.fetched.join(outputs.scope_delta(t.plain_tags), "doi_clean", "left_semi").groupBy("response_status").agg(F.count("*").alias("n")),
    "delete_by_predicate": lambda t: store.delete_where(t.harvest_log, (F.col("run_id") == "run2") | F.col("status").isin("view", "signup")).select("event_id", "run_id", "status"),
    "journal_scan_order": lambda t: harvest.in_priority(harvest.journal_targets(t.journal_targets_raw)),
    "topic_scan_plan": lambda t: harvest.topic_filters(t.curated_topics.where("education_relevance_tier is not null"), ("AU", "NZ"), 1990),
}

_VALUES = ", ".join(str(r) for r in ledgers.RUNS)
_DOIS = """
lk AS (SELECT f.*, o.work_id, o.doi FROM flat f LEFT JOIN (SELECT lower(regexp_replace(trim(doi), '^https?://(dx\\.)?doi\\.org/', '', 'i')) AS n, min(work_id) AS work_id, arg_min(doi, work_id) AS doi FROM wf WHERE doi <> '' GROUP BY 1) o ON f.doi_clean = o.n)"""
_BOTH = f"WITH wf AS ({FLAT['flat_works']}), flat AS ({FLAT['flat_lookups']}), {_DOIS}"
_ORDER = "CASE acquisition_priority WHEN 'highest' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 WHEN 'low' THEN 4 ELSE 5 END"

ORACLES = {
    "ledger_runs": f"SELECT *, 'historical_backfill' AS status, '{{\"backfilled\": true}}' AS parameters_json FROM (VALUES {_VALUES}) v(harvest_run_id, source_system, harvest_type)",
    "ledger_sources": f"SELECT * FROM (VALUES {', '.join(str(r) for r in ledgers.SOURCES)}) v(harvest_source_id, source_system, source_name, source_type)",
    "ledger_raw_records": ctes("works_raw", "lookups_raw", "profiles_raw", "organisations_raw") + """, r AS (
        SELECT 'raw_openalex_work_' AS p, 'hr_openalex_initial_topic_harvest' AS harvest_run_id, 'hs_openalex_api' AS harvest_source_id, 'openalex' AS source_system, work_id AS k, 'work' AS source_record_type, 200 AS response_status, raw_json FROM works_raw
        UNION ALL SELECT 'raw_crossref_work_', 'hr_crossref_all_dois_2026_05', 'hs_crossref_api', 'crossref', doi_clean, 'work', response_status, raw_json FROM lookups_raw
        UNION ALL SELECT 'raw_orcid_profile_', 'hr_orcid_profile_harvest', 'hs_orcid_api', 'orcid', orcid, 'person', response_status, raw_json FROM profiles_raw
        UNION ALL SELECT 'raw_ror_record_', 'hr_ror_snapshot_ingest', 'hs_ror_registry', 'ror', ror_id, 'institution', 200, raw_json FROM organisations_raw)
        SELECT p || sha1(k) AS raw_record_id, harvest_run_id, harvest_source_id, source_system, k AS source_record_id, source_record_type, CAST(response_status AS INT) AS response_status, sha1(coalesce(raw_json, '')) AS content_hash FROM r""",
    "ledger_work_claims": _BOTH + f""", ot AS ({OUTPUT_LAYER}SELECT t.*, c.source_name AS canonical_source_name, c.publisher FROM tags t LEFT JOIN canon c ON t.canonical_source_id = c.canonical_source_id)
        SELECT 'claim_openalex_work_' || sha1(work_id) AS claim_id, 'openalex' AS source_system, 'hr_openalex_initial_topic_harvest' AS harvest_run_id, 'raw_openalex_work_' || sha1(work_id) AS raw_record_id, work_id AS source_work_id, work_id AS canonical_work_id, doi, title,
               publication_year, work_type, NULL AS container_title, NULL AS source_name, NULL AS publisher, 'native_record' AS claim_confidence, 'native_openalex_work_id' AS match_method FROM wf
        UNION ALL SELECT 'claim_current_output_layer_' || sha1(work_id), 'derived_current_database', NULL, NULL, work_id, work_id, doi, title, publication_year, work_type, canonical_source_name, source_name, publisher, 'derived', 'current_work_output_tags' FROM ot
        UNION ALL SELECT 'claim_crossref_work_' || sha1(doi_clean), 'crossref', 'hr_crossref_all_dois_2026_05', 'raw_crossref_work_' || sha1(doi_clean), doi_clean, work_id, doi, title, year, crossref_type, container_title, container_title, publisher, 'doi_exact', 'doi' FROM lk""",
    "ledger_identifier_claims": _BOTH + """, c AS (
        SELECT 'idclaim_openalex_' || sha1(work_id) AS claim_id, 'openalex' AS source_system, work_id AS k, work_id AS canonical_work_id, 'openalex_work_id' AS identifier_type, work_id AS identifier_value, work_id AS identifier_normalised, 'native_record' AS claim_confidence, 'native_openalex_work_id' AS match_method FROM wf
        UNION ALL SELECT 'idclaim_openalex_doi_' || sha1(work_id || doi), 'openalex', work_id, work_id, 'doi', doi, lower(regexp_replace(doi, '^https?://(dx\\.)?doi\\.org/', '', 'i')), 'source_supplied', 'openalex_doi_field' FROM wf WHERE doi <> ''
        UNION ALL SELECT 'idclaim_crossref_doi_' || sha1(doi_clean), 'crossref', doi_clean, work_id, 'doi', doi, doi_clean, 'native_record', 'crossref_doi_endpoint' FROM lk
        UNION ALL SELECT 'idclaim_crossref_isbn_' || sha1(doi_clean || isbn), 'crossref', doi_clean, work_id, 'isbn', isbn, isbn, 'source_supplied', 'crossref_isbn_field' FROM lk WHERE isbn <> '')
        SELECT * EXCLUDE (k), CASE source_system WHEN 'openalex' THEN 'hr_openalex_initial_topic_harvest' ELSE 'hr_crossref_all_dois_2026_05' END AS harvest_run_id, 'raw_' || source_system || '_work_' || sha1(k) AS raw_record_id FROM c""",
    "ledger_output_counts": OUTPUT_LAYER + """SELECT 'pr_publication_output_layer' AS processing_run_id, 'canonical_sources' AS output_table, count(*) AS row_count FROM canon UNION ALL SELECT 'pr_publication_output_layer', 'work_output_tags', count(*) FROM tags
        UNION ALL SELECT 'pr_publication_output_layer', 'source_metrics', count(*) FROM metrics
        UNION ALL SELECT 'pr_publication_output_layer', 'output_type_metrics', count(*) FROM (SELECT DISTINCT work_type, type_crossref, source_type, derived_output_class, broad_output_family FROM tags)
        UNION ALL SELECT 'pr_journal_registry_ingest', 'journal_registry', count(*) FROM reg UNION ALL SELECT 'pr_journal_registry_ingest', 'journal_registry_identifiers', count(*) FROM ids
        UNION ALL SELECT 'pr_journal_registry_ingest', 'journal_registry_current_coverage', count(*) FROM cov""",
    "ledger_retrievals": ctes("work_sources", "works_raw") + f""", k AS (SELECT w.work_id, doi, raw_json, sha1('r1|hs_openalex_api|' || w.work_id)[1:16] AS h, w.work_id IN (SELECT work_id FROM work_sources WHERE source_id IS NOT NULL) AS already_present
        FROM works_raw w JOIN ({FLAT['flat_works']}) f ON w.work_id = f.work_id)
        SELECT 'disc_' || h AS event_id, 'oahr_' || h AS harvest_record_id, 'raw_openalex_retrieval_' || h AS raw_record_id, 'claim_openalex_retrieval_' || h AS claim_id, 'r1' AS run_id, 'hs_openalex_api' AS source_id, work_id,
               lower(regexp_replace(doi, '^https?://(dx\\.)?doi\\.org/', '', 'i')) AS doi, sha1(raw_json) AS content_hash, already_present FROM k""",
    "delta_status_counts": OUTPUT_LAYER + """, f AS (SELECT DISTINCT normal AS doi_clean, CASE WHEN CAST(right(normal, 1) AS INT) % 2 = 0 THEN 200 ELSE 404 END AS response_status FROM dois WHERE CAST(right(normal, 1) AS INT) % 3 = 0)
        SELECT response_status, count(*) AS n FROM f WHERE doi_clean IN (SELECT doi_clean FROM delta) GROUP BY 1""",
    "delete_by_predicate": SIGHTINGS + "SELECT event_id, run_id, status FROM harvest_log WHERE NOT coalesce(run_id = 'run2' OR status IN ('view', 'signup'), false)",
    "journal_scan_order": ctes("journal_targets_raw") + f""", k AS (SELECT *, regexp_replace(upper(trim("print_ISSN")), '[^0-9X]', '', 'g') AS p, regexp_replace(upper(trim("electronic_ISSN")), '[^0-9X]', '', 'g') AS e FROM journal_targets_raw),
        s AS (SELECT *, CASE WHEN length(p) = 8 THEN p[1:4] || '-' || p[5:8] ELSE '' END AS pi, CASE WHEN length(e) = 8 THEN e[1:4] || '-' || e[5:8] ELSE '' END AS ei FROM k),
        g AS (SELECT 'oajournal_' || sha1(coalesce(nullif(trim(coalesce(family_id, '')), ''), trim(canonical_title)) || '|' || pi || '|' || ei)[1:16] AS target_id, trim(canonical_title) AS title, pi AS print_issn, ei AS electronic_issn, acquisition_priority FROM s)
        SELECT *, CAST({_ORDER} AS INT) AS priority_rank, row_number() OVER (ORDER BY {_ORDER}, title, target_id) AS scan_position FROM g""",
    "topic_scan_plan": ctes("curated_topics") + """ SELECT topic_id AS source_identifier, topic_name AS source_display_name, 'topic' AS source_type, education_relevance_tier,
        'topics.id:' || topic_id || ',authorships.institutions.country_code:AU|NZ,from_publication_date:1990-01-01' AS filter FROM curated_topics WHERE education_relevance_tier IS NOT NULL""",
}
