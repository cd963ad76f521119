"""Breakdowns and top lists over the layers, with the DuckDB SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.plans import institutions, outputs, reports, ror
from tidewell.plans.oracles import IDENTITY_LAYER, INSTITUTION_LAYER, OUTPUT_LAYER, SIGHTINGS
from tidewell.plans.records import ORACLES as FLAT
from tidewell.plans.views import ctes
from tidewell.sources import flatten


def _places(t):
    """What a register with names, aliases and places adds to the canonical institutions."""
    raw = t.organisations_raw
    canon = institutions.canonical(t.institution_map).select("canonical_institution_id", "canonical_name", "canonical_ror")
    full = ror.enriched(
        canon, flatten.organisations(raw), flatten.organisation_names(raw), flatten.organisation_lists(raw, "aliases"), flatten.organisation_locations(raw),
        flatten.organisation_relationships(raw), flatten.organisation_ids(raw), flatten.organisation_lists(raw, "links"),
    )
    return full.select("canonical_institution_id", "canonical_name", "canonical_ror", "ror_name", "ror_status", "established", "ror_names", "aliases", "city", "country_code", "lat", "lng", "external_ids", "relationships", "has_ror_match")


#: Breakdowns: rows and the columns that they are counted by.
BREAKDOWNS = {
    "breakdown_work_types": (lambda t: t.works_flat, ("work_type",), ctes("works_flat") + "SELECT * FROM works_flat"),
    "breakdown_source_classes": (lambda t: t.plain_canonical, ("derived_source_class",), OUTPUT_LAYER + "SELECT * FROM canon"),
    "breakdown_merge_status": (lambda t: t.identity_map, ("merge_status", "map_status"), IDENTITY_LAYER + "SELECT * FROM cmap"),
    "breakdown_institution_basis": (lambda t: t.institution_map, ("canonicalisation_basis", "institution_country"), INSTITUTION_LAYER + "SELECT * FROM imap"),
    "breakdown_lookup_types": (lambda t: flatten.crossref(t.lookups_raw), ("crossref_type", "has_license"), FLAT["flat_lookups"]),
    "breakdown_lookup_status": (lambda t: t.lookups_raw, ("response_status",), ctes("lookups_raw") + "SELECT * FROM lookups_raw"),
    "breakdown_sightings": (lambda t: t.harvest_log, ("run_id", "status"), SIGHTINGS + "SELECT * FROM harvest_log"),
    "breakdown_scope_reasons": (lambda t: outputs.scope_delta(t.plain_tags), ("scope_reason",), OUTPUT_LAYER + "SELECT * FROM delta"),
}


def _counted(rows, by):
    return lambda t: reports.breakdown(rows(t), *by)


#: Breakdowns of whole layers in one scan: rows, their sets of columns, SQL of the rows.
LAYERS = {
    "breakdowns_of_outputs": (
        lambda t: t.plain_tags.withColumn("has_doi", F.col("doi").isNotNull() & (F.col("doi") != "")),
        {
            "all": (), "family_and_class": ("broad_output_family", "derived_output_class"), "work_type": ("work_type",), "lookup_type": ("type_crossref",),
            "source_type": ("source_type",), "year": ("publication_year",), "year_and_family": ("publication_year", "broad_output_family"), "doi": ("has_doi",), "open_access": ("is_oa",),
        },
        OUTPUT_LAYER + "SELECT *, doi IS NOT NULL AND doi <> '' AS has_doi FROM tags",
    ),
    "breakdowns_of_institutions": (
        lambda t: t.institution_map.withColumn("cited_by_count", F.col("works")),
        {"all": (), "basis": ("canonicalisation_basis",), "country": ("canonical_country",), "basis_and_country": ("canonicalisation_basis", "institution_country"), "type": ("institution_type",)},
        INSTITUTION_LAYER + "SELECT *, works AS cited_by_count FROM imap",
    ),
}


def _layer(rows, sets):
    return lambda t: reports.breakdowns(rows(t), sets, F.count("*").alias("n"), F.sum(F.coalesce("cited_by_count", F.lit(0))).alias("total"))


def _union(sets, sql) -> str:
    """The same as one plain GROUP BY a breakdown."""
    columns = list(dict.fromkeys(c for by in sets.values() for c in by))
    each = [f"SELECT '{name}' AS breakdown, {', '.join(c if c in by else f'NULL AS {c}' for c in columns)}, count(*) AS n, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS total FROM layer {'GROUP BY ' + ', '.join(by) if by else ''}" for name, by in sets.items()]
    return f"WITH layer AS ({sql}) " + " UNION ALL ".join(each)


PLANS = {name: _layer(rows, sets) for name, (rows, sets, _) in LAYERS.items()} | {name: _counted(rows, by) for name, (rows, by, _) in BREAKDOWNS.items()} | {
    "institution_places": _places,
    "top_canonical_sources": lambda t: reports.top_rows(outputs.source_metrics(t.plain_tags).select("source_key", "works", "citations"), [F.desc("works"), F.desc("citations"), F.asc("source_key")], 50),
    "top_institutions": lambda t: reports.top_rows(institutions.canonical(t.institution_map).select("canonical_institution_id", "canonical_name", "variant_works"), [F.desc("variant_works"), F.asc("canonical_institution_id")], 30),
    "top_keywords": lambda t: reports.top_rows(flatten.keywords(t.works_parsed).groupBy("keyword_id").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("keyword_id")], 20),
}

ORACLES = {name: _union(sets, sql) for name, (_, sets, sql) in LAYERS.items()} | {name: f"SELECT {', '.join(by)}, count(*) AS n FROM ({sql}) GROUP BY ALL" for name, (_, by, sql) in BREAKDOWNS.items()} | {
    "institution_places": f"""SELECT canonical_institution_id, canonical_name, canonical_ror, o.name AS ror_name, status AS ror_status, established, ror_names, aliases, city, country_code, lat, lng, external_ids, 0 AS relationships, o.name IS NOT NULL AS has_ror_match
        FROM ({INSTITUTION_LAYER}SELECT * FROM canon) c LEFT JOIN ({FLAT['flat_organisations']}) o ON canonical_ror = o.ror_id
        LEFT JOIN (SELECT ror_id, string_agg(DISTINCT name, '; ' ORDER BY name) AS ror_names FROM ({FLAT['flat_organisation_names']}) GROUP BY 1) n ON canonical_ror = n.ror_id
        LEFT JOIN (SELECT ror_id, string_agg(DISTINCT value, '; ' ORDER BY value) AS aliases FROM ({FLAT['flat_organisation_aliases']}) GROUP BY 1) a ON canonical_ror = a.ror_id
        LEFT JOIN (SELECT ror_id, min(city) AS city, min(country_code) AS country_code, avg(lat) AS lat, avg(lng) AS lng FROM ({FLAT['flat_organisation_locations']}) GROUP BY 1) l ON canonical_ror = l.ror_id
        LEFT JOIN (SELECT ror_id, string_agg(DISTINCT id_type || ':' || id_value, '; ' ORDER BY id_type || ':' || id_value) AS external_ids FROM ({FLAT['flat_organisation_ids']}) GROUP BY 1) i ON canonical_ror = i.ror_id""",
    "top_canonical_sources": OUTPUT_LAYER + "SELECT source_key, works, citations FROM metrics ORDER BY works DESC, citations DESC, source_key LIMIT 50",
    "top_institutions": INSTITUTION_LAYER + "SELECT canonical_institution_id, canonical_name, variant_works FROM canon ORDER BY variant_works DESC, canonical_institution_id LIMIT 30",
    "top_keywords": f"SELECT keyword_id, count(*) AS n FROM ({FLAT['flat_work_keywords']}) GROUP BY 1 ORDER BY n DESC, keyword_id LIMIT 20",
}
