"""Queries that flatten raw JSON records, and the DuckDB SQL that each must equal."""

from __future__ import annotations

from tidewell.plans.views import ctes
from tidewell.sources import flatten

PLANS = {
    "flat_works": lambda t: flatten.works(t.works_parsed),
    "flat_authorships": lambda t: flatten.authorships(t.works_parsed),
    "flat_work_topics": lambda t: flatten.topics(t.works_parsed),
    "flat_work_keywords": lambda t: flatten.keywords(t.works_parsed),
    "flat_work_funders": lambda t: flatten.funders(t.works_parsed),
    "flat_work_awards": lambda t: flatten.awards(t.works_parsed),
    "flat_work_sources": lambda t: flatten.work_sources(t.works_parsed),
    "flat_institutions": lambda t: flatten.institutions(flatten.authorships(t.works_parsed)),
    "flat_researcher_institutions": lambda t: flatten.researcher_institutions(flatten.authorships(t.works_parsed)),
    "flat_lookups": lambda t: flatten.crossref(t.lookups_raw),
    "flat_lookup_contributors": lambda t: flatten.crossref_contributors(t.lookups_raw),
    "flat_lookup_subjects": lambda t: flatten.crossref_subjects(t.lookups_raw),
    "flat_profiles": lambda t: flatten.profiles(t.profiles_raw),
    "flat_profile_keywords": lambda t: flatten.profile_keywords(t.profiles_raw),
    "flat_profile_ids": lambda t: flatten.profile_ids(t.profiles_raw),
    "flat_profile_websites": lambda t: flatten.profile_websites(t.profiles_raw),
    "flat_employments": lambda t: flatten.affiliations(t.profiles_raw),
    "flat_educations": lambda t: flatten.affiliations(t.profiles_raw, "education"),
    "flat_organisations": lambda t: flatten.organisations(t.organisations_raw),
    "flat_organisation_names": lambda t: flatten.organisation_names(t.organisations_raw),
    "flat_organisation_aliases": lambda t: flatten.organisation_lists(t.organisations_raw, "aliases"),
    "flat_organisation_acronyms": lambda t: flatten.organisation_lists(t.organisations_raw, "acronyms"),
    "flat_organisation_ids": lambda t: flatten.organisation_ids(t.organisations_raw),
    "flat_organisation_locations": lambda t: flatten.organisation_locations(t.organisations_raw),
}


def _rows(path: str, name: str, keys: str, source: str) -> str:
    """A CTE with one row an element of a JSON list, counted from 1."""
    return f"""{name} AS (SELECT {keys}, unnest(xs) AS x, generate_subscripts(xs, 1) AS n FROM (SELECT *, CAST(r->'{path}' AS JSON[]) AS xs FROM {source}))"""


_WORKS = ctes("works_raw") + """,
parsed AS (SELECT CASE WHEN json_valid(raw_json) THEN CAST(raw_json AS JSON) END AS r FROM works_raw),
w AS (SELECT r->>'$.id' AS work_id, r FROM parsed WHERE json_type(r) = 'OBJECT' AND r->>'$.id' IS NOT NULL),
""" + _rows("$.authorships", "au", "work_id", "w") + """,
insts AS (SELECT work_id, author_order, author_id, author_name, unnest(xs) AS i, generate_subscripts(xs, 1) AS k
          FROM (SELECT work_id, n AS author_order, x->>'$.author.id' AS author_id, x->>'$.author.display_name' AS author_name, CAST(x->'$.institutions' AS JSON[]) AS xs FROM au)),
named AS (SELECT * FROM insts WHERE i->>'$.id' IS NOT NULL)
"""
_LOOKUPS = ctes("lookups_raw") + """,
w AS (SELECT doi_clean, CAST(raw_json AS JSON)->'$.message' AS r FROM lookups_raw WHERE response_status = 200),
""" + _rows("$.author", "au", "doi_clean", "w") + ", " + _rows("$.editor", "ed", "doi_clean", "w") + "\n"
_PROFILES = ctes("profiles_raw") + """,
w AS (SELECT orcid, CAST(raw_json AS JSON) AS r FROM profiles_raw WHERE raw_json IS NOT NULL)
"""
_ORGANISATIONS = ctes("organisations_raw") + """,
w AS (SELECT r->>'$.id' AS ror_id, r FROM (SELECT CAST(raw_json AS JSON) AS r FROM organisations_raw))
"""


def _list(path: str) -> str:
    return f"array_to_string(CAST(r->'{path}' AS VARCHAR[]), '; ')"


def _affiliations(kind: str) -> str:
    return _PROFILES + f""", g AS (SELECT orcid, unnest(CAST(r->'$."activities-summary".{kind}s."affiliation-group"' AS JSON[])) AS g FROM w),
        s AS (SELECT orcid, unnest(CAST(g->'$.summaries' AS JSON[]))->'$."{kind}-summary"' AS s FROM g)
        SELECT orcid, s->>'$.organization.name' AS organization, s->>'$."role-title"' AS role_title, s->>'$."department-name"' AS department, s->>'$.organization.address.city' AS city,
               s->>'$.organization.address.country' AS country, s->>'$."start-date".year.value' AS start_year, s->>'$."end-date".year.value' AS end_year FROM s WHERE s IS NOT NULL"""


ORACLES = {
    "flat_works": _WORKS + """SELECT work_id, r->>'$.doi' AS doi, coalesce(r->>'$.display_name', r->>'$.title') AS title, CAST(r->>'$.publication_year' AS INT) AS publication_year, r->>'$.publication_date' AS publication_date,
        r->>'$.type' AS work_type, r->>'$.type_crossref' AS type_crossref, CAST(r->>'$.cited_by_count' AS INT) AS cited_by_count, CAST(r->>'$.fwci' AS DOUBLE) AS fwci,
        CAST(r->>'$.citation_normalized_percentile.value' AS DOUBLE) AS citation_percentile, CAST(r->>'$.citation_normalized_percentile.is_in_top_1_percent' AS BOOLEAN) AS is_in_top_1_percent,
        CAST(r->>'$.citation_normalized_percentile.is_in_top_10_percent' AS BOOLEAN) AS is_in_top_10_percent, r->>'$.language' AS language FROM w""",
    "flat_authorships": _WORKS + """, codes AS (SELECT work_id, author_order, list_sort(list(DISTINCT i->>'$.country_code')) AS codes FROM insts WHERE i->>'$.country_code' <> '' GROUP BY ALL)
        SELECT au.work_id, CAST(n AS INT) AS author_order, x->>'$.author.id' AS author_id, x->>'$.author.display_name' AS author_name, x->>'$.author.orcid' AS orcid, x->>'$.author_position' AS author_position,
               CAST(x->>'$.is_corresponding' AS BOOLEAN) AS is_corresponding, CASE WHEN json_type(x->'$.institutions') = 'ARRAY' THEN CAST(x->'$.institutions' AS VARCHAR) ELSE '[]' END AS institutions_json,
               coalesce(array_to_string(codes, '; '), '') AS countries, coalesce(list_has_any(codes, ['AU', 'NZ']), false) AS is_au_nz_affiliated
        FROM au LEFT JOIN codes c ON au.work_id = c.work_id AND au.n = c.author_order""",
    "flat_work_topics": _WORKS + ", " + _rows("$.topics", "t", "work_id", "w") + """ SELECT work_id, x->>'$.id' AS topic_id, x->>'$.display_name' AS topic_name, CAST(x->>'$.score' AS DOUBLE) AS topic_score,
        x->>'$.subfield.id' AS subfield_id, x->>'$.subfield.display_name' AS subfield_name, x->>'$.field.id' AS field_id, x->>'$.field.display_name' AS field_name, x->>'$.domain.id' AS domain_id, x->>'$.domain.display_name' AS domain_name FROM t""",
    "flat_work_keywords": _WORKS + ", " + _rows("$.keywords", "t", "work_id", "w") + " SELECT work_id, x->>'$.id' AS keyword_id, x->>'$.display_name' AS keyword, CAST(x->>'$.score' AS DOUBLE) AS score FROM t",
    "flat_work_funders": _WORKS + ", " + _rows("$.funders", "t", "work_id", "w") + " SELECT work_id, x->>'$.id' AS funder_id, x->>'$.display_name' AS funder_name FROM t",
    "flat_work_awards": _WORKS + ", " + _rows("$.awards", "t", "work_id", "w") + " SELECT work_id, x->>'$.id' AS award_id, x->>'$.funder.id' AS funder_id, x->>'$.funder.display_name' AS funder_name FROM t",
    "flat_work_sources": _WORKS + """SELECT work_id, r->>'$.primary_location.source.id' AS source_id, r->>'$.primary_location.source.display_name' AS source_name, r->>'$.primary_location.source.type' AS source_type,
        r->>'$.primary_location.source.publisher' AS publisher, r->>'$.primary_location.source.issn_l' AS issn_l, coalesce(""" + _list("$.primary_location.source.issn") + """, '') AS issn,
        r->>'$.primary_location.landing_page_url' AS landing_page_url, r->>'$.primary_location.pdf_url' AS pdf_url, CAST(r->>'$.open_access.is_oa' AS BOOLEAN) AS is_oa, r->>'$.open_access.oa_status' AS oa_status FROM w""",
    "flat_institutions": _WORKS + """SELECT i->>'$.id' AS institution_id, i->>'$.display_name' AS institution_name, i->>'$.ror' AS ror, i->>'$.country_code' AS country_code, i->>'$.type' AS type,
        coalesce(CAST(i->'$.lineage' AS VARCHAR), '[]') AS lineage_json FROM named QUALIFY row_number() OVER (PARTITION BY i->>'$.id' ORDER BY work_id, author_order, k) = 1""",
    "flat_researcher_institutions": _WORKS + """SELECT author_id, author_name, i->>'$.id' AS institution_id, i->>'$.display_name' AS institution_name, i->>'$.ror' AS institution_ror, i->>'$.country_code' AS institution_country, i->>'$.type' AS institution_type, work_id
        FROM named WHERE author_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY author_id, i->>'$.id', work_id ORDER BY author_order, k) = 1""",
    "flat_lookups": _LOOKUPS + """SELECT doi_clean, r->>'$.type' AS crossref_type, r->>'$.title[0]' AS title, r->>'$."container-title"[0]' AS container_title, r->>'$.publisher' AS publisher,
        CAST(coalesce(r->>'$."published-print"."date-parts"[0][0]', r->>'$.issued."date-parts"[0][0]') AS INT) AS year, """ + _list("$.ISSN") + " AS issn, " + _list("$.ISBN") + """ AS isbn, r->>'$.volume' AS volume, r->>'$.issue' AS issue, r->>'$.page' AS page,
        CAST(r->>'$."reference-count"' AS INT) AS reference_count, CAST(r->>'$."is-referenced-by-count"' AS INT) AS cited_by_count, CAST(coalesce(json_array_length(r->'$.author'), 0) AS INT) AS author_count, CAST(coalesce(json_array_length(r->'$.editor'), 0) AS INT) AS editor_count,
        coalesce(json_array_length(r->'$.license'), 0) > 0 AS has_license, coalesce(json_array_length(r->'$.link'), 0) > 0 AS has_link FROM w""",
    "flat_lookup_contributors": _LOOKUPS + """SELECT doi_clean, role, CAST(n AS INT) AS position, x->>'$.sequence' AS sequence, x->>'$.given' AS given, x->>'$.family' AS family, x->>'$.name' AS name, x->>'$.ORCID' AS orcid,
        coalesce(CAST(x->'$.affiliation' AS VARCHAR), '[]') AS affiliation_json FROM (SELECT *, 'author' AS role FROM au UNION ALL SELECT *, 'editor' FROM ed)""",
    "flat_lookup_subjects": _LOOKUPS + "SELECT doi_clean, unnest(CAST(r->'$.subject' AS VARCHAR[])) AS subject FROM w",
    "flat_profiles": _PROFILES + """SELECT orcid, r->>'$.person.name."given-names".value' AS given_names, r->>'$.person.name."family-name".value' AS family_name, r->>'$.person.name."credit-name".value' AS credit_name,
        r->>'$.person.biography.content' AS biography, CAST(r->>'$.history."last-modified-date".value' AS BIGINT) AS last_modified_date FROM w""",
    "flat_profile_keywords": _PROFILES + """, k AS (SELECT orcid, trim(unnest(CAST(r->'$.person.keywords.keyword' AS JSON[]))->>'$.content') AS keyword FROM w) SELECT * FROM k WHERE keyword <> ''""",
    "flat_profile_ids": _PROFILES + """, x AS (SELECT orcid, unnest(CAST(r->'$.person."external-identifiers"."external-identifier"' AS JSON[])) AS x FROM w)
        SELECT orcid, x->>'$."external-id-type"' AS id_type, x->>'$."external-id-value"' AS id_value FROM x""",
    "flat_profile_websites": _PROFILES + """, x AS (SELECT orcid, unnest(CAST(r->'$.person."researcher-urls"."researcher-url"' AS JSON[])) AS x FROM w) SELECT orcid, x->>'$."url-name"' AS name, x->>'$.url.value' AS url FROM x""",
    "flat_employments": _affiliations("employment"),
    "flat_educations": _affiliations("education"),
    "flat_organisations": _ORGANISATIONS + """SELECT ror_id, coalesce(r->>'$.name', (list_filter(CAST(r->'$.names' AS JSON[]), lambda y: list_contains(CAST(y->'$.types' AS VARCHAR[]), 'ror_display'))[1])->>'$.value') AS name, r->>'$.status' AS status,
        CAST(r->>'$.established' AS INT) AS established, CAST(r->'$.types' AS VARCHAR) AS types_json FROM w""",
    "flat_organisation_names": _ORGANISATIONS + ", " + _rows("$.names", "t", "ror_id", "w") + " SELECT ror_id, x->>'$.value' AS name, x->>'$.lang' AS lang, array_to_string(CAST(x->'$.types' AS VARCHAR[]), '; ') AS name_types FROM t",
    "flat_organisation_aliases": _ORGANISATIONS + ", " + _rows("$.aliases", "t", "ror_id", "w") + " SELECT ror_id, CASE WHEN json_type(x) = 'OBJECT' THEN x->>'$.value' ELSE x->>'$' END AS value FROM t",
    "flat_organisation_acronyms": _ORGANISATIONS + "SELECT ror_id, unnest(CAST(r->'$.acronyms' AS VARCHAR[])) AS value FROM w",
    "flat_organisation_ids": _ORGANISATIONS + """, k AS (SELECT ror_id, unnest(json_keys(r->'$.external_ids')) AS id_type, r->'$.external_ids' AS ids FROM w),
        v AS (SELECT ror_id, id_type, json_extract(ids, '$.' || id_type) AS v FROM k),
        e AS (SELECT ror_id, id_type, v, unnest(CASE json_type(v) WHEN 'OBJECT' THEN CAST(v->'$.all' AS VARCHAR[]) WHEN 'ARRAY' THEN CAST(v AS VARCHAR[]) ELSE [v->>'$'] END) AS id_value FROM v)
        SELECT ror_id, id_type, id_value, json_type(v) = 'OBJECT' AND coalesce(v->>'$.preferred' = id_value, false) AS is_preferred FROM e""",
    "flat_organisation_locations": _ORGANISATIONS + ", " + _rows("$.locations", "t", "ror_id", "w") + """ SELECT ror_id, x->>'$.geonames_id' AS geonames_id, x->>'$.geonames_details.name' AS city, x->>'$.geonames_details.region_name' AS region,
        x->>'$.geonames_details.country_code' AS country_code, x->>'$.geonames_details.country_name' AS country, CAST(x->>'$.geonames_details.lat' AS DOUBLE) AS lat, CAST(x->>'$.geonames_details.lng' AS DOUBLE) AS lng FROM t""",
}
