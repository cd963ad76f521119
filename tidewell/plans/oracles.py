"""DuckDB SQL that the registered queries must equal, written independently of the plans."""

from __future__ import annotations

from tidewell.plans.views import ctes

_AUTHOR = ctes("works_flat", "work_sources", "authorships", "curated_topics", "work_topics", "researcher_institutions") + """,
rw AS (SELECT author_id, author_name, orcid, a.work_id, author_order, is_corresponding, is_au_nz_affiliated, publication_year, work_type, cited_by_count
       FROM authorships a JOIN works_flat w ON a.work_id = w.work_id WHERE author_id IS NOT NULL),
authors AS (SELECT author_id, min(author_name) AS author_name, min(nullif(orcid, '')) AS orcid, count(DISTINCT work_id) AS works, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS citations,
       min(publication_year) AS first_year, max(publication_year) AS last_year, count(DISTINCT work_id) FILTER (WHERE is_corresponding) AS corresponding_works,
       CAST(sum(CASE WHEN author_order = 1 THEN 1 ELSE 0 END) AS BIGINT) AS first_author_works, bool_or(is_au_nz_affiliated) AS is_au_nz_affiliated FROM rw GROUP BY author_id),
rt AS (SELECT author_id, author_name, t.topic_id, t.topic_name, c.education_relevance_tier, count(DISTINCT rw.work_id) AS works, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS citations, round(max(topic_score), 6) AS best_score
       FROM rw JOIN work_topics t ON rw.work_id = t.work_id LEFT JOIN curated_topics c ON replace(t.topic_id, 'https://topics.example.org/', '') = c.topic_id GROUP BY ALL),
ts AS (SELECT author_id, count(DISTINCT topic_id) AS topics, count(DISTINCT topic_id) FILTER (WHERE education_relevance_tier = 'core') AS core_topics, count(DISTINCT topic_id) FILTER (WHERE education_relevance_tier = 'adjacent') AS adjacent_topics,
       CAST(coalesce(sum(works) FILTER (WHERE education_relevance_tier = 'core'), 0) AS BIGINT) AS core_work_links, CAST(coalesce(sum(works) FILTER (WHERE education_relevance_tier = 'adjacent'), 0) AS BIGINT) AS adjacent_work_links,
       string_agg(DISTINCT topic_name, '; ' ORDER BY topic_name) FILTER (WHERE education_relevance_tier = 'core') AS core_topic_names FROM rt GROUP BY author_id),
tt AS (SELECT author_id, string_agg(topic_name || ' (' || works || ')', '; ' ORDER BY rn) AS top_topics
       FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY works DESC, citations DESC, topic_id, author_name NULLS LAST) AS rn FROM rt) WHERE rn <= 10 GROUP BY author_id),
ic AS (SELECT author_id, institution_id, institution_name, coalesce(institution_ror, '') AS institution_ror, institution_country, count(DISTINCT work_id) AS works FROM researcher_institutions WHERE institution_country IN ('AU', 'NZ') GROUP BY ALL),
mi AS (SELECT author_id, institution_id AS main_institution_id, institution_name AS main_institution_name, institution_ror AS main_ror, institution_country AS main_country
       FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY works DESC, institution_name NULLS LAST, institution_id) AS rn FROM ic) WHERE rn = 1),
isum AS (SELECT author_id, count(DISTINCT institution_id) AS institutions, string_agg(DISTINCT institution_name, '; ' ORDER BY institution_name) AS institution_names, string_agg(DISTINCT institution_ror, '; ' ORDER BY institution_ror) AS rors FROM ic GROUP BY author_id),
sc AS (SELECT author_id, source_name, count(DISTINCT rw.work_id) AS works FROM rw LEFT JOIN work_sources s ON rw.work_id = s.work_id WHERE source_name IS NOT NULL GROUP BY ALL),
tsrc AS (SELECT author_id, string_agg(source_name || ' (' || works || ')', '; ' ORDER BY rn) AS top_sources FROM (SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY works DESC, source_name) AS rn FROM sc) WHERE rn <= 10 GROUP BY author_id),
aw AS (SELECT work_id, author_id, min(author_name) AS name FROM authorships WHERE author_id IS NOT NULL GROUP BY ALL),
edges AS (SELECT a.author_id AS author_id_a, b.author_id AS author_id_b, arg_min(a.name, a.work_id) AS name_a, arg_min(b.name, a.work_id) AS name_b, count(*) AS shared_work_count, array_to_string(list_sort(list(a.work_id))[1:50], '; ') AS sample_work_ids
       FROM aw a JOIN aw b ON a.work_id = b.work_id AND a.author_id < b.author_id GROUP BY ALL),
cs AS (SELECT u.author_id, count(DISTINCT other) AS coauthors, count(DISTINCT other) FILTER (WHERE NOT coalesce(h.is_au_nz_affiliated, false)) AS international_coauthors, CAST(sum(shared_work_count) AS BIGINT) AS shared_works
       FROM (SELECT author_id_a AS author_id, author_id_b AS other, shared_work_count FROM edges UNION ALL SELECT author_id_b, author_id_a, shared_work_count FROM edges) u LEFT JOIN authors h ON u.other = h.author_id GROUP BY u.author_id),
pt AS (SELECT author_id, count(*) FILTER (WHERE work_type = 'article') AS articles, count(*) FILTER (WHERE work_type = 'book-chapter') AS chapters, count(*) FILTER (WHERE work_type = 'book') AS books, count(*) FILTER (WHERE work_type = 'review') AS reviews, count(*) FILTER (WHERE work_type = 'preprint') AS preprints,
       count(*) FILTER (WHERE work_type IN ('dataset', 'erratum', 'retraction', 'peer-review')) AS low_relevance, count(*) FILTER (WHERE work_type IN ('article', 'review', 'book', 'book-chapter')) AS formal_publications FROM rw GROUP BY author_id)
"""

_IDENTITY = _AUTHOR + """,
people AS (SELECT a.author_id, author_name, orcid, works, citations, main_ror, main_institution_name, top_topics,
       trim(regexp_replace(regexp_replace(lower(author_name), '[^\\p{L}\\p{N}_\\s\\-'']', ' ', 'g'), '\\s+', ' ', 'g')) AS nk,
       nullif(regexp_replace(trim(regexp_replace(regexp_replace(replace(lower(coalesce(main_institution_name, '')), '&', ' and '), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')), '^the ', ''), '') AS inst
       FROM authors a LEFT JOIN mi ON a.author_id = mi.author_id LEFT JOIN tt ON a.author_id = tt.author_id),
keyed AS (SELECT *, CASE WHEN len(string_split(nk, ' ')) > 1 THEN string_split(nk, ' ')[-1] || '|' || array_to_string([x[1] FOR x IN string_split(nk, ' ')[1:-2]], '') END AS ik,
       list_distinct([x FOR x IN [trim(string_split(y, ' (')[1]) FOR y IN string_split(coalesce(top_topics, ''), ';')] IF x <> '']) AS topics FROM people),
nb AS (SELECT *, count(*) OVER (PARTITION BY nk) AS n FROM keyed WHERE nk <> ''), ib AS (SELECT *, count(*) OVER (PARTITION BY ik) AS n FROM keyed WHERE ik <> ''),
blocks AS (SELECT a.author_id AS a, b.author_id AS b, 30 AS s, 'same_normalised_name' AS t FROM nb a JOIN nb b ON a.nk = b.nk AND a.author_id < b.author_id WHERE a.n BETWEEN 2 AND 50
       UNION ALL SELECT a.author_id, b.author_id, 10, 'same_surname_initials' FROM ib a JOIN ib b ON a.ik = b.ik AND a.author_id < b.author_id WHERE a.n BETWEEN 2 AND 20),
cand AS (SELECT a, b, sum(s) AS s, list(DISTINCT t) AS ts FROM blocks GROUP BY ALL),
ev AS (SELECT c.a, c.b, c.s, c.ts, coalesce(x.orcid = y.orcid, false) AS same_o, coalesce(x.orcid <> y.orcid, false) AS diff_o, coalesce(nullif(x.main_ror, '') = nullif(y.main_ror, ''), false) AS same_r, coalesce(x.inst = y.inst, false) AS same_i,
       len(list_intersect(x.topics, y.topics)) AS ov, coalesce(e.shared_work_count, 0) AS sw, x.works <= 1 OR y.works <= 1 AS tiny
       FROM cand c JOIN keyed x ON c.a = x.author_id JOIN keyed y ON c.b = y.author_id LEFT JOIN edges e ON c.a = e.author_id_a AND c.b = e.author_id_b),
scored AS (SELECT a AS author_id_a, b AS author_id_b, same_o, diff_o,
       CAST(s + 100 * same_o::INT - 100 * diff_o::INT + CASE WHEN same_r THEN 30 WHEN same_i THEN 20 ELSE 0 END + CASE WHEN ov >= 3 THEN 20 WHEN ov >= 1 THEN 8 ELSE 0 END + CASE WHEN sw >= 3 THEN 60 WHEN sw >= 1 THEN 30 ELSE 0 END + CASE WHEN tiny THEN 10 ELSE 0 END AS INT) AS score,
       array_to_string(list_sort(list_distinct(list_filter(ts || [CASE WHEN same_o THEN 'same_orcid' END, CASE WHEN diff_o THEN 'different_orcid' END, CASE WHEN same_r THEN 'same_main_ror' WHEN same_i THEN 'same_main_institution_name' END,
         CASE WHEN ov >= 3 THEN 'topic_overlap_3plus' WHEN ov >= 1 THEN 'topic_overlap' END, CASE WHEN sw >= 3 THEN 'shared_works_3plus' WHEN sw >= 1 THEN 'shared_work' END, CASE WHEN tiny THEN 'one_profile_tiny' END], lambda q: q IS NOT NULL))), '; ') AS evidence FROM ev),
pairs AS (SELECT author_id_a, author_id_b, score, CASE WHEN diff_o THEN 'reject_or_review' WHEN same_o THEN 'very_high' WHEN score >= 90 THEN 'high' WHEN score >= 60 THEN 'medium' WHEN score >= 35 THEN 'low' ELSE 'very_low' END AS confidence, evidence
       FROM scored WHERE diff_o OR same_o OR score >= 35),
vh AS (SELECT author_id_a AS a, author_id_b AS b FROM pairs WHERE confidence = 'very_high' UNION SELECT author_id_b, author_id_a FROM pairs WHERE confidence = 'very_high')
"""
_IDENTITY = _IDENTITY.replace("WITH ", "WITH RECURSIVE ", 1)
_MAP = _IDENTITY + """,
reach(n, m) AS (SELECT author_id, author_id FROM authors UNION SELECT r.n, vh.b FROM reach r JOIN vh ON r.m = vh.a),
comp AS (SELECT n AS author_id, min(m) AS component FROM reach GROUP BY n),
strong AS (SELECT component, arg_max(a.author_id, (a.works, a.citations, CAST(orcid IS NOT NULL AS INT), a.author_id)) AS best, count(*) AS members FROM comp JOIN authors a ON comp.author_id = a.author_id GROUP BY component),
numbered AS (SELECT *, row_number() OVER (ORDER BY component) AS rn FROM strong),
cmap AS (SELECT c.author_id, 'CR' || lpad(CAST(rn AS VARCHAR), 8, '0') AS canonical_id, best AS canonical_author_id, members AS member_count, CASE WHEN members > 1 THEN 'auto_merged_very_high' ELSE 'singleton' END AS merge_status,
       CASE WHEN c.author_id = best THEN 'canonical_self' ELSE 'mapped_to_canonical' END AS map_status FROM comp c JOIN numbered n ON c.component = n.component)
"""

_INST = _AUTHOR + """,
variants AS (SELECT institution_id, institution_name, institution_ror, institution_country, institution_type, count(DISTINCT work_id) AS works, coalesce('ROR:' || nullif(institution_ror, ''), 'OA:' || institution_id) AS gk FROM researcher_institutions GROUP BY ALL),
chosen AS (SELECT gk, institution_name AS canonical_name, nullif(institution_ror, '') AS canonical_ror, institution_country AS canonical_country, 'CI' || lpad(CAST(row_number() OVER (ORDER BY gk) AS VARCHAR), 8, '0') AS canonical_institution_id FROM (
       SELECT *, row_number() OVER (PARTITION BY gk ORDER BY works DESC, CASE WHEN nullif(institution_ror, '') IS NOT NULL THEN 1 ELSE 0 END DESC, length(institution_name) DESC, institution_name NULLS LAST, institution_id NULLS LAST, institution_country NULLS LAST) AS rn FROM variants) WHERE rn = 1),
imap AS (SELECT canonical_institution_id, canonical_name, canonical_ror, canonical_country, institution_id, institution_name, institution_ror, institution_country, institution_type, works, CASE WHEN nullif(institution_ror, '') IS NOT NULL THEN 'ror' ELSE 'openalex_id' END AS canonicalisation_basis,
       regexp_replace(trim(regexp_replace(regexp_replace(replace(lower(institution_name), '&', ' and '), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')), '^the ', '') AS normalised_name FROM variants v JOIN chosen c ON v.gk = c.gk),
canon AS (SELECT canonical_institution_id, min(canonical_name) AS canonical_name, min(canonical_ror) AS canonical_ror, min(canonical_country) AS canonical_country, count(*) AS variants, CAST(sum(works) AS BIGINT) AS variant_works, string_agg(DISTINCT institution_name, '; ' ORDER BY institution_name) AS name_variants, string_agg(DISTINCT institution_id, '; ' ORDER BY institution_id) AS source_ids FROM imap GROUP BY 1),
links AS (SELECT DISTINCT author_id, canonical_institution_id, work_id FROM researcher_institutions r JOIN imap m ON r.institution_id = m.institution_id AND coalesce(r.institution_ror, '') = coalesce(m.institution_ror, '') AND coalesce(r.institution_name, '') = coalesce(m.institution_name, ''))
"""

_ROR = _INST.replace("WITH ", "WITH " + ctes("ror_raw").removeprefix("WITH ") + ",\n", 1) + """,
sup AS (SELECT s_suppkey AS k, 'R' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS VARCHAR) AS ror_id, s_nationkey AS n FROM supplier WHERE s_suppkey % 2 = 0),
rel AS (SELECT ror_id, 'R' || CAST(CAST(floor(k / 4) AS BIGINT) AS VARCHAR) AS related_ror_id, 'Up' AS label, 'parent' AS relationship_type FROM sup UNION ALL SELECT ror_id, 'R' || CAST(CAST(floor(k / 2) AS BIGINT) + 1 AS VARCHAR), 'Side', 'related' FROM sup)
"""

_OUT = ctes("works_flat", "work_sources", "journal_registry_seed", "authorships") + """,
keyed AS (SELECT *, coalesce(nullif(source_id, ''), 'ISSNL:' || nullif(issn_l, ''), 'NAME:' || regexp_replace(lower(trim(source_name)), '[^a-z0-9]+', '', 'g'), 'MISSING_SOURCE') AS source_key FROM work_sources),
src AS (SELECT source_key, min(source_name) AS source_name, min(source_type) AS source_type, min(publisher) AS publisher, count(DISTINCT work_id) AS works, string_agg(DISTINCT source_name, '; ' ORDER BY source_name) AS name_variants, nullif(string_agg(DISTINCT issn, '; ' ORDER BY issn), '') AS issn_variants FROM keyed GROUP BY source_key),
canon AS (SELECT *, 'CS' || lpad(CAST(row_number() OVER (ORDER BY source_key) AS VARCHAR), 8, '0') AS canonical_source_id,
       CASE WHEN source_name IS NULL THEN 'missing_source' WHEN source_type = 'journal' THEN 'scholarly_journal' WHEN source_type = 'repository' THEN 'repository_or_preprint_platform' WHEN source_type = 'ebook platform' THEN 'ebook_platform' WHEN source_type = 'book series' THEN 'book_series' WHEN lower(source_name) LIKE '%proceeding%' OR lower(source_name) LIKE '%conference%' THEN 'conference_or_proceedings' ELSE 'other_source' END AS derived_source_class,
       coalesce(source_type = 'journal', false) AS is_journal_like, coalesce(source_type = 'repository', false) AS is_repository_like, coalesce(source_type IN ('ebook platform', 'book series'), false) AS is_book_like, source_name IS NULL AS is_missing_source FROM src),
joined AS (SELECT w.*, k.source_name, k.source_type, k.issn_l, k.issn, k.is_oa, coalesce(k.source_key, 'MISSING_SOURCE') AS source_key FROM works_flat w LEFT JOIN keyed k ON w.work_id = k.work_id),
tags AS (SELECT j.*, canonical_source_id,
       coalesce(work_type IN ('article', 'review') AND j.source_type = 'journal', false) AS is_journal_article_like, coalesce(work_type = 'article' AND j.source_type = 'journal', false) AS is_standard_journal_article, coalesce(work_type = 'review' AND j.source_type = 'journal', false) AS is_review_article,
       coalesce(work_type IN ('article', 'review') AND j.source_type = 'journal', false) AS is_peer_review_likely, coalesce(j.source_type = 'repository', false) OR work_type = 'preprint' AS is_repository_or_preprint_like,
       work_type IN ('book', 'book-chapter') OR coalesce(j.source_type IN ('ebook platform', 'book series'), false) AS is_book_or_chapter_like, work_type IN ('report', 'dissertation') OR coalesce(j.source_type = 'repository', false) OR j.source_name IS NULL AS is_grey_literature_likely,
       work_type = 'dataset' AS is_data_output, j.source_name IS NULL AS is_missing_source,
       CASE WHEN j.source_name IS NULL THEN 'missing_source' WHEN work_type = 'preprint' THEN 'preprint' WHEN work_type = 'dataset' THEN 'dataset' WHEN work_type = 'dissertation' THEN 'dissertation' WHEN work_type = 'book' THEN 'book' WHEN work_type = 'book-chapter' THEN 'book_chapter'
            WHEN work_type = 'review' AND j.source_type = 'journal' THEN 'journal_review_article' WHEN work_type = 'article' AND j.source_type = 'journal' THEN 'journal_article' WHEN work_type = 'article' AND j.source_type = 'repository' THEN 'repository_article_or_preprint_record' WHEN work_type = 'review' AND j.source_type = 'repository' THEN 'repository_review_or_preprint_record'
            WHEN work_type IN ('editorial', 'letter') THEN 'editorial_or_letter' WHEN work_type = 'report' THEN 'report' WHEN work_type = 'peer-review' THEN 'peer_review_record' WHEN j.source_type = 'ebook platform' THEN 'ebook_platform_record' WHEN j.source_type = 'book series' THEN 'book_series_record'
            WHEN lower(j.source_name) LIKE '%proceeding%' OR lower(j.source_name) LIKE '%conference%' OR lower(type_crossref) LIKE '%proceeding%' THEN 'conference_output' ELSE 'other_output' END AS derived_output_class,
       CASE WHEN work_type IN ('article', 'review') AND j.source_type = 'journal' THEN 'core_scholarly' WHEN work_type IN ('book', 'book-chapter') OR j.source_type IN ('ebook platform', 'book series') THEN 'book_based_scholarly' WHEN j.source_type = 'repository' OR work_type IN ('preprint', 'dataset') THEN 'repository_or_open_output'
            WHEN work_type IN ('report', 'dissertation') THEN 'grey_literature' WHEN work_type IN ('editorial', 'letter', 'peer-review', 'erratum', 'paratext', 'retraction') THEN 'scholarly_service_or_minor_output' WHEN j.source_name IS NULL THEN 'source_missing' ELSE 'other' END AS broad_output_family
       FROM joined j LEFT JOIN canon c ON j.source_key = c.source_key),
metrics AS (SELECT canonical_source_id, source_key, count(DISTINCT work_id) AS works, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS citations, round(avg(cited_by_count), 6) AS mean_citations, median(cited_by_count) AS median_citations, max(cited_by_count) AS max_citations, min(publication_year) AS first_year, max(publication_year) AS last_year,
       count(*) FILTER (WHERE is_journal_article_like) AS journal_articles, count(*) FILTER (WHERE is_grey_literature_likely) AS grey_literature, count(*) FILTER (WHERE is_oa) AS open_access, string_agg(DISTINCT derived_output_class, '; ' ORDER BY derived_output_class) AS output_classes FROM tags GROUP BY ALL),
dois AS (SELECT *, regexp_replace(trim(doi), '^https?://(dx\\.)?doi\\.org/', '', 'i') AS stripped, lower(regexp_replace(regexp_replace(trim(doi), '^https?://(dx\\.)?doi\\.org/', '', 'i'), '^doi:', '', 'i')) AS normal FROM tags WHERE doi IS NOT NULL AND trim(doi) <> ''),
delta AS (SELECT normal AS doi_clean, work_id, publication_year, CASE broad_output_family WHEN 'core_scholarly' THEN 'crossref_delta_core_scholarly' WHEN 'book_based_scholarly' THEN 'crossref_delta_book_based_scholarly' WHEN 'repository_or_open_output' THEN 'crossref_delta_repository_or_open_output' WHEN 'grey_literature' THEN 'crossref_delta_grey_literature' WHEN 'scholarly_service_or_minor_output' THEN 'crossref_delta_minor_or_service_output' ELSE CASE WHEN is_missing_source THEN 'crossref_delta_missing_source' ELSE 'crossref_delta_other' END END AS scope_reason
       FROM dois QUALIFY row_number() OVER (PARTITION BY normal ORDER BY CAST(broad_output_family = 'core_scholarly' AS INT) DESC, CAST(is_missing_source AS INT) DESC, publication_year DESC NULLS LAST, work_id) = 1),
reg AS (SELECT registry_id, title, nullif(trim(issn_print), '') AS issn_print, nullif(trim(issn_online), '') AS issn_online, country, priority_band, CASE WHEN lower(trim(active)) IN ('true', 'yes', '1', 'active') THEN true WHEN lower(trim(active)) IN ('false', 'no', '0', 'inactive') THEN false END AS is_active, regexp_replace(lower(trim(title)), '[^a-z0-9]+', '', 'g') AS title_key FROM journal_registry_seed),
ids AS (SELECT registry_id, 'print' AS kind, issn_print AS issn FROM reg WHERE issn_print IS NOT NULL UNION ALL SELECT registry_id, 'online', issn_online FROM reg WHERE issn_online IS NOT NULL),
wi AS (SELECT DISTINCT work_id, source_name, publication_year, is_journal_article_like, unnest(list_distinct(string_split(coalesce(issn, ''), '; ') || CASE WHEN issn_l IS NULL THEN [] ELSE [issn_l] END)) AS issn FROM tags),
met AS (SELECT DISTINCT registry_id, work_id, source_name, publication_year, is_journal_article_like FROM ids JOIN wi ON ids.issn = wi.issn WHERE wi.issn <> ''),
cov AS (SELECT r.*, coalesce(works, 0) AS works, coalesce(journal_articles, 0) AS journal_articles, first_year, last_year, matched_names FROM reg r LEFT JOIN (
       SELECT registry_id, count(DISTINCT work_id) AS works, count(DISTINCT work_id) FILTER (WHERE is_journal_article_like) AS journal_articles, min(publication_year) AS first_year, max(publication_year) AS last_year, string_agg(DISTINCT source_name, '; ' ORDER BY source_name) AS matched_names FROM met GROUP BY 1) m ON r.registry_id = m.registry_id)
"""

_LOG = ctes("harvest_log")

_GROUPS = """, e AS (SELECT author_id_a AS a, author_id_b AS b FROM pairs WHERE confidence IN ('very_high', 'high', 'medium')), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    met(n, m) AS (SELECT DISTINCT a, a FROM s UNION SELECT r.n, s.b FROM met r JOIN s ON r.m = s.a), part AS (SELECT n AS author_id, min(m) AS component FROM met GROUP BY n),
    grp AS (SELECT author_id, 'ICG' || lpad(CAST(dense_rank() OVER (ORDER BY component) AS VARCHAR), 7, '0') AS candidate_group_id, count(*) OVER (PARTITION BY component) AS group_size FROM part)"""

ORACLES = {
    "researcher_works": _AUTHOR + "SELECT * FROM rw",
    "researchers_raw": _AUTHOR + "SELECT * FROM authors",
    "researcher_topics": _AUTHOR + "SELECT * FROM rt",
    "topic_summary": _AUTHOR + "SELECT * FROM ts",
    "top_topics": _AUTHOR + "SELECT * FROM tt",
    "main_institution": _AUTHOR + "SELECT * FROM mi",
    "institution_summary": _AUTHOR + "SELECT * FROM isum",
    "top_sources": _AUTHOR + "SELECT * FROM tsrc",
    "coauthor_edges": _AUTHOR + "SELECT * FROM edges",
    "coauthor_summary": _AUTHOR + "SELECT * FROM cs",
    "publication_type_summary": _AUTHOR + "SELECT * FROM pt",
    "candidate_researchers": _AUTHOR + """SELECT a.author_id, author_name, orcid, a.works, a.citations, first_year, last_year, coalesce(core_topics, 0) AS core_topics, coalesce(adjacent_topics, 0) AS adjacent_topics, top_topics, main_institution_id, main_institution_name, main_ror, main_country, institution_names, top_sources,
        coalesce(coauthors, 0) AS coauthors, coalesce(international_coauthors, 0) AS international_coauthors, coalesce(articles, 0) AS articles, coalesce(formal_publications, 0) AS formal_publications, coalesce(regexp_matches(author_name, '^[A-Z]\\.? [A-Za-z]'), false) AS possible_initials_name,
        CASE WHEN a.works >= 10 THEN 'substantial' WHEN a.works >= 3 THEN 'moderate' ELSE 'small' END AS corpus_presence_level,
        CASE WHEN coalesce(core_topics, 0) > 0 AND coalesce(adjacent_topics, 0) > 0 THEN 'core_and_adjacent' WHEN coalesce(core_topics, 0) > 0 THEN 'core_only' WHEN coalesce(adjacent_topics, 0) > 0 THEN 'adjacent_only' ELSE 'unclassified' END AS education_topic_profile
        FROM authors a LEFT JOIN ts ON a.author_id = ts.author_id LEFT JOIN tt ON a.author_id = tt.author_id LEFT JOIN mi ON a.author_id = mi.author_id LEFT JOIN isum ON a.author_id = isum.author_id LEFT JOIN tsrc ON a.author_id = tsrc.author_id LEFT JOIN cs ON a.author_id = cs.author_id LEFT JOIN pt ON a.author_id = pt.author_id WHERE is_au_nz_affiliated""",
    "identity_pairs": _IDENTITY + "SELECT * FROM pairs",
    "identity_dropped_blocks": _IDENTITY + """SELECT 'same_normalised_name' AS basis, nk AS block_key, count(*) AS members FROM keyed WHERE nk <> '' GROUP BY nk HAVING count(*) > 50
        UNION ALL SELECT 'same_surname_initials', ik, count(*) FROM keyed WHERE ik <> '' GROUP BY ik HAVING count(*) > 20""",
    "identity_confidence_counts": _IDENTITY + "SELECT confidence, count(*) AS n FROM pairs GROUP BY 1",
    "identity_components": _IDENTITY + """, e AS (SELECT author_id_a AS a, author_id_b AS b FROM pairs WHERE confidence IN ('very_high', 'high', 'medium')), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
        reach(n, m) AS (SELECT DISTINCT a, a FROM s UNION SELECT r.n, s.b FROM reach r JOIN s ON r.m = s.a) SELECT n AS author_id, min(m) AS component FROM reach GROUP BY n""",
    "canonical_researchers": _MAP + "SELECT * FROM cmap",
    "canonical_metrics": _MAP + """,
        w AS (SELECT DISTINCT canonical_id, rw.author_id, work_id, work_type, publication_year, cited_by_count, is_au_nz_affiliated FROM rw JOIN cmap ON rw.author_id = cmap.author_id),
        b AS (SELECT canonical_id, count(DISTINCT author_id) AS source_authors, count(DISTINCT work_id) AS works, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS citations, min(publication_year) AS first_year, max(publication_year) AS last_year,
              count(DISTINCT publication_year) AS active_years, count(*) FILTER (WHERE is_au_nz_affiliated) AS au_nz_affiliated_authorships, count(*) FILTER (WHERE work_type = 'article') AS articles, count(*) FILTER (WHERE work_type = 'review') AS reviews,
              count(*) FILTER (WHERE work_type = 'book') AS books, count(*) FILTER (WHERE work_type = 'book-chapter') AS chapters, count(*) FILTER (WHERE work_type = 'preprint') AS preprints,
              count(*) FILTER (WHERE work_type IN ('dataset', 'erratum', 'retraction', 'peer-review')) AS low_relevance, count(*) FILTER (WHERE work_type IN ('article', 'review', 'book', 'book-chapter')) AS formal_publications FROM w GROUP BY 1),
        t AS (SELECT canonical_id, count(DISTINCT topic_id) FILTER (WHERE education_relevance_tier = 'core') AS c, count(DISTINCT topic_id) FILTER (WHERE education_relevance_tier = 'adjacent') AS d,
              CAST(sum(works) FILTER (WHERE education_relevance_tier = 'core') AS BIGINT) AS cl, CAST(sum(works) FILTER (WHERE education_relevance_tier = 'adjacent') AS BIGINT) AS dl FROM rt JOIN cmap ON rt.author_id = cmap.author_id GROUP BY 1),
        hc AS (SELECT canonical_id, institution_id, institution_name, coalesce(institution_ror, '') AS ror, institution_country, count(DISTINCT work_id) AS works FROM researcher_institutions h JOIN cmap ON h.author_id = cmap.author_id WHERE institution_country IN ('AU', 'NZ') GROUP BY ALL),
        hm AS (SELECT canonical_id, institution_id AS main_institution_id, institution_name AS main_institution_name, ror AS main_ror, institution_country AS main_country FROM hc
               QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY works DESC, institution_name NULLS LAST, institution_id) = 1),
        hs AS (SELECT canonical_id, string_agg(DISTINCT institution_name, '; ' ORDER BY institution_name) AS institution_variants, string_agg(DISTINCT nullif(ror, ''), '; ' ORDER BY nullif(ror, '')) AS rors,
               string_agg(DISTINCT institution_country, '; ' ORDER BY institution_country) AS countries FROM hc GROUP BY 1)
        SELECT b.*, m.canonical_author_id, a.author_name AS canonical_name, a.orcid AS canonical_orcid, m.merge_status, CASE WHEN m.member_count > 1 THEN 'very_high' ELSE 'none' END AS merge_confidence,
               coalesce(c, 0) AS core_topics, coalesce(d, 0) AS adjacent_topics, coalesce(cl, 0) AS core_topic_work_links, coalesce(dl, 0) AS adjacent_topic_work_links,
               main_institution_id, main_institution_name, main_ror, main_country, institution_variants, rors, countries,
               CASE WHEN coalesce(cl, 0) > 0 AND coalesce(dl, 0) > 0 THEN 'core_and_adjacent' WHEN coalesce(cl, 0) > 0 THEN 'core_only' WHEN coalesce(dl, 0) > 0 THEN 'adjacent_only' ELSE 'unclassified' END AS education_topic_profile
        FROM b JOIN (SELECT DISTINCT canonical_id, canonical_author_id, merge_status, member_count FROM cmap) m ON b.canonical_id = m.canonical_id JOIN authors a ON m.canonical_author_id = a.author_id
        LEFT JOIN t ON b.canonical_id = t.canonical_id LEFT JOIN hm ON b.canonical_id = hm.canonical_id LEFT JOIN hs ON b.canonical_id = hs.canonical_id""",
    "institution_identity_map": _INST + "SELECT * FROM imap",
    "canonical_institutions": _INST + "SELECT * FROM canon",
    "canonical_researcher_institutions": _INST + "SELECT * FROM links",
    "institution_metrics": _INST + """, lw AS (SELECT l.canonical_institution_id, l.author_id, l.work_id, work_type, coalesce(cited_by_count, 0) AS cites FROM links l LEFT JOIN (SELECT DISTINCT author_id, work_id, work_type, cited_by_count FROM rw) r ON l.author_id = r.author_id AND l.work_id = r.work_id)
        SELECT c.canonical_institution_id, canonical_name, researchers, works, articles, citations FROM canon c LEFT JOIN (SELECT canonical_institution_id, count(DISTINCT author_id) AS researchers, count(DISTINCT work_id) AS works, count(DISTINCT work_id) FILTER (WHERE work_type = 'article') AS articles FROM lw GROUP BY 1) o ON c.canonical_institution_id = o.canonical_institution_id
        LEFT JOIN (SELECT canonical_institution_id, CAST(sum(cites) AS BIGINT) AS citations FROM (SELECT DISTINCT canonical_institution_id, work_id, cites FROM lw) GROUP BY 1) q ON c.canonical_institution_id = q.canonical_institution_id""",
    "institution_review_cases": _INST + "SELECT normalised_name, canonical_country, count(DISTINCT canonical_institution_id) AS institutions, string_agg(DISTINCT canonical_institution_id, '; ' ORDER BY canonical_institution_id) AS ids, CAST(sum(works) AS BIGINT) AS works FROM imap GROUP BY ALL HAVING count(DISTINCT canonical_institution_id) > 1",
    "canonical_institutions_enriched": _ROR + """SELECT canonical_institution_id, canonical_name, canonical_ror, 'Org ' || substr(ror_id, 2) AS ror_name, CASE WHEN k % 6 = 0 THEN 'inactive' WHEN k IS NOT NULL THEN 'active' END AS ror_status, CASE WHEN k IS NULL THEN 0 ELSE 2 END AS relationships, CASE WHEN k IS NULL THEN 0 ELSE 1 END AS parents, CASE WHEN k IS NULL THEN 0 ELSE 1 END AS related,
        CASE WHEN k IS NOT NULL THEN 'Side [related]; Up [parent]' END AS related_names, CASE WHEN k IS NOT NULL THEN 'GRID:g' || k || '; GRID:h' END AS external_ids, CASE WHEN k IS NOT NULL THEN 'http://l' || n || '; http://m' || n END AS websites, k IS NOT NULL AS has_ror_match FROM canon LEFT JOIN sup ON canonical_ror = ror_id""",
    "institution_relationships": _ROR + "SELECT a.canonical_institution_id, related_ror_id, label, relationship_type, b.canonical_institution_id AS related_institution_id FROM canon a JOIN rel ON a.canonical_ror = rel.ror_id LEFT JOIN canon b ON related_ror_id = b.canonical_ror",
    "institution_websites_cross": _ROR + "SELECT canonical_institution_id, unnest(['http://l' || n, 'http://m' || n]) AS link, d.domain FROM canon JOIN sup ON canonical_ror = ror_id, LATERAL (SELECT unnest(['d' || n || '.org', 'e.org']) AS domain) d",
    "institution_external_ids": _ROR + "SELECT canonical_institution_id, 'GRID' AS id_type, 'g' || k AS id_value, true AS is_preferred FROM canon JOIN sup ON canonical_ror = ror_id UNION ALL SELECT canonical_institution_id, 'GRID', 'h', false FROM canon JOIN sup ON canonical_ror = ror_id",
    "policy_organisations": _INST + "SELECT canonical_institution_id, canonical_name FROM canon WHERE lower(canonical_name) LIKE '%000001%' OR lower(canonical_name) LIKE '%co.%'",
    "text_cleaning_review": _OUT + "SELECT work_id, title AS before, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS after FROM works_flat WHERE title IS DISTINCT FROM trim(regexp_replace(title, '\\s+', ' ', 'g'))",
    "canonical_sources": _OUT + "SELECT * FROM canon",
    "work_output_tags": _OUT + "SELECT * FROM tags",
    "source_metrics": _OUT + "SELECT * FROM metrics",
    "output_type_metrics": _OUT + "SELECT work_type, type_crossref, source_type, derived_output_class, broad_output_family, count(DISTINCT work_id) AS works, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS citations, round(avg(cited_by_count), 6) AS mean_citations, median(cited_by_count) AS median_citations FROM tags GROUP BY ALL",
    "crossref_scope_v1": _OUT + """SELECT work_id, stripped AS doi_clean, CASE WHEN is_missing_source AND is_book_or_chapter_like THEN 'missing_source_and_book_like' WHEN is_missing_source THEN 'missing_source' WHEN is_book_or_chapter_like THEN 'book_or_chapter_like' WHEN work_type IN ('book', 'book-chapter') THEN 'book_work_type' WHEN derived_output_class IN ('book', 'book_chapter', 'ebook_platform_record', 'book_series_record') THEN 'book_output_class' ELSE 'other' END AS scope_reason
        FROM dois WHERE is_missing_source OR is_book_or_chapter_like OR work_type IN ('book', 'book-chapter') OR derived_output_class IN ('book', 'book_chapter', 'ebook_platform_record', 'book_series_record')""",
    "crossref_scope_all": _OUT + """SELECT stripped AS doi_clean, work_id, publication_year, CASE WHEN is_missing_source AND is_book_or_chapter_like THEN 'all_dois_missing_source_and_book_like' WHEN is_missing_source THEN 'all_dois_missing_source' WHEN is_book_or_chapter_like THEN 'all_dois_book_or_chapter_like' WHEN broad_output_family = 'core_scholarly' THEN 'all_dois_core_scholarly' WHEN broad_output_family = 'repository_or_open_output' THEN 'all_dois_repository_or_open_output'
        WHEN broad_output_family = 'grey_literature' THEN 'all_dois_grey_literature' WHEN broad_output_family = 'scholarly_service_or_minor_output' THEN 'all_dois_minor_or_service_output' ELSE 'all_dois_other' END AS scope_reason FROM dois QUALIFY row_number() OVER (PARTITION BY stripped ORDER BY CAST(is_missing_source AS INT) DESC, CAST(is_book_or_chapter_like AS INT) DESC, publication_year DESC NULLS LAST, work_id) = 1""",
    "crossref_scope_delta": _OUT + "SELECT * FROM delta WHERE CAST(right(doi_clean, 1) AS INT) NOT IN (0, 6)",
    "crossref_remaining": _OUT + "SELECT scope_reason, count(*) AS n FROM delta WHERE CAST(right(doi_clean, 1) AS INT) % 3 <> 0 GROUP BY 1",
    "journal_registry": _OUT + "SELECT * FROM reg",
    "registry_identifiers": _OUT + "SELECT * FROM ids",
    "registry_coverage": _OUT + "SELECT * FROM cov",
    "registry_missing": _OUT + "SELECT registry_id, title FROM cov WHERE works = 0",
    "registry_band_summary": _OUT + "SELECT country, priority_band, count(*) AS journals, count(*) FILTER (WHERE works > 0) AS covered, CAST(sum(works) AS BIGINT) AS works, count(*) FILTER (WHERE is_active) AS active FROM cov GROUP BY ALL",
    "output_class_counts": _OUT + "SELECT derived_output_class, broad_output_family, count(*) AS n, median(cited_by_count) AS median_citations FROM tags GROUP BY ALL",
    "top_sources_by_class": _OUT + "SELECT derived_source_class, CAST(rn AS INT) AS rank, source_key, source_name, works FROM (SELECT c.derived_source_class, m.source_key, c.source_name, m.works, row_number() OVER (PARTITION BY c.derived_source_class ORDER BY m.works DESC, m.source_key) AS rn FROM metrics m JOIN canon c ON m.source_key = c.source_key) WHERE rn <= 5",
    "control_char_names": _OUT + "SELECT DISTINCT source_name, source_key, hex(source_name) AS name_hex, count(*) OVER (PARTITION BY source_name) AS same_name, false AS has_control FROM tags WHERE source_name IS NOT NULL",
    "source_name_variants": _OUT + "SELECT regexp_replace(lower(trim(source_name)), '[^a-z0-9]+', '', 'g') AS name_key, count(DISTINCT source_name) AS spellings, string_agg(DISTINCT source_name, '; ' ORDER BY source_name) AS names, count(DISTINCT work_id) AS works FROM tags WHERE source_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_name) > 1",
    "researcher_output_comparison": _OUT + """, aw AS (SELECT DISTINCT author_id, work_id FROM authorships WHERE author_id IS NOT NULL), g AS (SELECT author_id, count(DISTINCT aw.work_id) AS works, count(DISTINCT aw.work_id) FILTER (WHERE broad_output_family = 'core_scholarly') AS core, count(DISTINCT aw.work_id) FILTER (WHERE broad_output_family = 'repository_or_open_output') AS repository FROM aw JOIN tags t ON aw.work_id = t.work_id GROUP BY 1)
        SELECT *, round(CAST(repository AS DOUBLE) / works, 6) AS repository_share FROM g WHERE works >= 3""",
    "repository_heavy_researchers": _OUT + """, aw AS (SELECT DISTINCT author_id, work_id FROM authorships WHERE author_id IS NOT NULL), g AS (SELECT author_id, count(DISTINCT aw.work_id) AS works, count(DISTINCT aw.work_id) FILTER (WHERE broad_output_family = 'core_scholarly') AS core, count(DISTINCT aw.work_id) FILTER (WHERE broad_output_family = 'repository_or_open_output') AS repository FROM aw JOIN tags t ON aw.work_id = t.work_id GROUP BY 1)
        SELECT *, round(CAST(repository AS DOUBLE) / works, 6) AS repository_share FROM g WHERE works >= 5 AND round(CAST(repository AS DOUBLE) / works, 6) >= 0.25""",
    "missing_source_works": _OUT + "SELECT work_id, title, doi, work_type, derived_output_class, publication_year FROM tags WHERE is_missing_source",
    "repository_sources": _OUT + "SELECT c.canonical_source_id, source_name, derived_source_class, m.works, citations, median_citations FROM canon c JOIN metrics m ON c.canonical_source_id = m.canonical_source_id WHERE is_repository_like",
    "book_sources": _OUT + "SELECT c.canonical_source_id, source_name, derived_source_class, m.works, citations, median_citations FROM canon c JOIN metrics m ON c.canonical_source_id = m.canonical_source_id WHERE is_book_like",
    "collapsed_institution_variants": _INST + "SELECT canonical_institution_id, canonical_name, canonical_country, canonical_ror, variants, variant_works, name_variants FROM canon WHERE variants > 1",
    "home_institutions": _INST + "SELECT c.canonical_institution_id, canonical_name, canonical_country, count(DISTINCT author_id) AS researchers, count(DISTINCT work_id) AS works, name_variants FROM canon c JOIN links l ON c.canonical_institution_id = l.canonical_institution_id WHERE canonical_country IN ('AU', 'NZ') GROUP BY ALL",
    "fetch_status_counts": _OUT + "SELECT CASE WHEN CAST(right(normal, 1) AS INT) % 2 = 0 THEN 200 ELSE 404 END AS response_status, count(DISTINCT normal) AS n FROM dois WHERE CAST(right(normal, 1) AS INT) % 3 = 0 GROUP BY 1",
    "snapshot_output_summary": _OUT + "SELECT broad_output_family, derived_output_class, count(*) AS works, count(*) FILTER (WHERE doi IS NOT NULL AND doi <> '') AS with_doi, count(*) FILTER (WHERE is_oa) AS open_access FROM tags GROUP BY ALL",
    "top_researchers": _AUTHOR + "SELECT author_id, author_name, works, citations FROM authors ORDER BY works DESC, citations DESC, author_id LIMIT 20",
    "snapshot_missingness": _OUT + "SELECT count(*) AS works, count(doi) AS doi_present, count(*) FILTER (WHERE doi IS NULL OR doi = '') AS doi_missing, count(*) FILTER (WHERE publication_year IS NULL) AS year_missing, count(s.issn) AS issn_present, count(*) FILTER (WHERE s.issn_l IS NULL OR s.issn_l = '') AS issn_l_missing, count(*) FILTER (WHERE s.source_id IS NULL) AS source_missing, count(DISTINCT s.source_name) AS source_names FROM works_flat w LEFT JOIN work_sources s ON w.work_id = s.work_id",
    "snapshot_by_year": _OUT + "SELECT publication_year, count(*) AS works, count(*) FILTER (WHERE is_journal_article_like) AS articles, count(*) FILTER (WHERE is_missing_source) AS missing_source, CAST(sum(coalesce(cited_by_count, 0)) AS BIGINT) AS citations FROM tags GROUP BY 1",
    "raw_source_records": _LOG + "SELECT 'raw_openalex_work_' || sha1(CAST(event_id AS VARCHAR)) AS raw_record_id, CAST(event_id AS VARCHAR) AS record_key, sha1(raw_json) AS content_hash, run_id FROM harvest_log",
    "source_work_claims": _OUT + "SELECT 'claim_openalex_work_' || sha1(work_id) AS claim_id, work_id, 'openalex' AS claim_source, title, publication_year, work_type FROM works_flat",
    "work_identifier_claims": _OUT + """, d AS (SELECT work_id, lower(regexp_replace(regexp_replace(trim(doi), '^https?://(dx\\.)?doi\\.org/', '', 'i'), '^doi:', '', 'i')) AS n FROM works_flat WHERE doi IS NOT NULL AND doi <> '')
        SELECT 'idclaim_openalex_' || sha1(work_id) AS claim_id, work_id, 'openalex' AS identifier_type, work_id AS identifier FROM works_flat UNION ALL SELECT 'idclaim_openalex_doi_' || sha1(work_id || n), work_id, 'doi', n FROM d""",
    "discovery_summary": _LOG + "SELECT run_id, status, event_id <> f AS already_present, count(*) AS sightings, count(DISTINCT record_id) AS records FROM (SELECT *, min(event_id) OVER (PARTITION BY record_id) AS f FROM harvest_log) GROUP BY ALL",
    "upsert_last_wins": _LOG + """, n AS (SELECT record_id, event_id, status, value FROM harvest_log WHERE run_id IN ('run1', 'run3') QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY event_id DESC) = 1)
        SELECT record_id, event_id, status, value FROM harvest_log WHERE run_id NOT IN ('run1', 'run3') AND record_id NOT IN (SELECT record_id FROM n) UNION ALL SELECT * FROM n""",
    "insert_ignore": _LOG + "SELECT record_id, event_id, status, value FROM harvest_log QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY event_id) = 1",
    "replace_children": _LOG + "SELECT record_id, event_id, status, value FROM harvest_log WHERE record_id NOT IN (SELECT record_id FROM harvest_log WHERE run_id = 'run1') OR (run_id = 'run1' AND event_id % 2 = 1)",
    "seen_counter_upsert": _LOG + "SELECT record_id, run_id, min(event_id) AS first_seen, max(event_id) AS latest_seen, count(*) AS seen_count FROM harvest_log GROUP BY ALL",
    "json_flatten_events": _LOG + "SELECT event_id, CAST(json_extract(raw_json, '$.k') AS INT) AS k, json_extract(raw_json, '$.missing') IS NULL AS is_missing, sha1(raw_json) AS content_hash FROM harvest_log",
}
_CANDIDATES = ORACLES["candidate_researchers"].removeprefix(_AUTHOR)
ORACLES |= {
    "identity_groups": _IDENTITY + _GROUPS + """SELECT candidate_group_id, g.author_id, author_name, orcid, works, citations, main_institution_name AS main_institution, group_size FROM grp g JOIN people p ON g.author_id = p.author_id""",
    "identity_candidate_authors": _IDENTITY + _GROUPS + ", cand_r AS (" + _CANDIDATES + ") SELECT r.*, candidate_group_id, group_size, candidate_group_id IS NOT NULL AS possible_identity_duplicate FROM cand_r r LEFT JOIN grp g ON r.author_id = g.author_id",
}
#: Layers that other modules build on.
OUTPUT_LAYER, SIGHTINGS, IDENTITY_LAYER, INSTITUTION_LAYER = _OUT, _LOG, _MAP, _INST
