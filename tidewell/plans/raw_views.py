"""Raw JSON records laid over the test tables: works, DOI lookups, profiles, organisations.

Among the records are texts that aren't JSON, records without an id, nulls, missing fields, empty
lists and objects, and ids that come twice.
"""

from __future__ import annotations

import re


def _json(template: str) -> str:
    """SQL that builds the JSON text; <<...>> is an SQL expression."""
    parts = re.split(r"<<(.*?)>>", template)
    quoted = [f"'{p}'" if n % 2 == 0 else f"CAST(({p}) AS STRING)" for n, p in enumerate(parts) if p]
    return " || ".join(quoted).replace("{", "{{").replace("}", "}}")


_WORK = _json(
    '{"id":"W<<o_orderkey>>",'
    """"doi":<<CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE '"https://doi.org/10.5555/X' || CAST(o_orderkey AS STRING) || '"' END>>,"""
    """"display_name":<<CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"Shown"' END>>,"title":"Title <<o_orderkey>>","""
    '"publication_year":<<year(o_orderdate)>>,'
    """"type":"<<CASE o_orderkey % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'book' ELSE 'review' END>>","""
    '"cited_by_count":<<o_orderkey % 90>>,"fwci":<<o_orderkey % 8>>.25,'
    """<<CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '"citation_normalized_percentile":{"value":0.5,"is_in_top_1_percent":false,"is_in_top_10_percent":true},' END>>"""
    '"authorships":[{"author_position":"first","author":{"id":"A<<o_custkey>>","display_name":"Ann <<o_custkey>>","orcid":"0000-<<o_custkey % 90>>"},"is_corresponding":true,'
    '"institutions":[{"id":"I<<o_custkey % 50>>","display_name":"Inst <<o_custkey % 50>>-<<o_orderkey % 3>>","ror":"R<<o_custkey % 50>>",'
    """"country_code":"<<CASE o_custkey % 3 WHEN 0 THEN 'AU' WHEN 1 THEN 'NZ' ELSE 'US' END>>","type":"education","lineage":["I<<o_custkey % 50>>","I0"]},"""
    '{"id":"I<<o_custkey % 50>>","display_name":"Again"},{"display_name":"No id","country_code":"FJ"}]}'
    """<<CASE WHEN o_orderkey % 2 = 0 THEN ',{"author_position":"last","author":{},"institutions":null}' ELSE '' END>>"""
    """<<CASE WHEN o_orderkey % 5 = 0 THEN ',{"author_position":"last","author":{"id":"B' || CAST(o_orderkey % 77 AS STRING) || '"},"institutions":[{"id":"I' || CAST(o_orderkey % 60 AS STRING) || '","country_code":""}]}' ELSE '' END>>],"""
    '"topics":[{"id":"T<<o_orderkey % 40>>","display_name":"Topic","score":0.<<o_orderkey % 9 + 1>>,"subfield":{"id":"S","display_name":"s"},"field":null}'
    """<<CASE WHEN o_orderkey % 3 = 0 THEN ',{"id":"T99","score":null,"domain":{"id":"D"}}' ELSE '' END>>],"""
    """"keywords":[<<CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE '{"id":"k1","display_name":"K","score":0.5},{"id":"k2"}' END>>],"""
    """<<CASE WHEN o_orderkey % 4 = 1 THEN '"funders":[{"id":"F1","display_name":"Fund"}],"awards":[{"id":"G1","funder":{"id":"F1","display_name":"Fund"}},{"id":"G2","funder":null}],' ELSE '' END>>"""
    """"primary_location":<<CASE o_orderkey % 6 WHEN 0 THEN 'null' WHEN 1 THEN '{"source":null,"landing_page_url":"http://u"}' """
    """WHEN 2 THEN '{"source":{"id":"S2","display_name":"J2","type":"repository"},"pdf_url":"http://p"}' """
    """ELSE '{"source":{"id":"S' || CAST(o_custkey AS STRING) || '","display_name":"J","type":"journal","publisher":"P","issn_l":"1234-5678","issn":["1234-5678","8765-4321"]}}' END>>,"""
    """"open_access":{"is_oa":<<CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END>>,"oa_status":"gold"}}"""
)

_LOOKUP = _json(
    """{"message":{"type":"<<CASE WHEN o_orderkey % 3 = 0 THEN 'book' ELSE 'journal-article' END>>","title":["Title <<o_orderkey>>","Second"],"""
    """"container-title":[<<CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '"J ' || CAST(o_orderkey % 11 AS STRING) || '"' END>>],"publisher":"P","""
    """"published-print":{"date-parts":[[<<CASE WHEN o_orderkey % 4 = 0 THEN 'null' ELSE CAST(year(o_orderdate) - 1 AS STRING) END>>]]},"""
    '"issued":{"date-parts":[[<<year(o_orderdate)>>,5]]},"ISSN":["1234-5678"],'
    """<<CASE WHEN o_orderkey % 3 = 0 THEN '"ISBN":["97' || CAST(o_orderkey AS STRING) || '","98"],' ELSE '' END>>"""
    '"volume":"3","page":"1-<<o_orderkey % 20>>","reference-count":<<o_orderkey % 40>>,"is-referenced-by-count":<<o_orderkey % 7>>,'
    """"license":[<<CASE WHEN o_orderkey % 2 = 0 THEN '{"URL":"l"}' ELSE '' END>>],"""
    '"author":[{"given":"A","family":"F<<o_orderkey % 9>>","sequence":"first","ORCID":"http://orcid.org/0","affiliation":[{"name":"U"}]},{"name":"Group"}]'
    """<<CASE WHEN o_orderkey % 5 = 2 THEN ',"editor":[{"family":"E"}]' ELSE '' END>>,"subject":["s1","s<<o_orderkey % 6>>"]}}"""
)

_PLACE = '"role-title":"R<<c_custkey % 4>>","organization":{"name":"Org <<c_custkey % 30>>","address":{"city":"C","country":"NZ"}},"start-date":{"year":{"value":"19<<c_custkey % 80 + 10>>"}},"end-date":null'
_PROFILE = _json(
    """{"person":{"name":{"given-names":{"value":"G<<c_custkey>>"},"family-name":<<CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '{"value":"F"}' END>>},"""
    """<<CASE WHEN c_custkey % 2 = 0 THEN '"biography":{"content":"Bio"},' ELSE '' END>>"""
    '"keywords":{"keyword":[{"content":" k<<c_custkey % 9>> "},{"content":" "}]},'
    '"external-identifiers":{"external-identifier":[{"external-id-type":"Scopus","external-id-value":"<<c_custkey>>"}]},'
    """"researcher-urls":{"researcher-url":[<<CASE WHEN c_custkey % 4 = 0 THEN '{"url-name":"home","url":{"value":"http://h"}},{"url-name":"none","url":null}' ELSE '' END>>]}},"""
    '"history":{"last-modified-date":{"value":1700000000<<c_custkey % 900 + 100>>}},'
    '"activities-summary":{"employments":{"affiliation-group":[{"summaries":[{"employment-summary":{' + _PLACE + '}}]},{"summaries":[]}]},'
    '"educations":{"affiliation-group":[{"summaries":[{"education-summary":{' + _PLACE + ',"department-name":"D"}}]}]}}}'
)

_ORGANISATION = _json(
    """{"id":"R<<s_suppkey>>",<<CASE WHEN s_suppkey % 2 = 0 THEN '"name":"Plain",' ELSE '' END>>"status":"active","established":<<1900 + s_suppkey % 90>>,"types":["education"],"""
    '"names":[{"value":"Label <<s_suppkey>>","lang":"en","types":["label"]},{"value":"Shown <<s_suppkey>>","types":["ror_display","label"]}],'
    '"aliases":["Al <<s_suppkey>>",{"value":"Al2"}],"acronyms":["AC<<s_suppkey % 5>>"],'
    '"external_ids":{"GRID":{"preferred":"g<<s_suppkey>>","all":["g<<s_suppkey>>","h"]},"FundRef":["f1","f2"],"ISNI":"i1"},'
    """"locations":[<<CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '{"geonames_id":5,"geonames_details":{"name":"City","country_code":"NZ","country_name":"New Zealand","lat":-1.5,"lng":2.25}}' END>>]}"""
)

RAW_VIEWS = {
    "works_raw": f"""
        SELECT CASE WHEN o_orderkey % 29 = 0 THEN 'not json' WHEN o_orderkey % 31 = 0 THEN '{{{{"title":"no id"}}}}' WHEN o_orderkey % 37 = 0 THEN NULL ELSE {_WORK} END AS raw_json,
               'W' || CAST(o_orderkey AS STRING) AS work_id
        FROM {{orders}}""",
    "lookups_raw": f"""
        SELECT '10.5555/x' || CAST(o_orderkey AS STRING) AS doi_clean, CASE o_orderkey % 10 WHEN 0 THEN 404 WHEN 1 THEN -1 ELSE 200 END AS response_status,
               CASE o_orderkey % 10 WHEN 0 THEN 'Resource not found.' WHEN 1 THEN NULL ELSE {_LOOKUP} END AS raw_json
        FROM {{orders}}""",
    "profiles_raw": f"""
        SELECT '0000-0003-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS orcid, 200 AS response_status, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {_PROFILE} END AS raw_json
        FROM {{customer}}""",
    "organisations_raw": f"""
        SELECT 'R' || CAST(s_suppkey AS STRING) AS ror_id, {_ORGANISATION} AS raw_json FROM {{supplier}}""",
    "journal_targets_raw": """
        SELECT ' ' || c_name || ' ' AS canonical_title, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE 'fam' || CAST(c_custkey AS STRING) END AS family_id,
               CASE WHEN c_custkey % 4 = 0 THEN 'none' ELSE ' 1234' || lpad(CAST(c_custkey % 900 AS STRING), 3, '0') || 'x' END AS print_ISSN, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '5678-' || lpad(CAST(c_custkey % 900 AS STRING), 4, '0') END AS electronic_ISSN,
               CASE c_custkey % 6 WHEN 0 THEN 'low' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' WHEN 3 THEN 'highest' WHEN 4 THEN NULL ELSE 'other' END AS acquisition_priority
        FROM {customer} WHERE c_custkey % 5 <> 1""",
}
