"""Nested bibliographic JSON to flat tables. Raw text stays in raw_json; every layer can be rebuilt from it.

Schemas name the fields that are read; a record that isn't JSON, or lacks its id, gives no rows.
Arrays whose elements may be strings or objects are read as text and unwrapped one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSTITUTIONS = "array<struct<id:string,display_name:string,ror:string,country_code:string,type:string,lineage:array<string>>>"
_DATE = "struct<`date-parts`:array<array<int>>>"
_PERSON = "array<struct<sequence:string,given:string,family:string,name:string,ORCID:string,affiliation:array<struct<name:string>>>>"
CROSSREF = (
    f"message struct<type:string,title:array<string>,`container-title`:array<string>,publisher:string,`published-print`:{_DATE},`published-online`:{_DATE},published:{_DATE},issued:{_DATE},created:{_DATE},"
    f"ISSN:array<string>,ISBN:array<string>,volume:string,issue:string,page:string,`reference-count`:int,`is-referenced-by-count`:int,license:array<string>,link:array<string>,author:{_PERSON},editor:{_PERSON},subject:array<string>>"
)
_VALUE = "struct<value:string>"
_PLACE = f"struct<`role-title`:string,`department-name`:string,`start-date`:struct<year:{_VALUE}>,`end-date`:struct<year:{_VALUE}>,organization:struct<name:string,address:struct<city:string,country:string>>>"
_GROUPS = f"struct<`affiliation-group`:array<struct<summaries:array<struct<`employment-summary`:{_PLACE},`education-summary`:{_PLACE}>>>>>"
PROFILE = (
    f"person struct<name:struct<`given-names`:{_VALUE},`family-name`:{_VALUE},`credit-name`:{_VALUE}>,biography:struct<content:string>,keywords:struct<keyword:array<struct<content:string>>>,"
    f"`external-identifiers`:struct<`external-identifier`:array<struct<`external-id-type`:string,`external-id-value`:string>>>,`researcher-urls`:struct<`researcher-url`:array<struct<`url-name`:string,url:{_VALUE}>>>>, "
    f"history struct<`last-modified-date`:struct<value:bigint>>, `activities-summary` struct<employments:{_GROUPS},educations:{_GROUPS}>"
)
ROR = (
    "id string, name string, status string, established int, types array<string>, names array<struct<value:string,lang:string,types:array<string>>>, aliases array<string>, acronyms array<string>, external_ids map<string,string>, "
    "relationships array<struct<id:string,label:string,type:string>>, locations array<struct<geonames_id:string,geonames_details:struct<name:string,region_name:string,country_code:string,country_name:string,lat:double,lng:double>>>, links array<string>, domains array<string>"
)


def once_a_row(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is worked out once a row: Spark copies an expression into every filter and projection above it, but none through an explode, here of one element."""
    return rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(value)).alias(name))


def parse(raw: DataFrame, schema: str, json: str = "raw_json") -> DataFrame:
    """raw with r, the parsed record; rows that aren't JSON objects are left out."""
    whole = F.try_parse_json(json).isNotNull() & F.ltrim(json).startswith("{")
    return raw.where(whole).withColumn("r", F.from_json(json, schema))


def _joined(array: Column) -> Column:
    return F.array_join(array, "; ")


def parsed(raw: DataFrame, json: str = "raw_json") -> DataFrame:
    """work_id and v, the record as a variant: rows that are JSON objects with an id.

    Write it once (a variant is a Parquet type) and hand it to the flatteners of works in place of raw:
    none of them parses text again.
    """
    rows = once_a_row(raw.where(F.ltrim(json).startswith("{")).select(json), "v", F.try_parse_json(json))
    return rows.select(_at("v", "id").alias("work_id"), "v").where("work_id is not null")


def _parsed(raw: DataFrame) -> DataFrame:
    return raw if "v" in raw.columns else parsed(raw)


def _at(v: str, path: str, kind: str = "string") -> Column:
    """A field of a variant, or null where it is missing, null or of another kind."""
    return F.try_variant_get(v, f"$.{path}", kind)


def _elements(raw: DataFrame, path: str) -> DataFrame:
    """work_id, n (place from 0) and x of every element of a list; what isn't a list has none."""
    spark, rows = raw.sparkSession, _parsed(raw)
    return spark.sql(f"SELECT work_id, e.pos AS n, e.value AS x FROM {{rows}}, LATERAL variant_explode(try_variant_get(v, '$.{path}', 'variant')) AS e WHERE e.key IS NULL", rows=rows)


def work_fields() -> list[Column]:
    """The columns of works, of a record v, but for the id."""
    top = "citation_normalized_percentile"
    return [
        _at("v", "doi").alias("doi"), F.coalesce(_at("v", "display_name"), _at("v", "title")).alias("title"),
        _at("v", "publication_year", "int").alias("publication_year"), _at("v", "publication_date").alias("publication_date"),
        _at("v", "type").alias("work_type"), _at("v", "type_crossref").alias("type_crossref"),
        _at("v", "cited_by_count", "int").alias("cited_by_count"), _at("v", "fwci", "double").alias("fwci"),
        _at("v", f"{top}.value", "double").alias("citation_percentile"),
        *(_at("v", f"{top}.{f}", "boolean").alias(f) for f in ("is_in_top_1_percent", "is_in_top_10_percent")),
        _at("v", "language").alias("language"),
    ]


def works(raw: DataFrame) -> DataFrame:
    return _parsed(raw).select("work_id", *work_fields())


def authorships(raw: DataFrame, home=("AU", "NZ")) -> DataFrame:
    """One row an authorship, in order from 1."""
    rows = _elements(raw, "authorships").withColumn("i", F.coalesce(_at("x", "institutions", INSTITUTIONS), F.array()))
    codes = F.array_sort(F.array_distinct(F.filter(F.transform("i", lambda i: i["country_code"]), lambda c: c.isNotNull() & (c != ""))))
    return rows.select(
        "work_id", (F.col("n") + 1).alias("author_order"), _at("x", "author.id").alias("author_id"), _at("x", "author.display_name").alias("author_name"),
        _at("x", "author.orcid").alias("orcid"), _at("x", "author_position").alias("author_position"), _at("x", "is_corresponding", "boolean").alias("is_corresponding"),
        F.to_json("i").alias("institutions_json"), _joined(codes).alias("countries"), F.arrays_overlap(codes, F.array(*map(F.lit, home))).alias("is_au_nz_affiliated"),
    )


def _children(raw: DataFrame, column: str, **fields: str) -> DataFrame:
    rows = _elements(raw, column)
    return rows.select("work_id", *(_at("x", path, "double" if path == "score" else "string").alias(name) for name, path in fields.items()))


def topics(raw: DataFrame) -> DataFrame:
    places = {f"{part}_{f}": f"{part}.{g}" for part in ("subfield", "field", "domain") for f, g in (("id", "id"), ("name", "display_name"))}
    return _children(raw, "topics", topic_id="id", topic_name="display_name", topic_score="score", **places)


def keywords(raw: DataFrame) -> DataFrame:
    return _children(raw, "keywords", keyword_id="id", keyword="display_name", score="score")


def funders(raw: DataFrame) -> DataFrame:
    return _children(raw, "funders", funder_id="id", funder_name="display_name")


def awards(raw: DataFrame) -> DataFrame:
    return _children(raw, "awards", award_id="id", funder_id="funder.id", funder_name="funder.display_name")


def work_sources(raw: DataFrame) -> DataFrame:
    """Always one row a work; issn is empty, not null, if there is none."""
    place, source = "primary_location", "primary_location.source"
    return _parsed(raw).select(
        "work_id", _at("v", f"{source}.id").alias("source_id"), _at("v", f"{source}.display_name").alias("source_name"), _at("v", f"{source}.type").alias("source_type"),
        _at("v", f"{source}.publisher").alias("publisher"), _at("v", f"{source}.issn_l").alias("issn_l"),
        F.coalesce(_joined(_at("v", f"{source}.issn", "array<string>")), F.lit("")).alias("issn"),
        _at("v", f"{place}.landing_page_url").alias("landing_page_url"), _at("v", f"{place}.pdf_url").alias("pdf_url"),
        _at("v", "open_access.is_oa", "boolean").alias("is_oa"), _at("v", "open_access.oa_status").alias("oa_status"),
    )


def _institution_rows(authors: DataFrame) -> DataFrame:
    """Institutions with an id in authorships whose institutions_json is a list, with their place n."""
    good = F.try_parse_json("institutions_json").isNotNull() & F.ltrim("institutions_json").startswith("[")
    return authors.where(good).select("*", F.posexplode(F.from_json("institutions_json", INSTITUTIONS)).alias("n", "i")).where("i.id is not null")


def institutions(authors: DataFrame) -> DataFrame:
    """Distinct institutions in authorships; of an id the first by work and place."""
    rows = _institution_rows(authors)
    first = rows.groupBy(F.col("i.id").alias("institution_id")).agg(F.min_by("i", F.struct("work_id", "author_order", "n")).alias("i"))
    return first.select(
        "institution_id", F.col("i.display_name").alias("institution_name"), F.col("i.ror").alias("ror"), F.col("i.country_code").alias("country_code"), F.col("i.type").alias("type"),
        F.to_json(F.coalesce("i.lineage", F.array())).alias("lineage_json"),
    )


def researcher_institutions(authors: DataFrame) -> DataFrame:
    """One row an author, institution and work; of several the first by place. Authorships without an author are left out."""
    rows = _institution_rows(authors.where("author_id is not null"))
    first = rows.groupBy("author_id", F.col("i.id").alias("institution_id"), "work_id").agg(F.min_by(F.struct("author_name", "i"), F.struct("author_order", "n")).alias("x"))
    return first.select(
        "author_id", "x.author_name", "institution_id", F.col("x.i.display_name").alias("institution_name"), F.col("x.i.ror").alias("institution_ror"),
        F.col("x.i.country_code").alias("institution_country"), F.col("x.i.type").alias("institution_type"), "work_id",
    )


def _year(m: str) -> Column:
    """The first of the dates that has a year."""
    at = lambda name: F.try_element_at(F.try_element_at(F.col(f"{m}.`{name}`.`date-parts`"), F.lit(1)), F.lit(1))
    return F.coalesce(*(at(n) for n in ("published-print", "published-online", "published", "issued", "created")))


def crossref(raw: DataFrame) -> DataFrame:
    """Successful lookups (doi_clean, response_status, raw_json), flat."""
    m = "r.message"
    first = lambda c: F.try_element_at(F.col(f"{m}.{c}"), F.lit(1))
    size = lambda c: F.coalesce(F.size(F.filter(F.col(f"{m}.{c}"), lambda x: F.lit(True))), F.lit(0))
    return parse(raw.where("response_status = 200"), CROSSREF).select("doi_clean", F.col(f"{m}.type").alias("crossref_type"), first("title").alias("title"), first("`container-title`").alias("container_title"), f"{m}.publisher", _year(m).alias("year"), _joined(F.col(f"{m}.ISSN")).alias("issn"), _joined(F.col(f"{m}.ISBN")).alias("isbn"), f"{m}.volume", f"{m}.issue", f"{m}.page", F.col(f"{m}.`reference-count`").alias("reference_count"), F.col(f"{m}.`is-referenced-by-count`").alias("cited_by_count"), size("author").alias("author_count"), size("editor").alias("editor_count"), (size("license") > 0).alias("has_license"), (size("link") > 0).alias("has_link"))


def crossref_contributors(raw: DataFrame) -> DataFrame:
    rows = parse(raw.where("response_status = 200"), CROSSREF)
    of = lambda role: rows.select("doi_clean", F.lit(role).alias("role"), F.posexplode(f"r.message.{role}").alias("n", "p"))
    both = of("author").unionByName(of("editor"))
    return both.select("doi_clean", "role", (F.col("n") + 1).alias("position"), "p.sequence", "p.given", "p.family", "p.name", F.col("p.ORCID").alias("orcid"), F.to_json(F.coalesce("p.affiliation", F.array())).alias("affiliation_json"))


def crossref_subjects(raw: DataFrame) -> DataFrame:
    return parse(raw.where("response_status = 200"), CROSSREF).select("doi_clean", F.explode("r.message.subject").alias("subject"))


def profiles(raw: DataFrame) -> DataFrame:
    p = "r.person"
    return parse(raw, PROFILE).select("orcid", F.col(f"{p}.name.`given-names`.value").alias("given_names"), F.col(f"{p}.name.`family-name`.value").alias("family_name"), F.col(f"{p}.name.`credit-name`.value").alias("credit_name"), F.col(f"{p}.biography.content").alias("biography"), F.col("r.history.`last-modified-date`.value").alias("last_modified_date"))


def profile_keywords(raw: DataFrame) -> DataFrame:
    rows = parse(raw, PROFILE).select("orcid", F.explode("r.person.keywords.keyword").alias("k"))
    return rows.select("orcid", F.trim("k.content").alias("keyword")).where("keyword != ''")


def profile_ids(raw: DataFrame) -> DataFrame:
    rows = parse(raw, PROFILE).select("orcid", F.explode("r.person.`external-identifiers`.`external-identifier`").alias("x"))
    return rows.select("orcid", F.col("x.`external-id-type`").alias("id_type"), F.col("x.`external-id-value`").alias("id_value"))


def profile_websites(raw: DataFrame) -> DataFrame:
    rows = parse(raw, PROFILE).select("orcid", F.explode("r.person.`researcher-urls`.`researcher-url`").alias("x"))
    return rows.select("orcid", F.col("x.`url-name`").alias("name"), F.col("x.url.value").alias("url"))


def affiliations(raw: DataFrame, kind: str = "employment") -> DataFrame:
    """kind: employment or education; two levels of groups."""
    groups = parse(raw, PROFILE).select("orcid", F.explode(f"r.`activities-summary`.{kind}s.`affiliation-group`").alias("g"))
    rows = groups.select("orcid", F.explode("g.summaries").alias("s")).select("orcid", F.col(f"s.`{kind}-summary`").alias("s")).where("s is not null")
    return rows.select("orcid", F.col("s.organization.name").alias("organization"), F.col("s.`role-title`").alias("role_title"), F.col("s.`department-name`").alias("department"), F.col("s.organization.address.city").alias("city"), F.col("s.organization.address.country").alias("country"), F.col("s.`start-date`.year.value").alias("start_year"), F.col("s.`end-date`.year.value").alias("end_year"))


def _text(e: Column, field: str) -> Column:
    """An element that is a string or an object with the field."""
    return F.when(F.ltrim(e).startswith("{"), F.get_json_object(e, f"$.{field}")).otherwise(e)


def organisations(raw: DataFrame) -> DataFrame:
    shown = F.filter("r.names", lambda n: F.array_contains(n["types"], "ror_display"))
    return parse(raw, ROR).where("r.id is not null").select(F.col("r.id").alias("ror_id"), F.coalesce("r.name", F.try_element_at(shown, F.lit(1))["value"]).alias("name"), "r.status", "r.established", F.to_json(F.coalesce("r.types", F.array())).alias("types_json"))


def organisation_lists(raw: DataFrame, column: str, field: str = "value") -> DataFrame:
    """aliases, acronyms, links or domains: one row an element."""
    rows = parse(raw, ROR).where("r.id is not null").select(F.col("r.id").alias("ror_id"), F.explode(f"r.{column}").alias("e"))
    return rows.select("ror_id", _text(F.col("e"), field).alias("value")).where("value is not null")


def organisation_names(raw: DataFrame) -> DataFrame:
    rows = parse(raw, ROR).where("r.id is not null").select(F.col("r.id").alias("ror_id"), F.explode("r.names").alias("n"))
    return rows.select("ror_id", F.col("n.value").alias("name"), F.col("n.lang").alias("lang"), _joined(F.col("n.types")).alias("name_types"))


def organisation_ids(raw: DataFrame) -> DataFrame:
    """External ids by kind: an object with preferred and all, a list, or one value."""
    rows = parse(raw, ROR).where("r.id is not null").select(F.col("r.id").alias("ror_id"), F.explode("r.external_ids").alias("id_type", "v"))
    wrapped = F.ltrim("v").startswith("{")
    every = F.when(wrapped, F.get_json_object("v", "$.all")).otherwise(F.col("v"))
    values = F.when(F.ltrim(every).startswith("["), F.from_json(every, "array<string>")).otherwise(F.array(every))
    prefer = F.when(wrapped, F.get_json_object("v", "$.preferred"))
    return rows.select("ror_id", "id_type", prefer.alias("preferred"), F.explode(values).alias("id_value")).select("ror_id", "id_type", "id_value", F.coalesce(F.col("preferred") == F.col("id_value"), F.lit(False)).alias("is_preferred"))


def organisation_relationships(raw: DataFrame) -> DataFrame:
    rows = parse(raw, ROR).where("r.id is not null").select(F.col("r.id").alias("ror_id"), F.explode("r.relationships").alias("x"))
    return rows.select("ror_id", F.col("x.id").alias("related_ror_id"), F.col("x.label").alias("label"), F.lower("x.type").alias("relationship_type"))


def organisation_locations(raw: DataFrame) -> DataFrame:
    rows = parse(raw, ROR).where("r.id is not null").select(F.col("r.id").alias("ror_id"), F.explode("r.locations").alias("x"))
    d = "x.geonames_details"
    return rows.select("ror_id", F.col("x.geonames_id").alias("geonames_id"), F.col(f"{d}.name").alias("city"), F.col(f"{d}.region_name").alias("region"), F.col(f"{d}.country_code").alias("country_code"), F.col(f"{d}.country_name").alias("country"), F.col(f"{d}.lat").alias("lat"), F.col(f"{d}.lng").alias("lng"))
