import json

from pyspark.sql import functions as F

from tidewell.operators import store
from tidewell.operators.kept import kept_once
from tidewell.sources import flatten, harvest
from tidewell.streaming import ingest

WORK = {
    "id": "https://x.org/W1", "doi": "https://doi.org/10.1/A", "title": "only title", "publication_year": 2020, "type": "article", "cited_by_count": 3, "citation_normalized_percentile": {"value": 0.5, "is_in_top_1_percent": False},
    "authorships": [{"author": {"id": "A1", "display_name": "Ann"}, "is_corresponding": True, "institutions": [{"id": "I1", "display_name": "Uni", "ror": "R1", "country_code": "NZ", "lineage": ["I1", "I0"]}, {"id": "I2", "country_code": "AU"}, {"country_code": None}]}, {"author": {}, "institutions": None}],
    "topics": [{"id": "T1", "display_name": "t", "score": 0.9, "subfield": {"id": "S", "display_name": "s"}}], "keywords": [{"id": "k", "display_name": "K", "score": 0.1}], "funders": [{"id": "f", "display_name": "F"}], "awards": [{"id": "g", "funder": {"id": "f"}}],
    "primary_location": {"source": {"id": "S1", "display_name": "J", "type": "journal", "issn_l": "1-2", "issn": ["1-2", "3-4"]}, "pdf_url": "u"}, "open_access": {"is_oa": True, "oa_status": "gold"},
}


def raw(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records], "raw_json string")


def test_works(spark):
    df = raw(spark, WORK, {"id": "W2"}, {"title": "no id"}, "not json", "[1]", None)
    assert [(r.work_id, r.title, r.citation_percentile) for r in flatten.works(df).orderBy("work_id").collect()] == [("W2", None, None), ("https://x.org/W1", "only title", 0.5)]
    a = flatten.authorships(df).collect()
    assert [(r.author_order, r.author_id, r.countries, r.is_au_nz_affiliated) for r in a] == [(1, "A1", "AU; NZ", True), (2, None, "", False)]
    assert [r.topic_id for r in flatten.topics(df).collect()] == ["T1"] and flatten.keywords(df).count() == flatten.funders(df).count() == 1
    assert flatten.awards(df).first().funder_id == "f"
    s = {r.work_id: r for r in flatten.work_sources(df).collect()}
    assert s["https://x.org/W1"].issn == "1-2; 3-4" and s["W2"].issn == "" and s["W2"].source_id is None
    i = {r.institution_id: r for r in flatten.institutions(flatten.authorships(df)).collect()}
    assert set(i) == {"I1", "I2"} and json.loads(i["I1"].lineage_json) == ["I1", "I0"]


def test_works_of_odd_kinds(spark):
    """Numbers as text are read, what has the wrong kind is null, lists that are objects have no elements."""
    odd = {"id": "W3", "publication_year": "1999", "fwci": "x", "cited_by_count": None, "authorships": {"author": {"id": "A"}}, "topics": "t", "keywords": [None, {"id": "k", "score": "0.5"}, 3], "primary_location": {"source": "s"}, "open_access": []}
    df = raw(spark, odd, {"id": None, "title": "no id"}, '{"id":"W4","id":"W5"}', " {")
    w = flatten.works(df).collect()
    assert [(r.work_id, r.publication_year, r.fwci, r.cited_by_count) for r in w] == [("W3", 1999, None, None)]
    assert flatten.authorships(df).count() == flatten.topics(df).count() == 0
    assert sorted((r.keyword_id or "", r.score) for r in flatten.keywords(df).collect()) == [("", None), ("", None), ("k", 0.5)]
    assert [(r.source_id, r.issn, r.is_oa) for r in flatten.work_sources(df).collect()] == [(None, "", None)]


def test_works_are_parsed_once(spark, tmp_path):
    """Seven flatteners read a kept table of variants; none of their plans parses text, and a changed file is parsed anew."""
    path = str(tmp_path / "raw")
    raw(spark, WORK).write.parquet(path)
    source = lambda: spark.read.parquet(path)
    table = lambda: kept_once("test_parsed", [source()], lambda: flatten.parsed(source()))
    assert table().schema["v"].dataType.simpleString() == "variant"
    first = table().inputFiles()
    assert table().inputFiles() == first
    for flat in (flatten.works, flatten.authorships, flatten.topics, flatten.keywords, flatten.funders, flatten.awards, flatten.work_sources):
        plan = flat(table())._jdf.queryExecution().optimizedPlan().toString()
        assert "parse_json" not in plan and "from_json" not in plan
        assert sorted(map(str, flat(table()).collect())) == sorted(map(str, flat(source()).collect()))
    raw(spark, {"id": "W9"}).write.mode("append").parquet(path)
    assert table().inputFiles() != first and flatten.works(table()).count() == 2


def test_lookups(spark):
    message = {"message": {"type": "book", "title": ["T", "U"], "published-print": {"date-parts": [[None]]}, "issued": {"date-parts": [[2001, 5]]}, "ISBN": ["1", "2"], "author": [{"given": "A", "family": "B"}], "editor": [{"name": "E"}], "license": [{"u": 1}], "subject": ["s1", "s2"]}}
    df = spark.createDataFrame([("10.1/a", 200, json.dumps(message)), ("10.1/b", 404, "error"), ("10.1/c", -1, None), ("10.1/d", 200, json.dumps({"message": {}}))], "doi_clean string, response_status int, raw_json string")
    rows = {r.doi_clean: r for r in flatten.crossref(df).collect()}
    assert set(rows) == {"10.1/a", "10.1/d"}
    a = rows["10.1/a"]
    assert (a.title, a.year, a.isbn, a.author_count, a.editor_count, a.has_license, a.has_link) == ("T", 2001, "1; 2", 1, 1, True, False)
    assert rows["10.1/d"].author_count == 0 and rows["10.1/d"].year is None
    assert sorted((r.role, r.family, r.name) for r in flatten.crossref_contributors(df).collect()) == [("author", "B", None), ("editor", None, "E")]
    assert sorted(r.subject for r in flatten.crossref_subjects(df).collect()) == ["s1", "s2"]


def test_profiles(spark):
    record = {"person": {"name": {"given-names": {"value": "A"}, "family-name": None}, "keywords": {"keyword": [{"content": " k "}, {"content": ""}]}, "external-identifiers": {"external-identifier": [{"external-id-type": "S", "external-id-value": "1"}]}, "researcher-urls": {"researcher-url": [{"url-name": "h", "url": {"value": "http://h"}}]}}, "history": {"last-modified-date": {"value": 12}}, "activities-summary": {"employments": {"affiliation-group": [{"summaries": [{"employment-summary": {"role-title": "R", "organization": {"name": "O", "address": {"country": "NZ"}}, "start-date": {"year": {"value": "1999"}}}}]}]}, "educations": {"affiliation-group": []}}}
    df = spark.createDataFrame([("o1", json.dumps(record))], "orcid string, raw_json string")
    assert tuple(flatten.profiles(df).first()) == ("o1", "A", None, None, None, 12)
    assert [r.keyword for r in flatten.profile_keywords(df).collect()] == ["k"]
    assert flatten.profile_ids(df).first().id_value == "1" and flatten.profile_websites(df).first().url == "http://h"
    e = flatten.affiliations(df).first()
    assert (e.organization, e.country, e.start_year, e.end_year) == ("O", "NZ", "1999", None) and flatten.affiliations(df, "education").count() == 0


def test_organisations(spark):
    record = {"id": "r1", "status": "active", "types": ["edu"], "names": [{"value": "N", "lang": "en", "types": ["ror_display", "label"]}], "aliases": ["al", {"value": "al2"}], "links": [{"type": "website", "value": "http://w"}], "external_ids": {"GRID": {"preferred": "g1", "all": ["g1", "g2"]}, "FundRef": ["f1"], "ISNI": "i1"}, "relationships": [{"id": "r2", "label": "P", "type": "Parent"}], "locations": [{"geonames_id": 5, "geonames_details": {"name": "C", "country_code": "NZ", "lat": 1.5}}]}
    df = raw(spark, record, {"name": "no id"})
    assert flatten.organisations(df).first().name == "N" and flatten.organisation_names(df).first().name_types == "ror_display; label"
    assert sorted(r.value for r in flatten.organisation_lists(df, "aliases").collect()) == ["al", "al2"] and flatten.organisation_lists(df, "links").first().value == "http://w"
    assert sorted((r.id_type, r.id_value, r.is_preferred) for r in flatten.organisation_ids(df).collect()) == [("FundRef", "f1", False), ("GRID", "g1", True), ("GRID", "g2", False), ("ISNI", "i1", False)]
    assert flatten.organisation_relationships(df).first().relationship_type == "parent" and flatten.organisation_locations(df).first().lat == 1.5


def test_csv_and_targets(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('﻿topic_id,topic_name,education_relevance_tier,include_decision\r\nhttps://x.org/T1/,"a ""q"", b",core,\r\n2,two,,Y\r\n3,three,excluded,no\r\nT1,"z",core,yes\r\n'.encode())
    rows = harvest.read_csv(spark, str(path), ["topic_id", "topic_name", "education_relevance_tier", "include_decision"])
    assert sorted((r.topic_id, r.topic_name) for r in harvest.curated_topics(rows).collect()) == [("T1", 'a "q", b'), ("T2", "two")]
    t = harvest.journal_targets(spark.createDataFrame([("J One", "fam", "1234-5678", "12345678", "high"), ("J Two", "", "", "8765432x", "low")], "canonical_title string, family_id string, print_ISSN string, electronic_ISSN string, acquisition_priority string"))
    ids = harvest.target_identifiers(t)
    assert sorted((r.kind, r.issn) for r in ids.collect()) == [("electronic", "8765-432X"), ("print", "1234-5678")]
    records = spark.createDataFrame([("S1", "x", ["1234-5678"]), ("S2", " j two ", []), ("S3", "j one", [])], "id string, display_name string, issn array<string>")
    none = spark.createDataFrame([], "target_id string, source_id string")
    assert sorted((r.source_id, r.how) for r in harvest.resolve_sources(t, ids, records, none).collect()) == [("S1", "issn"), ("S2", "title")]
    dump = tmp_path / "d.json"
    dump.write_text(json.dumps([{"id": 1}, {"id": 2}], indent=1))
    assert sorted(json.loads(r.raw_json)["id"] for r in harvest.read_json_array(spark, str(dump)).collect()) == [1, 2]


def test_lookup_pages_and_retries(spark):
    def call(key):
        if key == "bad":
            raise OSError("no route")
        return (200, '{"k": 1}') if key == "good" else (404, "x" * 5000)

    keys = spark.createDataFrame([("good",), ("bad",), ("gone",), ("good",)], "doi string")
    got = {r.doi: r for r in harvest.lookup(keys, "doi", call, partitions=2, interval=0.0, tries=1).collect()}
    assert got["good"].response_status == 200 and got["bad"].response_status == -1 and got["bad"].error_text == "no route"
    assert got["gone"].response_status == 404 and len(got["gone"].error_text) == 2000
    assert [r.doi for r in store.not_done(keys.distinct(), spark.createDataFrame([("good",), ("gone",)], "doi string"), ["doi"]).collect()] == ["bad"]
    waits, answers = [], iter([(500, ""), (429, ""), (200, "ok")])
    assert harvest.retried(lambda _: next(answers), "k", wait=waits.append) == (200, "ok") and waits == [10.0, 20.0]
    scan = harvest.pages(lambda target, cursor: ([f"{target}{cursor}"], "b" if cursor == "*" else None), spark.createDataFrame([("t1",), ("t2",)], "topic string"), "topic")
    assert sorted((r.topic, r.page, r.raw_json) for r in scan.collect()) == [("t1", 0, "t1*"), ("t1", 1, "t1b"), ("t2", 0, "t2*"), ("t2", 1, "t2b")]


def test_streams(spark, tmp_path):
    rows = [("a", f"2024-01-01 00:0{i}:00") for i in range(3)] + [("b", "2024-01-01 00:01:00")]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "k string, t string").select("k", F.to_timestamp("t").alias("seen_at")).repartition(2).write.parquet(src)
    stream = lambda: spark.readStream.schema("k string, seen_at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    q = ingest.first_seen(stream(), "k", "seen_at").writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.k for r in spark.table("firsts").collect()) == ["a", "b"]
    out = str(tmp_path / "out")
    q = ingest.keep_counters(stream(), ["k"], out, str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = max(int(p.name) for p in (tmp_path / "out").iterdir())
    assert sorted((r.k, r.seen_count) for r in spark.read.parquet(f"{out}/{last}").collect()) == [("a", 3), ("b", 1)]


def test_raw_records_are_dealt_out_and_parsed_once(spark, tmp_path):
    from tidewell.plans import views

    spark.range(200_000).selectExpr("id AS o_orderkey", "id * 7 % 1000 AS o_custkey", "timestamp'1995-01-01' AS o_orderdate", "sha2(string(id), 256) AS o_comment").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    raw = views.view(spark, str(tmp_path), "works_raw")
    assert raw.rdd.getNumPartitions() > 4  # of one file
    assert raw.agg(F.count("*")).first()[0] == 200_000
    plan = flatten.works(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('{"id":"W') == 1 and plan.lower().count("parsejson") == 1
