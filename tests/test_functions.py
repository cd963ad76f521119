import unicodedata

import pytest
from pyspark.sql import functions as F

from tidewell.functions import ladders, text
from tidewell.plans import identity


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "column, value, want",
    [
        (text.clean, None, ""), (text.clean, "  a ", "a"),
        (text.clean_text, None, None), (text.clean_text, "ﬁ​  x  y\n", "fi x y"), (text.clean_text, "a\nb", "ab"),
        (text.normalize_doi, " https://DX.doi.org/10.1/AbC ", "10.1/abc"), (text.normalize_doi, "doi:10.1/X", "10.1/x"), (text.strip_doi_url, "http://doi.org/10.1/X", "10.1/X"),
        (text.issn, "1234567x", "1234-567X"), (text.issn, "nan", ""), (text.issn, None, ""),
        (text.orcid, "https://orcid.org/0000-0001-2345-678x/", "0000-0001-2345-678X"), (text.orcid, "0000-0001", ""), (text.orcid, None, ""),
        (lambda c: text.short_id(c, "T"), "https://x.org/123/", "T123"), (lambda c: text.short_id(c, "T"), "https://x.org/T9", "T9"),
        (text.person_name, "  O’Néill–Smith,  J. ", "o'néill-smith j"), (text.person_name, None, ""),
        (text.institution_name, "The Univ. of X & Y", "univ of x and y"), (text.alphanumeric_key, " A.b-C 1 ", "abc1"),
        (lambda c: text.initials_key(c), "jane mary smith", "smith|jm"), (lambda c: text.initials_key(c), "smith", None),
        (lambda c: F.array_join(text.topic_tokens(c), ","), "a b (3); c (1); ; a b (2)", "a b,c"),
        (ladders.registry_active, " No ", False), (ladders.registry_active, "yes", True), (ladders.registry_active, "", None),
        (lambda c: text.surrogate("CI", 8, c.cast("int")), "12", "CI00000012"),
    ],
)
def test_strings(spark, column, value, want):
    assert one(spark, column, value) == want


def test_ladders_take_the_first_rung_and_nulls_fall_through(spark):
    df = spark.createDataFrame([(None, "journal", "preprint", None), ("J", "journal", "review", None), ("J", None, None, "x proceedings"), ("J", "repository", "article", None), ("J", None, None, None)], "n string, k string, w string, c string")
    n, k, w, c = map(F.col, "nkwc")
    got = [tuple(r) for r in df.select(ladders.output_class(n, k, w, c), ladders.output_family(n, k, w), ladders.source_class(n, k)).collect()]
    assert got == [("missing_source", "repository_or_open_output", "missing_source"), ("journal_review_article", "core_scholarly", "scholarly_journal"), ("conference_output", "other", "other_source"), ("repository_article_or_preprint_record", "repository_or_open_output", "repository_or_preprint_platform"), ("other_output", "other", "other_source")]
    flags = df.select(*(v.alias(f) for f, v in ladders.output_flags(n, k, w).items())).collect()
    assert all(x is not None for r in flags for x in r)


def test_normal_forms_of_whole_documents(spark):
    """Every text equals Python's form; the rows that are ASCII never reach Python."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, "ﬁ ½ Å é ｶﾞ"), (-2, None), (-3, ""), (-4, "plain"), (-5, "̈́")], "doc_id long, text string")
    rows = docs.unionByName(odd)
    for form, name in ((text.nfkc, "NFKC"), (text.nfc, "NFC")):
        got = {r.doc_id: r.text for r in text.normalised(rows, form, "text").collect()}
        want = {r.doc_id: None if r.text is None else unicodedata.normalize(name, r.text) for r in rows.collect()}
        assert got == want
    plan = text.normalised(docs, text.nfkc, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" in plan


def test_names_in_composed_form(spark):
    names = ["Zoë Māori-Smith", "O’Brien", "Ångström", None, "  X  Y "]
    rows = spark.createDataFrame([(n,) for n in names], "author_name string")
    got = [r.name_key for r in identity.with_keys(rows.coalesce(1)).collect()]
    assert sorted(got) == sorted(["zoë māori-smith", "o'brien", "ångström", "", "x y"])
