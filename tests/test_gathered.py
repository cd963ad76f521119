"""Layers by author read rows that were gathered once: the same results as from the plain joins, and no further shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import graph
from tidewell.operators.kept import kept_by, tasks_for
from tidewell.plans import identity, reports, researchers, views


@pytest.fixture(scope="module")
def made(spark):
    """Authors with several names, several authorships of a work, unknown affiliations, works that aren't there, that are there twice, and that have several sources or none."""
    rng = random.Random(3)
    rows = [(f"W{rng.randrange(60)}", f"A{(a := rng.randrange(25))}" if rng.random() > 0.05 else None, rng.choice(["X", "Y", None]) if a % 3 == 0 else f"N{a}", rng.choice(["", None, f"o{a}"]), 1, False, rng.choice([True, False, False, None])) for _ in range(400)]
    authorships = spark.createDataFrame(rows, "work_id string, author_id string, author_name string, orcid string, author_order int, is_corresponding boolean, is_au_nz_affiliated boolean")
    works = spark.createDataFrame([(f"W{i}", rng.choice([None, 2000 + i % 5]), rng.choice(["article", "book", None]), rng.choice([None, i])) for i in [*range(55), 3, 4]], "work_id string, publication_year int, work_type string, cited_by_count int")
    topics = spark.createDataFrame([(f"W{i}", f"https://topics.example.org/T{t}", rng.choice([None, f"topic {t}"]), rng.choice([None, 0.5, 0.25])) for i in range(58) for t in rng.sample(range(6), i % 4)], "work_id string, topic_id string, topic_name string, topic_score double")
    curated = spark.createDataFrame([("T0", "core"), ("T1", "adjacent"), ("T2", None)], "topic_id string, education_relevance_tier string")
    sources = spark.createDataFrame([(f"W{i}", rng.choice(["S1", "S2", "S3", None])) for i in range(60) for _ in range(i % 3)], "work_id string, source_name string")
    tiers = researchers.topic_tiers(topics, curated)
    listed = researchers.topic_list(tiers)
    rows = kept_by(researchers.gathered(authorships, works, 3, tiers, listed, sources), "author_id", 3)
    return authorships, works, topics, curated, sources, rows, listed


def _rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_same_as_plain_joins(made):
    authorships, works, topics, curated, sources, rows, listed = made
    rw = researchers.researcher_works(authorships, works)
    columns = ["author_id", "author_name", "orcid", "works", "citations", "first_year", "last_year", "is_au_nz_affiliated"]
    authors = researchers.author_rows(rows)
    assert _rows(authors, columns) == _rows(researchers.researchers(rw), columns)
    assert _rows(researchers.source_lists(rows), ["author_id", "top_sources"]) == _rows(researchers.top_sources(rw, sources), ["author_id", "top_sources"])
    kinds = researchers.publication_types(rw)
    assert _rows(researchers.publication_types(rows.where("known"), F.col("times")), kinds.columns) == _rows(kinds, kinds.columns)
    counts = researchers.coauthor_summary(graph.shared_works(authorships), authors)
    assert _rows(researchers.coauthor_counts(rows, authors, 3), counts.columns) == _rows(counts, counts.columns)
    tier = curated.select(F.concat(F.lit(researchers.TOPIC_PREFIX), "topic_id").alias("topic_id"), "education_relevance_tier")
    by = ["author_id", "author_name", "topic_id", "topic_name", "education_relevance_tier"]
    want = rw.join(topics, "work_id").join(tier, "topic_id", "left").groupBy(*by).agg(F.count_distinct("work_id").alias("works"), F.sum(F.coalesce("cited_by_count", F.lit(0))).alias("citations"), F.round(F.max("topic_score"), 6).alias("best_score"))
    assert _rows(researchers.researcher_topics(rows, listed), want.columns) == _rows(want, want.columns)


def test_shared_works_of_wanted_authors(spark, made):
    authorships = made[0]
    wanted = spark.createDataFrame([(f"A{i}",) for i in range(0, 25, 2)], "author_id string")
    every, few = graph.shared_works(authorships), graph.shared_works_of(authorships, wanted, 3)
    both = every.where("CAST(substr(author_id_a, 2) AS INT) % 2 = 0 AND CAST(substr(author_id_b, 2) AS INT) % 2 = 0")
    assert _rows(few, every.columns) == _rows(both, every.columns)
    crowd = spark.createDataFrame([("w", f"A{i}") for i in range(101)], "work_id string, author_id string")
    assert graph.shared_works_of(crowd, wanted, 3).count() == 0


def test_crowded_works_count_for_all_of_their_authors(spark):
    """Works of 130, 150 and 120 authors, some of whom are in several, beside small ones that repeat pairs of these or bring new ones."""
    people = {"V": range(130), "W": range(100, 250), "X": range(240, 360), "a": (0, 1, 400), "b": (0, 1, 245), "c": (5, 359), "d": (400, 401), "e": (402,)}
    rows = [(w, f"A{i}", f"N{i}", None, 1, False, i % 3 == 0) for w, whose in people.items() for i in whose]
    authorships = spark.createDataFrame(rows, "work_id string, author_id string, author_name string, orcid string, author_order int, is_corresponding boolean, is_au_nz_affiliated boolean")
    works = spark.createDataFrame([(w, 2000, "article", 1) for w in people], "work_id string, publication_year int, work_type string, cited_by_count int")
    topics = spark.createDataFrame([], "work_id string, topic_id string, topic_name string, topic_score double, education_relevance_tier string")
    gathered = kept_by(researchers.gathered(authorships, works, 3, topics, researchers.topic_list(topics)), "author_id", 3)
    got = {r.author_id: (r.coauthors, r.international_coauthors, r.shared_works) for r in researchers.coauthor_counts(gathered, researchers.author_rows(gathered), 3).collect()}
    want = {}
    for i in {i for whose in people.values() for i in whose}:
        mine = [set(whose) - {i} for whose in people.values() if i in whose]
        if others := set().union(*mine):
            want[f"A{i}"] = (len(others), sum(o % 3 != 0 for o in others), sum(map(len, mine)))
    assert got == want


def test_pairs_of_a_block_in_a_crowded_work(spark):
    crowd = spark.createDataFrame([(w, f"A{i:03}") for w in ("v", "w") for i in range(150)] + [("w", None)], "work_id string, author_id string")
    people = spark.createDataFrame([(f"A{i:03}", n) for i, n in ((0, "Ann Lee"), (1, "Ann Lee"), (2, "Abe Lee"), (3, "Bob Ray"), (4, "Mono"), (5, "Mono"))] + [(f"A{i:03}", "Cy Zed") for i in range(10, 40)], "author_id string, author_name string")
    wanted = identity.in_blocks(identity.with_keys(people))
    found = {(r.author_id_a, r.author_id_b, r.shared_work_count) for r in graph.shared_works_of(crowd, wanted, 3, None).collect()}
    zed = {(f"A{i:03}", f"A{j:03}", 2) for i in range(10, 40) for j in range(i + 1, 40)}  # their initials are too many, their name isn't
    assert found == zed | {("A000", "A001", 2), ("A000", "A002", 2), ("A001", "A002", 2), ("A004", "A005", 2)}


def test_no_shuffle_to_an_author(made):
    rows = made[5]
    for layer in (researchers.author_rows(rows), researchers.source_lists(rows), researchers.publication_types(rows, F.col("times"))):
        assert "Exchange hashpartitioning" not in layer._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_files(spark, tmp_path):
    spark.range(3_000_000).select(F.xxhash64("id").alias("x")).write.parquet(str(tmp_path / "t"))
    assert tasks_for(spark.read.parquet(str(tmp_path / "t"))) > spark.sparkContext.defaultParallelism


def test_topic_summary_stays_where_its_rows_are(made):
    rt = researchers.researcher_topics(made[5], made[6])
    out = researchers.topic_summary(rt)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Exchange hashpartitioning" not in plan
    tier = lambda t, x: F.when(F.col("education_relevance_tier") == t, F.col(x))
    want = rt.groupBy("author_id").agg(F.count_distinct("topic_id").alias("topics"), F.count_distinct(tier("core", "topic_id")).alias("core_topics"), F.count_distinct(tier("adjacent", "topic_id")).alias("adjacent_topics"), F.coalesce(F.sum(tier("core", "works")), F.lit(0)).alias("core_work_links"))
    assert _rows(out, want.columns) == _rows(want, want.columns) and dict(out.dtypes)["topics"] == "bigint"


@pytest.mark.parametrize("name, key", [("work_topics", "work_id"), ("researcher_institutions", "author_id")])
def test_views_are_aggregated_by_their_key(spark, name, key):
    """Rows go once to as many tasks as are asked for, and are neither sorted nor summed before that."""
    folder = "/root/testdata/sf0.001"
    rows = views.keyed(spark, folder, name, 7)
    plan = rows.repartition(7, key)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(concat" in plan
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning(concat") :].split("BroadcastExchange")[0]
    plain = views.view(spark, folder, name)
    assert _rows(rows, plain.columns) == _rows(plain, plain.columns)


def test_output_shares(spark):
    rw = spark.createDataFrame([("a", w) for w in "wwxyz"] + [("b", "w"), ("b", "x"), ("c", "n")], "author_id string, work_id string")
    tags = spark.createDataFrame([("w", "core_scholarly"), ("w", "repository_or_open_output"), ("x", "core_scholarly"), ("x", "core_scholarly"), ("y", None)], "work_id string, broad_output_family string")
    out = reports.researcher_outputs(rw, tags, 3)
    assert _rows(out, ["author_id", "works", "core", "repository", "repository_share"]) == [("a", 3, 2, 1, 0.333333)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "REPARTITION_BY_NUM" in plan
