"""Researcher layer: from authorships to candidate researchers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import ladders, text
from tidewell.operators import graph
from tidewell.operators.kept import kept, kept_by

#: What stands before a topic's identifier in the curated list.
TOPIC_PREFIX = "https://topics.example.org/"
TOPIC = ("topic_id", "topic_name", "education_relevance_tier")


def researcher_works(authorships: DataFrame, works: DataFrame) -> DataFrame:
    cols = ["author_id", "author_name", "orcid", "work_id", "author_order", "is_corresponding", "is_au_nz_affiliated"]
    return authorships.where("author_id is not null").join(works.select("work_id", "publication_year", "work_type", "cited_by_count"), "work_id").select(*cols, "publication_year", "work_type", "cited_by_count")


def topic_tiers(topics: DataFrame, curated: DataFrame) -> DataFrame:
    """Topics of works with the tier of the curated topic; the curated list is small and is broadcast."""
    tier = curated.select(F.col("topic_id").alias("short_id"), "education_relevance_tier")
    return topics.withColumn("short_id", F.replace("topic_id", F.lit(TOPIC_PREFIX), F.lit(""))).join(F.broadcast(tier), "short_id", "left").select("work_id", *TOPIC, "topic_score")


def topic_list(tiers: DataFrame) -> DataFrame:
    """The distinct topics, each with a number (topic) that stands for it while rows are sent; which one has no meaning."""
    return kept(tiers.select(*TOPIC).distinct().withColumn("topic", F.monotonically_increasing_id()), "topic_list")


def gathered(authorships: DataFrame, works: DataFrame, tasks: int, tiers: DataFrame, listed: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Rows of authors on works, with what layers by author ask of the work: each goes to its work and from there to its author, once for all layers.

    work_id, author_id, author_name, orcid (each four once), affiliated (bits: 1 at home, 2 not, 4 unknown),
    times (how many authorships), crowded (whether the work has more than graph.CROWD such rows), known
    (whether there is the work), its year, type and citations, its topics (numbers of topic_list) with their scores, and its source name (more_names, if there are several).
    """
    home = F.col("is_au_nz_affiliated")
    rows = authorships.where("author_id is not null").select("work_id", "author_id", "author_name", F.nullif("orcid", F.lit("")).alias("orcid"), F.when(home, 1).when(~home, 2).otherwise(4).alias("bit"))
    rows = rows.repartition(tasks, "work_id").groupBy("work_id", "author_id", "author_name", "orcid").agg(F.bit_or("bit").alias("affiliated"), F.count("*").alias("times"))
    rows = rows.withColumn("crowded", F.count("*").over(Window.partitionBy("work_id")) > graph.CROWD)
    rows = rows.join(works.select("work_id", "publication_year", "work_type", "cited_by_count", F.lit(True).alias("known")), "work_id", "left")
    same = reduce(lambda x, y: x & y, (tiers[c].eqNullSafe(listed[c]) for c in TOPIC))
    topics = tiers.join(listed, same).groupBy("work_id").agg(F.collect_list(F.struct("topic", "topic_score")).alias("t")).select("work_id", F.col("t.topic").alias("topics"), F.col("t.topic_score").alias("scores"))
    rows = rows.join(topics, "work_id", "left")
    if sources is not None:
        names = sources.where("source_name is not null").select("work_id", "source_name").repartition(tasks, "work_id").groupBy("work_id").agg(F.collect_set("source_name").alias("names"))
        rows = rows.join(names.select("work_id", F.col("names")[0].alias("source_name"), F.when(F.size("names") > 1, F.col("names")).alias("more_names")), "work_id", "left")
    return rows.repartition(tasks, "author_id")


def author_rows(rows: DataFrame) -> DataFrame:
    """researchers() over gathered rows, without what tells the place of an author on a work."""
    works = rows.where("known").groupBy("author_id", "work_id").agg(
        F.min("author_name").alias("name"), F.min("orcid").alias("orcid"), F.sum(F.col("times") * F.coalesce("cited_by_count", F.lit(0))).alias("cites"),
        F.min("publication_year").alias("year"), F.max("publication_year").alias("latest"), F.bit_or("affiliated").alias("bits"),
    )
    return works.groupBy("author_id").agg(
        F.min("name").alias("author_name"), F.min("orcid").alias("orcid"), F.count("*").alias("works"), F.sum("cites").alias("citations"),
        F.min("year").alias("first_year"), F.max("latest").alias("last_year"), F.bit_or("bits").alias("bits"),
    ).withColumn("is_au_nz_affiliated", _at_home(F.col("bits"))).drop("bits")


def _at_home(bits: Column) -> Column:
    """bool_or() of what the bits of gathered rows stand for: null where nothing is known."""
    return F.when(bits.bitwiseAND(F.lit(1)) > 0, True).when(bits.bitwiseAND(F.lit(2)) > 0, False)


def researchers(rw: DataFrame) -> DataFrame:
    """One row an author; of several names or identifiers the smallest, which is deterministic.

    Rows are summed by author and work first, so that distinct works are counted as rows.
    """
    works = rw.groupBy("author_id", "work_id").agg(
        F.min("author_name").alias("name"), F.min(F.nullif("orcid", F.lit(""))).alias("orcid"), F.sum(F.coalesce("cited_by_count", F.lit(0))).alias("cites"),
        F.min("publication_year").alias("year"), F.max("publication_year").alias("latest"), F.bool_or("is_corresponding").alias("corresponding"),
        F.sum(F.when(F.col("author_order") == 1, 1).otherwise(0)).alias("firsts"), F.bool_or("is_au_nz_affiliated").alias("home"),
    )
    return works.groupBy("author_id").agg(
        F.min("name").alias("author_name"), F.min("orcid").alias("orcid"), F.count("*").alias("works"), F.sum("cites").alias("citations"),
        F.min("year").alias("first_year"), F.max("latest").alias("last_year"), F.count_if("corresponding").alias("corresponding_works"),
        F.sum("firsts").alias("first_author_works"), F.bool_or("home").alias("is_au_nz_affiliated"),
    )


def researcher_topics(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Topics of each author, with the tier of the curated topic; rows: gathered(), which its topics multiply only where they are summed."""
    cites = F.col("times") * F.coalesce("cited_by_count", F.lit(0))
    each = rows.where("known").select("author_id", "author_name", "work_id", cites.alias("cites"), F.explode(F.arrays_zip("topics", "scores")).alias("t")).select("author_id", "author_name", "work_id", "cites", F.col("t.topics").alias("topic"), F.col("t.scores").alias("score"))
    summed = each.groupBy("author_id", "author_name", "topic").agg(F.count_distinct("work_id").alias("works"), F.sum("cites").alias("citations"), F.round(F.max("score"), 6).alias("best_score"))
    return summed.join(listed, "topic").select("author_id", "author_name", *TOPIC, "works", "citations", "best_score")


def topic_summary(rt: DataFrame) -> DataFrame:
    """Core and adjacent topics of each author; distinct topics are counted by the sets of an author, so that no row is multiplied or sent for each count."""
    of = lambda tier, x: F.when(F.col("education_relevance_tier") == tier, x)
    distinct = lambda x: F.size(F.collect_set(x)).cast("long")
    return rt.groupBy("author_id").agg(
        distinct(F.col("topic_id")).alias("topics"), distinct(of("core", F.col("topic_id"))).alias("core_topics"), distinct(of("adjacent", F.col("topic_id"))).alias("adjacent_topics"),
        F.coalesce(F.sum(of("core", F.col("works"))), F.lit(0)).alias("core_work_links"), F.coalesce(F.sum(of("adjacent", F.col("works"))), F.lit(0)).alias("adjacent_work_links"),
        text.sorted_list(of("core", F.col("topic_name"))).alias("core_topic_names"),
    )


def top(rows: DataFrame, key: str, order: list[Column], shown: Column, name: str, k: int = 10) -> DataFrame:
    """The first k rows of each key as one string, in order; Spark limits each group before the shuffle."""
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= k)
    listed = F.array_sort(F.collect_list(F.struct("_n", shown.alias("x"))))
    return ranked.groupBy(key).agg(F.array_join(F.transform(listed, lambda r: r["x"]), "; ").alias(name))


def top_topics(rt: DataFrame, k: int = 10) -> DataFrame:
    order = [F.desc("works"), F.desc("citations"), F.asc("topic_id"), F.asc_nulls_last("author_name")]
    return top(rt, "author_id", order, F.concat("topic_name", F.lit(" ("), F.col("works").cast("string"), F.lit(")")), "top_topics", k)


def home_rows(ri: DataFrame, countries=("AU", "NZ")) -> DataFrame:
    return ri.where(F.col("institution_country").isin(*countries))


def institution_counts(ri: DataFrame, countries=("AU", "NZ")) -> DataFrame:
    rows = home_rows(ri, countries)
    return rows.groupBy("author_id", "institution_id", "institution_name", F.coalesce("institution_ror", F.lit("")).alias("institution_ror"), "institution_country").agg(F.count_distinct("work_id").alias("works"))


def main_institution(counts: DataFrame) -> DataFrame:
    w = Window.partitionBy("author_id").orderBy(F.desc("works"), F.asc_nulls_last("institution_name"), "institution_id")
    return counts.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("author_id", F.col("institution_id").alias("main_institution_id"), F.col("institution_name").alias("main_institution_name"), F.col("institution_ror").alias("main_ror"), F.col("institution_country").alias("main_country"))


def institution_summary(counts: DataFrame) -> DataFrame:
    return counts.groupBy("author_id").agg(F.count_distinct("institution_id").alias("institutions"), text.sorted_list(F.col("institution_name")).alias("institution_names"), F.array_join(F.sort_array(F.collect_set("institution_ror")), "; ").alias("rors"))


def top_sources(rw: DataFrame, sources: DataFrame, k: int = 10) -> DataFrame:
    counts = rw.join(sources.select("work_id", "source_name"), "work_id", "left").where("source_name is not null").groupBy("author_id", "source_name").agg(F.count_distinct("work_id").alias("works"))
    return _top_sources(counts, k)


def _top_sources(counts: DataFrame, k: int) -> DataFrame:
    return top(counts, "author_id", [F.desc("works"), F.asc("source_name")], F.concat("source_name", F.lit(" ("), F.col("works").cast("string"), F.lit(")")), "top_sources", k)


def coauthor_summary(edges: DataFrame, authors: DataFrame) -> DataFrame:
    """Coauthors of each author, and those among them without a home affiliation. edges has two authors once."""
    ends = F.array(F.struct(F.col("author_id_a").alias("author_id"), F.col("author_id_b").alias("other")), F.struct(F.col("author_id_b").alias("author_id"), F.col("author_id_a").alias("other")))
    both = edges.select("shared_work_count", F.explode(ends).alias("e")).select("e.author_id", "e.other", "shared_work_count")
    home = authors.select(F.col("author_id").alias("other"), F.coalesce("is_au_nz_affiliated", F.lit(False)).alias("home"))
    return both.join(home, "other", "left").groupBy("author_id").agg(F.count("*").alias("coauthors"), F.count_if(~F.coalesce("home", F.lit(False))).alias("international_coauthors"), F.sum("shared_work_count").alias("shared_works"))


def coauthor_counts(rows: DataFrame, authors: DataFrame, tasks: int) -> DataFrame:
    """coauthor_summary() over gathered rows: authors are numbers while rows are sent, odd ones for those with a home affiliation. No work is left out, however many authors it has."""
    ids = rows.select("author_id").distinct().join(authors.select("author_id", F.coalesce("is_au_nz_affiliated", F.lit(False)).alias("home")), "author_id", "left")
    odd = F.when(F.col("home"), 1).otherwise(0)
    ids = kept_by(ids.select("author_id", (F.monotonically_increasing_id() * 2 + odd).alias("author")), "author_id", tasks, "author_numbers")
    numbered = rows.select("author_id", "work_id", "crowded").join(ids, "author_id")
    pairs = graph.coauthors(numbered.where("not crowded"), tasks)
    if rows.where("crowded").isEmpty():
        counts = graph.partners(pairs)
    else:
        counts = graph.partners_with_crowds(pairs, kept(numbered.where("crowded").select("work_id", "author").distinct(), "crowds"))
    counts = counts.select("author", F.col("others").alias("coauthors"), F.col("even").alias("international_coauthors"), F.col("shared").alias("shared_works"))
    return ids.join(counts, "author").drop("author")


def source_lists(rows: DataFrame, k: int = 10) -> DataFrame:
    """top_sources() over gathered rows."""
    names = F.explode(F.coalesce("more_names", F.array("source_name"))).alias("source_name")
    counts = rows.where("known").select("author_id", "work_id", names).where("source_name is not null").groupBy("author_id", "source_name").agg(F.count_distinct("work_id").alias("works"))
    return _top_sources(counts, k)


def publication_types(rw: DataFrame, times: Column | None = None) -> DataFrame:
    """Authorships of each kind; times: how many a row of rw stands for, one if not given."""
    count = lambda *types: F.sum(F.when(F.col("work_type").isin(*types), F.lit(1) if times is None else times).otherwise(0))
    return rw.groupBy("author_id").agg(count("article").alias("articles"), count("book-chapter").alias("chapters"), count("book").alias("books"), count("review").alias("reviews"), count("preprint").alias("preprints"), count("dataset", "erratum", "retraction", "peer-review").alias("low_relevance"), count("article", "review", "book", "book-chapter").alias("formal_publications"))


def candidates(authors: DataFrame, summary: DataFrame, topics: DataFrame, main: DataFrame, institutions: DataFrame, sources: DataFrame, coauthors: DataFrame, types: DataFrame) -> DataFrame:
    """Home-affiliated researchers with all summaries: a star of left joins on the author."""
    out = authors.where("is_au_nz_affiliated")
    for side in (summary, topics, main, institutions, sources, coauthors, types):
        out = out.join(side, "author_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("core_topics", "adjacent_topics", "coauthors", "international_coauthors", "articles", "formal_publications")}
    return out.withColumns(zero).select(
        "author_id", "author_name", "orcid", "works", "citations", "first_year", "last_year", "core_topics", "adjacent_topics", "top_topics", "main_institution_id", "main_institution_name", "main_ror", "main_country", "institution_names", "top_sources", "coauthors", "international_coauthors", "articles", "formal_publications",
        F.coalesce(F.col("author_name").rlike(r"^[A-Z]\.? [A-Za-z]"), F.lit(False)).alias("possible_initials_name"), ladders.presence_level(F.col("works")).alias("corpus_presence_level"), ladders.topic_profile(F.col("core_topics"), F.col("adjacent_topics")).alias("education_topic_profile"),
    )
