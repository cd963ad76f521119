"""Identity resolution: blocking, evidence, confidence, components, canonical researchers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ladders, text
from tidewell.operators.graph import components
from tidewell.operators.kept import kept, numbered
from tidewell.operators.skew import hot_keys, without
from tidewell.plans import researchers

#: Block sizes and scores.
NAME_BLOCK, INITIALS_BLOCK = (2, 50), (2, 20)


#: The ways in which two people come to be compared: basis, key, sizes of blocks, score.
BASES = (("same_normalised_name", "name_key", NAME_BLOCK, 30), ("same_surname_initials", "initials_key", INITIALS_BLOCK, 10))


def with_keys(people: DataFrame, normalise: bool = True) -> DataFrame:
    """people with the keys of their blocks; only names that aren't ASCII go through Unicode normalisation."""
    people = text.normalised(people.withColumn("name_key", F.col("author_name")), text.nfc, "name_key") if normalise else people.withColumn("name_key", F.col("author_name"))
    return people.withColumn("name_key", text.person_name(F.col("name_key"), False)).withColumn("initials_key", text.initials_key(F.col("name_key")))


def census(people: DataFrame, key: str) -> DataFrame:
    """key, members: how many people each block has; a map-side combined count, whatever their sizes."""
    return people.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count("*").alias("members"))


def dropped_blocks(people: DataFrame) -> DataFrame:
    """basis, block_key, members of the blocks that are too large to tell anything; people with their keys."""
    large = [census(people, key).where(F.col("members") > sizes[1]).select(F.lit(basis).alias("basis"), F.col(key).alias("block_key"), "members") for basis, key, sizes, _ in BASES]
    return large[0].unionByName(large[1])


def in_blocks(people: DataFrame) -> DataFrame:
    """author_id and block of all who are in a block of a permitted size, and so may be in a pair.

    Whoever has the same name has the same initials, so one block tells all of an author's pairs: that of
    the initials, or that of the name where the former is of no permitted size.
    """
    blocks = (_sized(people, key, sizes).select("author_id", F.struct(F.lit(key == "name_key").alias("n"), F.col(key).alias("block")).alias("b")) for _, key, sizes, _ in BASES)
    return reduce(DataFrame.unionByName, blocks).groupBy("author_id").agg(F.min("b").alias("b")).select("author_id", "b.block")


def _sized(people: DataFrame, key: str, sizes: tuple[int, int]) -> DataFrame:
    """The people in blocks of a permitted size. Those of a name that very many have go before the shuffle, those of other large blocks before the join."""
    rows = without(people.select(key, "author_id"), key, hot_keys(people, key))
    return rows.join(census(rows, key).where(F.col("members").between(*sizes)), key, "left_semi")


def _block(people: DataFrame, basis: str, key: str, sizes: tuple[int, int], score: int) -> DataFrame:
    """Pairs inside blocks of a permitted size."""
    sized = _sized(people, key, sizes)
    return sized.toDF(key, "a").join(sized.toDF(key, "b"), key).where("a < b").select("a", "b", F.lit(score).alias("score"), F.lit(basis).alias("basis"))


def candidate_pairs(people: DataFrame, edges: DataFrame) -> DataFrame:
    """Scored pairs; people: author_id, author_name, orcid, works, main_ror, main_institution_name, top_topics, and the keys of with_keys; edges: shared works of two authors."""
    blocks = reduce(DataFrame.unionByName, (_block(people, *basis) for basis in BASES))
    pairs = blocks.groupBy("a", "b").agg(F.sum("score").alias("block_score"), F.collect_set("basis").alias("basis"))
    side = people.select("author_id", F.nullif("orcid", F.lit("")).alias("orcid"), "works", F.nullif("main_ror", F.lit("")).alias("ror"), F.nullif(text.institution_name(F.col("main_institution_name"), False), F.lit("")).alias("inst"), text.topic_tokens(F.col("top_topics")).alias("topics"))
    x, y = (side.toDF(*(f"{c}_{s}" if c != "author_id" else s for c in side.columns)) for s in "ab")
    shared = edges.select(F.col("author_id_a").alias("a"), F.col("author_id_b").alias("b"), "shared_work_count")
    df = pairs.join(x, "a").join(y, "b").join(shared, ["a", "b"], "left")
    both_orcid = F.col("orcid_a").isNotNull() & F.col("orcid_b").isNotNull()
    same_ror, same_inst = F.col("ror_a") == F.col("ror_b"), F.col("inst_a") == F.col("inst_b")
    overlap, works = F.size(F.array_intersect("topics_a", "topics_b")), F.coalesce("shared_work_count", F.lit(0))
    evidence = [
        (both_orcid & (F.col("orcid_a") == F.col("orcid_b")), 100, "same_orcid"), (both_orcid & (F.col("orcid_a") != F.col("orcid_b")), -100, "different_orcid"),
        (same_ror, 30, "same_main_ror"), (same_inst & ~F.coalesce(same_ror, F.lit(False)), 20, "same_main_institution_name"),
        (overlap >= 3, 20, "topic_overlap_3plus"), ((overlap >= 1) & (overlap < 3), 8, "topic_overlap"),
        (works >= 3, 60, "shared_works_3plus"), ((works >= 1) & (works < 3), 30, "shared_work"), ((F.col("works_a") <= 1) | (F.col("works_b") <= 1), 10, "one_profile_tiny"),
    ]
    score = sum((F.when(c, s).otherwise(0) for c, s, _ in evidence), F.col("block_score"))
    found = F.array_sort(F.array_union("basis", F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, _, t in evidence)))))
    df = df.select("a", "b", score.cast("int").alias("score"), F.array_join(found, "; ").alias("evidence"), evidence[0][0].alias("_same"), evidence[1][0].alias("_other"))
    level = ladders.ladder([(F.col("_other"), "reject_or_review"), (F.col("_same"), "very_high"), (F.col("score") >= 90, "high"), (F.col("score") >= 60, "medium"), (F.col("score") >= 35, "low")], "very_low")
    return df.withColumn("confidence", level).where("confidence != 'very_low'").select(F.col("a").alias("author_id_a"), F.col("b").alias("author_id_b"), "score", "confidence", "evidence")


def canonical(people: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each author with its canonical one: very_high components, the strongest member stands for all; ids count components by smallest author."""
    edges = pairs.where("confidence = 'very_high'").select(F.col("author_id_a").alias("a"), F.col("author_id_b").alias("b"))
    member = components(people.select(F.col("author_id").alias("node")), edges)
    best = F.max(F.struct("works", "citations", F.col("orcid").isNotNull().alias("has"), "author_id"))
    strong = people.join(member, people.author_id == member.node).groupBy("component").agg(best.alias("best"), F.count("*").alias("members"))
    strong = kept(strong, "strongest")
    out = member.join(strong, "component").join(numbered(strong.select("component"), "component"), "component")
    status = F.when(F.col("members") > 1, F.lit("auto_merged_very_high")).otherwise(F.lit("singleton"))
    return out.select(F.col("node").alias("author_id"), text.surrogate("CR", 8, F.col("_n")).alias("canonical_id"), F.col("best.author_id").alias("canonical_author_id"), F.col("members").alias("member_count"), status.alias("merge_status"), F.when(F.col("node") == F.col("best.author_id"), F.lit("canonical_self")).otherwise(F.lit("mapped_to_canonical")).alias("map_status"))


def groups(people: DataFrame, pairs: DataFrame) -> DataFrame:
    """Authors that pairs of medium or better confidence connect, by group; groups are numbered by their smallest author."""
    edges = pairs.where("confidence IN ('very_high', 'high', 'medium')").select(F.col("author_id_a").alias("a"), F.col("author_id_b").alias("b"))
    member = kept(components(None, edges), "groups")
    sized = numbered(member.groupBy("component").agg(F.count("*").alias("group_size")), "component")
    return member.join(sized, "component").join(people, F.col("node") == F.col("author_id")).select(
        text.surrogate("ICG", 7, F.col("_n")).alias("candidate_group_id"), "author_id", "author_name", "orcid", "works", "citations", F.col("main_institution_name").alias("main_institution"), "group_size"
    )


def candidate_authors(candidates: DataFrame, grouped: DataFrame) -> DataFrame:
    """Every candidate, with its group if it may be someone's duplicate."""
    found = grouped.select("author_id", "candidate_group_id", "group_size")
    return candidates.join(found, "author_id", "left").withColumn("possible_identity_duplicate", F.col("candidate_group_id").isNotNull())


def _canonical_works(rows: DataFrame, own: DataFrame, tasks: int) -> DataFrame:
    """canonical_id and the figures of its authors' works; rows: gathered, own: author_id, canonical_id, member_count.

    All is summed by author first, where the rows are. Only the works of researchers with several
    authors are sent to be counted once for all of these.
    """
    kind = lambda *names: F.sum(F.when(F.col("work_type").isin(*names), F.col("versions")).otherwise(0))
    works = rows.where("known").groupBy("author_id", "work_id", "work_type", "publication_year", "cited_by_count").agg(F.bit_or("affiliated").alias("bits"))
    works = works.withColumn("versions", F.bit_count("bits"))  # a work counts once for each affiliation that it is told with
    kinds = {"articles": ("article",), "reviews": ("review",), "books": ("book",), "chapters": ("book-chapter",), "preprints": ("preprint",), "low_relevance": ("dataset", "erratum", "retraction", "peer-review")}
    sums = ("citations", "au_nz_affiliated_authorships", *kinds)
    authors = works.groupBy("author_id").agg(
        F.count_distinct("work_id").alias("works"), F.sum(F.coalesce("cited_by_count", F.lit(0)) * F.col("versions")).alias("citations"), F.count_if(F.col("bits").bitwiseAND(F.lit(1)) > 0).alias("au_nz_affiliated_authorships"),
        *(kind(*names).alias(n) for n, names in kinds.items()),
    )
    years = works.groupBy("author_id").agg(F.collect_set("publication_year").alias("years"))
    found = authors.join(years, "author_id").join(own, "author_id").groupBy("canonical_id").agg(
        F.count("*").alias("source_authors"), F.max("works").alias("works"), F.array_distinct(F.flatten(F.collect_list("years"))).alias("years"), *(F.sum(c).alias(c) for c in sums)
    )
    merged = rows.where("known").select("author_id", "work_id").join(own.where("member_count > 1"), "author_id").select("canonical_id", "work_id").repartition(tasks, "canonical_id").distinct()
    merged = merged.groupBy("canonical_id").agg(F.count("*").alias("merged_works"))
    return found.join(merged, "canonical_id", "left").select(
        "canonical_id", "source_authors", F.coalesce("merged_works", "works").alias("works"), "citations", F.array_min("years").alias("first_year"), F.array_max("years").alias("last_year"), F.size("years").cast("long").alias("active_years"),
        "au_nz_affiliated_authorships", *kinds, F.expr("articles + reviews + books + chapters").alias("formal_publications"),
    )


def canonical_metrics(mapping: DataFrame, people: DataFrame, rows: DataFrame, rt: DataFrame, home: DataFrame, tasks: int) -> DataFrame:
    """Works, topics and institutions of each canonical researcher over all its authors; rows: gathered, home: an author's home institutions by work.

    A work counts once in works, and once for each of the researcher's authors in citations and in the
    counts by type. Of several main institutions with the same works the first by name stands.
    """
    own = mapping.select("author_id", "canonical_id")
    basic = _canonical_works(rows, mapping.select("author_id", "canonical_id", "member_count"), tasks)
    tier = lambda name, x: F.when(F.col("education_relevance_tier") == name, x)
    topic = rt.join(own, "author_id").groupBy("canonical_id").agg(
        *(F.count_distinct(tier(n, F.col("topic_id"))).alias(f"{n}_topics") for n in ("core", "adjacent")),
        *(F.sum(tier(n, F.col("works"))).alias(f"{n}_topic_work_links") for n in ("core", "adjacent")),
    )
    counts = kept(researchers.institution_counts(home.join(own, "author_id").drop("author_id").withColumnRenamed("canonical_id", "author_id").repartition(tasks, "author_id")), "canonical_home")
    places = counts.groupBy("author_id").agg(text.sorted_list(F.col("institution_name")).alias("institution_variants"), text.sorted_list(F.nullif("institution_ror", F.lit(""))).alias("rors"), text.sorted_list(F.col("institution_country")).alias("countries"))
    places = researchers.main_institution(counts).join(places, "author_id").withColumnRenamed("author_id", "canonical_id")
    who = mapping.where("map_status = 'canonical_self'").join(people.select("author_id", F.col("author_name").alias("canonical_name"), F.col("orcid").alias("canonical_orcid")), "author_id")
    who = who.select("canonical_id", "canonical_author_id", "canonical_name", "canonical_orcid", "merge_status", F.when(F.col("member_count") > 1, F.lit("very_high")).otherwise(F.lit("none")).alias("merge_confidence"))
    out = basic.join(who, "canonical_id").join(topic, "canonical_id", "left").join(places, "canonical_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in topic.columns if c != "canonical_id"})
    return out.withColumn("education_topic_profile", ladders.topic_profile(F.col("core_topic_work_links"), F.col("adjacent_topic_work_links")))
