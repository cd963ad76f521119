"""Graph operators: pairs inside groups, coauthor edges, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.kept import kept
from tidewell.operators.skew import hot_keys, met


def components(nodes: DataFrame | None, edges: DataFrame, rounds: int = 50) -> DataFrame:
    """node, component (its smallest node), by large and small stars; all of nodes are listed, or those of edges.

    A large star ties every larger neighbour of a node to the smallest node that it sees, a small star
    every smaller one; the edges that are left when nothing changes tie each node to its component's
    smallest. A round is four aggregates with map-side combine and two joins; nodes with very many
    neighbours, as the centre of a large component is one, are dealt over several tasks.
    """
    ends = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = kept(edges.where("a != b").select(*ends).distinct(), "edges")
    state = _state(stars)
    for _ in range(rounds):
        if not state[0]:
            break
        stars = kept(_small_star(kept(_large_star(stars), "large_star")), "stars")
        before, state = state, _state(stars)
        if state == before:
            break
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    labels = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = labels.unionByName(labels.select(F.col("component").alias("node"), "component").distinct())
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component")) if nodes is None else nodes.select("node", F.col("node").alias("component"))
    return labels.unionByName(loops.distinct().join(labels.select("node"), "node", "left_anti"))


def _state(stars: DataFrame) -> tuple:
    """Tells a set of edges from another one."""
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """edges: a > b. Of each node's larger neighbours, the edge to the smallest node around it."""
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    least = edges.select(both.alias("e")).groupBy(F.col("e.a").alias("b")).agg(F.least(F.col("e.a"), F.min("e.b")).alias("least"))
    return met(edges, least, "b", hot_keys(edges, "b")).select("a", F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a > b. The edges of each node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    around = met(edges, least, "a", hot_keys(edges, "a"))
    tied = F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b"))))
    return around.select(tied.alias("e")).select("e.a", "e.b").where("a != b").distinct()


def _coauthors(authorships: DataFrame, most_authors: int | None) -> DataFrame:
    """work_id and two of its authors, a < b, with their names there; works with more authors are left out, none if most_authors is None."""
    people = authorships.where("author_id is not null").groupBy("work_id", "author_id").agg(F.min("author_name").alias("name"))
    if most_authors is not None:
        people = people.withColumn("_n", F.count("*").over(Window.partitionBy("work_id"))).where(F.col("_n") <= most_authors)
    a, b = (people.select("work_id", F.col("author_id").alias(f"author_id_{s}"), F.col("name").alias(f"name_{s}")) for s in "ab")
    return a.join(b, "work_id").where("author_id_a < author_id_b")


def shared_works(authorships: DataFrame, most_authors: int | None = 100) -> DataFrame:
    """author_id_a < author_id_b and the number of their shared works."""
    return _coauthors(authorships, most_authors).groupBy("author_id_a", "author_id_b").agg(F.count("*").alias("shared_work_count"))


def _crews(rows: DataFrame, tasks: int, most_authors: int) -> DataFrame:
    """The rows of each work and author once, by work; works with more authors are left out. All of it after one shuffle by work."""
    people = rows.repartition(tasks, "work_id").distinct()
    return people.withColumn("_n", F.count("*").over(Window.partitionBy("work_id"))).where(F.col("_n") <= most_authors).drop("_n")


def shared_works_of(authorships: DataFrame, wanted: DataFrame, tasks: int, most_authors: int | None = 100) -> DataFrame:
    """shared_works() between authors of wanted (author_id), the only ones that are paired; all authors of a work count towards most_authors.

    If wanted also has a block, only authors of one block are paired: with most_authors None, a work then
    gives as many pairs as its authors' blocks have, however many authors it has.
    """
    rows, by = authorships.where("author_id is not null").select("work_id", "author_id"), ["work_id", *(c for c in wanted.columns if c != "author_id")]
    if most_authors is None:
        people = rows.join(wanted, "author_id").repartition(tasks, *by).distinct()
    else:
        people = _crews(rows.join(wanted.withColumn("wanted", F.lit(True)), "author_id", "left"), tasks, most_authors).where("wanted")
    a, b = (people.select(*by, F.col("author_id").alias(f"author_id_{s}")) for s in "ab")
    return a.join(b, by).where("author_id_a < author_id_b").groupBy("author_id_a", "author_id_b").agg(F.count("*").alias("shared_work_count"))


#: A work with more rows of authors is a crowd: its pairs are not listed but counted.
CROWD = 100


def coauthors(rows: DataFrame, tasks: int) -> DataFrame:
    """author, other, shared_work_count; rows: work_id, author (a number of the author), of works that are no crowds.

    An author's row of a work goes back to the author with the list of all there, so that pairs are made
    where they are counted and none is shuffled.
    """
    lists = rows.select("work_id", "author").repartition(tasks, "work_id").distinct().groupBy("work_id").agg(F.collect_list("author").alias("authors"))
    back = lists.where(F.size("authors") > 1).select(F.explode("authors").alias("author"), "authors").repartition(tasks, "author")
    pairs = back.select("author", F.explode("authors").alias("other")).where("author != other")
    return pairs.groupBy("author", "other").agg(F.count("*").alias("shared_work_count"))


def partners(pairs: DataFrame) -> DataFrame:
    """author, how many others it has in pairs, how many of these have an even number, and the works shared with all of them."""
    return pairs.groupBy("author").agg(F.count("*").alias("others"), F.count_if(F.col("other") % 2 == 0).alias("even"), F.sum("shared_work_count").alias("shared"))


def partners_with_crowds(pairs: DataFrame, crowds: DataFrame) -> DataFrame:
    """partners() with those in crowds (work_id, author; distinct, written), without a row for each pair there.

    All who are in the same crowds have the same partners there, so these are counted once for each set
    of crowds that an author has. Others in pairs are new to an author if the two share no crowd.
    """
    of = kept(crowds.groupBy("author").agg(F.sort_array(F.collect_list("work_id")).alias("crowds")), "crowds_of")
    sets = kept(of.select("crowds").distinct().withColumn("crowd_set", F.monotonically_increasing_id()), "crowd_sets")
    each, sizes = sets.select("crowd_set", F.explode("crowds").alias("work_id")), crowds.groupBy("work_id").agg(F.count("*").alias("n"))
    # files of repeated numbers and names are small whatever the rows are: nothing is broadcast by them
    around = each.join(crowds.hint("merge"), "work_id").select("crowd_set", "author").distinct().groupBy("crowd_set").agg(F.count("*").alias("all"), F.count_if(F.col("author") % 2 == 0).alias("all_even"))
    shared = each.join(sizes.hint("merge"), "work_id").groupBy("crowd_set").agg(F.sum(F.col("n") - 1).alias("shared"))
    counted = of.join(sets.join(around, "crowd_set").join(shared, "crowd_set").hint("merge"), "crowds")
    there = counted.select("author", (F.col("all") - 1).alias("others"), (F.col("all_even") - F.when(F.col("author") % 2 == 0, 1).otherwise(0)).alias("even"), "shared")
    both = pairs.join(of.hint("merge"), "author", "left").join(of.select(F.col("author").alias("other"), F.col("crowds").alias("their")).hint("merge"), "other", "left")
    new = ~F.coalesce(F.arrays_overlap("crowds", "their"), F.lit(False))
    apart = both.groupBy("author").agg(F.count_if(new).alias("others"), F.count_if(new & (F.col("other") % 2 == 0)).alias("even"), F.sum("shared_work_count").alias("shared"))
    return there.unionByName(apart).groupBy("author").agg(*(F.sum(c).alias(c) for c in ("others", "even", "shared"))).where("others > 0")


def coauthor_edges(authorships: DataFrame, most_authors: int | None = 100, sample: int = 50) -> DataFrame:
    """author_id_a < author_id_b, their shared works (count, first ones), and their names in the first.

    Only the works of the sample are sorted and sent, at most sample a pair and task, however many two
    people share; the count is an aggregate of its own.
    """
    pairs, two = _coauthors(authorships, most_authors), ["author_id_a", "author_id_b"]
    first = pairs.withColumn("_r", F.row_number().over(Window.partitionBy(*two).orderBy("work_id"))).where(F.col("_r") <= sample)
    listed = first.groupBy(*two).agg(
        F.min_by("name_a", "work_id").alias("name_a"), F.min_by("name_b", "work_id").alias("name_b"),
        F.array_join(F.sort_array(F.collect_list("work_id")), "; ").alias("sample_work_ids"),
    )
    return listed.join(shared_works(authorships, most_authors), two).select(*two, "name_a", "name_b", "shared_work_count", "sample_work_ids")
