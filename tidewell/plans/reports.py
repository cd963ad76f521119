"""Review exports and snapshot reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import text


def counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.median("cited_by_count").alias("median_citations"))


def top_sources_by_class(metrics: DataFrame, sources: DataFrame, k: int = 5) -> DataFrame:
    rows = metrics.join(sources.select("source_key", "source_name", "derived_source_class"), "source_key")
    w = Window.partitionBy("derived_source_class").orderBy(F.desc("metrics_works"), "source_key")
    ranked = rows.withColumnRenamed("works", "metrics_works").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("derived_source_class", "rank", "source_key", "source_name", F.col("metrics_works").alias("works"))


def odd_names(sources: DataFrame) -> DataFrame:
    """Names with their bytes, and how many sources share each."""
    w = F.count("*").over(Window.partitionBy("source_name"))
    return sources.where("source_name is not null").select("source_name", "source_key", F.hex("source_name").alias("name_hex"), w.alias("same_name"), F.col("source_name").rlike(r"[\x00-\x1F\x7F-\x9F]").alias("has_control")).distinct()


def name_variants(sources: DataFrame) -> DataFrame:
    """Source names that differ only in spelling."""
    rows = sources.where("source_name is not null").withColumn("name_key", text.alphanumeric_key(F.col("source_name")))
    return rows.groupBy("name_key").agg(F.count_distinct("source_name").alias("spellings"), text.sorted_list(F.col("source_name")).alias("names"), F.count_distinct("work_id").alias("works")).where("spellings > 1")


def researcher_outputs(rw: DataFrame, tags: DataFrame, tasks: int, least: int = 3) -> DataFrame:
    """Shares of output families of each author.

    A work's families are told once, and authors meet them by work; what goes on to an author is a row a
    work with two flags, counted there as rows. tasks share the rows of either step.
    """
    of = lambda f: F.bool_or(F.coalesce(F.col("broad_output_family") == f, F.lit(False)))
    works = tags.select("work_id", "broad_output_family").repartition(tasks, "work_id").groupBy("work_id").agg(of("core_scholarly").alias("core"), of("repository_or_open_output").alias("repository"))
    rows = rw.select("work_id", "author_id").repartition(tasks, "work_id").distinct().join(works, "work_id")
    out = rows.select("author_id", "core", "repository").repartition(tasks, "author_id").groupBy("author_id").agg(F.count("*").alias("works"), F.count_if("core").alias("core"), F.count_if("repository").alias("repository"))
    return out.where(F.col("works") >= least).withColumn("repository_share", F.round(F.when(F.col("works") > 0, F.col("repository").cast("double") / F.col("works")), 6))


def missingness(works: DataFrame, sources: DataFrame) -> DataFrame:
    """One row of counts: what is there and what is missing."""
    rows = works.join(sources.select("work_id", "source_id", "source_name", "issn", "issn_l"), "work_id", "left")
    lack = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == ""))
    return rows.agg(F.count("*").alias("works"), F.count("doi").alias("doi_present"), lack("doi").alias("doi_missing"), F.count_if(F.col("publication_year").isNull()).alias("year_missing"), F.count("issn").alias("issn_present"), lack("issn_l").alias("issn_l_missing"), F.count_if(F.col("source_id").isNull()).alias("source_missing"), F.count_distinct("source_name").alias("source_names"))


def by_year(tags: DataFrame) -> DataFrame:
    return tags.groupBy("publication_year").agg(F.count("*").alias("works"), F.count_if("is_journal_article_like").alias("articles"), F.count_if("is_missing_source").alias("missing_source"), F.sum(F.coalesce("cited_by_count", F.lit(0))).alias("citations"))


def breakdown(rows: DataFrame, *by: str) -> DataFrame:
    """How many rows of each kind, most first."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *(F.asc_nulls_last(c) for c in by))


def breakdowns(rows: DataFrame, sets: dict[str, tuple[str, ...]], *counts) -> DataFrame:
    """All breakdowns of a layer from one scan and one shuffle: breakdown (its name), the columns of all sets, and the counts.

    A column that a breakdown isn't by is null; a null of the data is told from that by the breakdown's name.
    """
    columns = list(dict.fromkeys(c for by in sets.values() for c in by))
    # grouping_id has a bit a column, the first one highest; set where the breakdown isn't by the column
    ids = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in by): name for name, by in sets.items()}
    name = F.element_at(F.create_map(*(F.lit(x) for pair in ids.items() for x in pair)), F.col("_id").cast("int"))
    grouped = rows.groupingSets([[F.col(c) for c in by] for by in sets.values()], *columns).agg(F.grouping_id().alias("_id"), *counts)
    return grouped.withColumn("breakdown", name).drop("_id")


def top_rows(rows: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in a total order; Spark keeps n a task."""
    return rows.orderBy(*order).limit(n)


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """n rows by the hash of their key: the same ones each time, from the rows given (so filter first)."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def collapsed_variants(canon: DataFrame) -> DataFrame:
    """Institutions that stand for several variants."""
    return canon.where("variants > 1").select("canonical_institution_id", "canonical_name", "canonical_country", "canonical_ror", "variants", "variant_works", "name_variants")


def home_institutions(canon: DataFrame, metrics: DataFrame, countries=("AU", "NZ")) -> DataFrame:
    return canon.where(F.col("canonical_country").isin(*countries)).join(metrics.drop("canonical_name"), "canonical_institution_id").select("canonical_institution_id", "canonical_name", "canonical_country", "researchers", "works", "name_variants")


def sources_like(metrics: DataFrame, sources: DataFrame, flag: str) -> DataFrame:
    """Sources with the flag, with their works."""
    return sources.where(F.col(flag)).select("canonical_source_id", "source_name", "derived_source_class").join(metrics.select("canonical_source_id", "works", "citations", "median_citations"), "canonical_source_id")


def missing_sources(tags: DataFrame) -> DataFrame:
    return tags.where("is_missing_source").select("work_id", "title", "doi", "work_type", "derived_output_class", "publication_year")


def repository_heavy(outputs: DataFrame, share: float = 0.25) -> DataFrame:
    return outputs.where((F.col("works") >= 5) & (F.col("repository_share") >= share))


def table_counts(spark, tables: list[str]) -> DataFrame:
    """Rows of each table, or why it can't be read."""
    rows = []
    for t in tables:
        try:
            rows.append((t, spark.table(t).count(), None))
        except Exception as e:  # the report lists it
            rows.append((t, None, str(e)[:200]))
    return spark.createDataFrame(rows, "table_name string, row_count long, error string")


def export_csv(rows: DataFrame, folder: str) -> None:
    """One CSV file with a header; for review exports, which are small."""
    rows.coalesce(1).write.mode("overwrite").csv(folder, header=True, quote='"', escape='"')


def markdown(rows: DataFrame, most: int = 50) -> str:
    """A small result as a Markdown table; bars escaped, null empty."""
    show = lambda x: "" if x is None else str(x).replace("|", "\\|")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(show, r)) + " |" for r in rows.limit(most).collect()])
