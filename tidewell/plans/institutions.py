"""Institution normalisation, metrics and review cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import text
from tidewell.operators.kept import numbered


def identity_map(ri: DataFrame, normalise: bool = True) -> DataFrame:
    """Each variant of an institution with its canonical one: by ROR, else by id; the fullest variant stands for all."""
    ror = F.nullif("institution_ror", F.lit(""))
    keys = ["institution_id", "institution_name", "institution_ror", "institution_country", "institution_type"]
    variants = ri.groupBy(*keys).agg(F.count("*").alias("links"), F.count_distinct("work_id").alias("works")).withColumn("group_key", F.coalesce(F.concat(F.lit("ROR:"), ror), F.concat(F.lit("OA:"), F.col("institution_id")))).where("group_key is not null")
    best = Window.partitionBy("group_key").orderBy(F.desc("works"), F.desc(F.when(ror.isNotNull(), 1).otherwise(0)), F.desc(F.length("institution_name")), F.asc_nulls_last("institution_name"), F.asc_nulls_last("institution_id"), F.asc_nulls_last("institution_country"))
    chosen = variants.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("group_key", F.col("institution_name").alias("canonical_name"), ror.alias("canonical_ror"), F.col("institution_country").alias("canonical_country"))
    ids = numbered(variants.select("group_key").distinct(), "group_key").select("group_key", text.surrogate("CI", 8, F.col("_n")).alias("canonical_institution_id"))
    chosen = chosen.join(ids, "group_key")
    variants = variants.withColumn("normalised_name", F.col("institution_name"))
    variants = text.normalised(variants, text.nfkc, "normalised_name") if normalise else variants
    basis = F.when(ror.isNotNull(), F.lit("ror")).otherwise(F.lit("openalex_id"))
    return variants.join(chosen, "group_key").select("canonical_institution_id", "canonical_name", "canonical_ror", "canonical_country", *keys, "works", basis.alias("canonicalisation_basis"), text.institution_name(F.col("normalised_name"), False).alias("normalised_name"))


def canonical(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("canonical_institution_id").agg(F.min("canonical_name").alias("canonical_name"), F.min("canonical_ror").alias("canonical_ror"), F.min("canonical_country").alias("canonical_country"), F.count("*").alias("variants"), F.sum("works").alias("variant_works"), text.sorted_list(F.col("institution_name")).alias("name_variants"), text.sorted_list(F.col("institution_id")).alias("source_ids"))


def researcher_links(ri: DataFrame, mapping: DataFrame) -> DataFrame:
    """Author, canonical institution, work; null and empty ROR meet."""
    m = mapping.select("institution_id", F.coalesce("institution_ror", F.lit("")).alias("_ror"), F.coalesce("institution_name", F.lit("")).alias("_name"), "canonical_institution_id")
    rows = ri.withColumns({"_ror": F.coalesce("institution_ror", F.lit("")), "_name": F.coalesce("institution_name", F.lit(""))})
    return rows.join(m, ["institution_id", "_ror", "_name"]).select("author_id", "canonical_institution_id", "work_id").distinct()


def metrics(canon: DataFrame, links: DataFrame, rw: DataFrame) -> DataFrame:
    works = links.join(rw.select("author_id", "work_id", "work_type", F.coalesce("cited_by_count", F.lit(0)).alias("cites")).distinct(), ["author_id", "work_id"], "left")
    own = works.groupBy("canonical_institution_id").agg(F.count_distinct("author_id").alias("researchers"), F.count_distinct("work_id").alias("works"), F.count_distinct(F.when(F.col("work_type") == "article", F.col("work_id"))).alias("articles"))
    cites = works.select("canonical_institution_id", "work_id", "cites").distinct().groupBy("canonical_institution_id").agg(F.sum("cites").alias("citations"))
    return canon.select("canonical_institution_id", "canonical_name").join(own, "canonical_institution_id", "left").join(cites, "canonical_institution_id", "left")


def review_cases(mapping: DataFrame) -> DataFrame:
    """One normalised name within a country that stands for several institutions."""
    return mapping.groupBy("normalised_name", "canonical_country").agg(F.count_distinct("canonical_institution_id").alias("institutions"), text.sorted_list(F.col("canonical_institution_id")).alias("ids"), F.sum("works").alias("works")).where("institutions > 1")
