"""Canonical institutions enriched from an organisation register: attributes, relationships, identifiers, websites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text
from tidewell.functions.ladders import has

#: Words in the names of organisations that matter for policy, for candidates and for the shorter report.
POLICY_WORDS = ("education", "school", "department", "ministry", "curriculum", "assessment", "acer", "research council", "institute")
POLICY_REPORT_WORDS = ("education", "curriculum", "assessment", "government", "department", "ministry", "institute")


def enriched(canon: DataFrame, organisations: DataFrame, names: DataFrame, aliases: DataFrame, locations: DataFrame, relationships: DataFrame, ids: DataFrame, links: DataFrame) -> DataFrame:
    """Every canonical institution with what the register knows; each side is reduced to one row an organisation before the join."""
    kind = F.lower("relationship_type")
    count = lambda k: F.sum(F.when(kind == k, 1).otherwise(0))
    sides = [
        organisations.select("ror_id", F.col("name").alias("ror_name"), F.col("status").alias("ror_status"), "established"),
        names.groupBy("ror_id").agg(text.sorted_list(F.col("name")).alias("ror_names")),
        aliases.groupBy("ror_id").agg(text.sorted_list(F.col("value")).alias("aliases")),
        locations.groupBy("ror_id").agg(F.min("city").alias("city"), F.min("country_code").alias("country_code"), F.avg("lat").alias("lat"), F.avg("lng").alias("lng")),
        relationships.groupBy("ror_id").agg(F.count("*").alias("relationships"), count("parent").alias("parents"), count("child").alias("children"), count("related").alias("related"), text.sorted_list(F.concat("label", F.lit(" ["), kind, F.lit("]"))).alias("related_names")),
        ids.groupBy("ror_id").agg(text.sorted_list(F.concat("id_type", F.lit(":"), "id_value")).alias("external_ids")),
        links.groupBy("ror_id").agg(text.sorted_list(F.col("value")).alias("websites")),
    ]
    out = canon.withColumnRenamed("canonical_ror", "ror_id")
    for side in sides:
        out = out.join(side, "ror_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("relationships", "parents", "children", "related")}
    return out.withColumns(zero).withColumnRenamed("ror_id", "canonical_ror").withColumn("has_ror_match", F.col("ror_name").isNotNull())


def relationship_edges(canon: DataFrame, relationships: DataFrame) -> DataFrame:
    """Edges from canonical institutions, with the canonical institution at the other end where there is one."""
    a = canon.select(F.col("canonical_ror").alias("ror_id"), "canonical_institution_id", "canonical_name")
    b = canon.select(F.col("canonical_ror").alias("related_ror_id"), F.col("canonical_institution_id").alias("related_institution_id"), F.col("canonical_name").alias("related_canonical_name"))
    return a.join(relationships, "ror_id").join(b, "related_ror_id", "left")


def websites(canon: DataFrame, links: DataFrame, domains: DataFrame) -> DataFrame:
    """All links with all domains of an institution; either may be missing."""
    a = canon.select(F.col("canonical_ror").alias("ror_id"), "canonical_institution_id").where("ror_id is not null")
    return a.join(links.select("ror_id", F.col("value").alias("link")), "ror_id", "left").join(domains.select("ror_id", F.col("value").alias("domain")), "ror_id", "left").where("link is not null OR domain is not null")


def external_ids(canon: DataFrame, ids: DataFrame) -> DataFrame:
    return canon.select(F.col("canonical_ror").alias("ror_id"), "canonical_institution_id").join(ids, "ror_id")


def policy_organisations(canon: DataFrame, words=POLICY_WORDS) -> DataFrame:
    return canon.where(has(F.col("canonical_name"), *words))
