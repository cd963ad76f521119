"""Readers and fetchers: curated CSV files, JSON dumps, and keyed lookups with limits and retries.

A lookup never fails its task: an error becomes a row with status -1 and its text. Rate limits hold
for the whole job, because each of n partitions waits n times the interval between its requests.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.functions import text
from tidewell.operators import store
from tidewell.operators.kept import numbered
from tidewell.session import ship
from tidewell.sources import json_arrays

#: What counts as a yes, and tiers that are taken without one.
YES, TIERS = ("y", "yes", "include", "included", "true", "1"), ("core", "adjacent", "strong_adjacent")
#: Acquisition priorities, most urgent first.
PRIORITIES = ("highest", "high", "medium", "low")


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as strings, by header; quotes doubled, line breaks in quotes, a byte order mark dropped."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', multiLine=True, enforceSchema=True)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """A dump that is one array: one row an element, as its text; read by many tasks, see json_arrays."""
    return json_arrays.read(spark, path)


def curated_topics(rows: DataFrame, decision: str = "include_decision", tiers=TIERS, first: Column | None = None) -> DataFrame:
    """Topics to harvest; of a repeated id the first by the order given (as a line number), or else by name.

    rows: topic_id, topic_name, education_relevance_tier and the decision column.
    """
    yes = F.lower(F.trim(F.coalesce(decision, F.lit("")))).isin(*YES)
    tier = F.lower(F.trim(F.coalesce("education_relevance_tier", F.lit(""))))
    kept = rows.where(yes | tier.isin(*tiers)).withColumn("topic_id", text.short_id(F.col("topic_id"), "T")).where("topic_id != ''")
    return store.latest(kept, ["topic_id"], [*([] if first is None else [first]), F.asc_nulls_last("topic_name"), F.asc_nulls_last("education_relevance_tier")])


def journal_targets(rows: DataFrame) -> DataFrame:
    """Targets with a surrogate key over family or title and both ISSNs."""
    p, e = text.issn(F.col("print_ISSN")), text.issn(F.col("electronic_ISSN"))
    name = F.coalesce(F.nullif(text.clean(F.col("family_id")), F.lit("")), text.clean(F.col("canonical_title")))
    key = F.concat(F.lit("oajournal_"), F.substring(F.sha1(F.concat_ws("|", name, p, e)), 1, 16))
    return rows.select(key.alias("target_id"), text.clean(F.col("canonical_title")).alias("title"), p.alias("print_issn"), e.alias("electronic_issn"), "acquisition_priority")


def in_priority(targets: DataFrame) -> DataFrame:
    """Targets with the rank of their priority and their place in the scan: by rank, then title."""
    rank = F.lit(len(PRIORITIES) + 1)
    for n, name in enumerate(PRIORITIES, 1):
        rank = F.when(F.col("acquisition_priority") == name, n).otherwise(rank)
    return numbered(targets.withColumn("priority_rank", rank), "priority_rank", F.asc_nulls_last("title"), "target_id", name="scan_position")


def topic_filters(topics: DataFrame, countries: tuple[str, ...], first_year: int) -> DataFrame:
    """What a scan of topics asks for: one filter a topic, for pages()."""
    where = f",authorships.institutions.country_code:{'|'.join(countries)},from_publication_date:{first_year}-01-01"
    return topics.select(F.col("topic_id").alias("source_identifier"), F.col("topic_name").alias("source_display_name"), F.lit("topic").alias("source_type"), "education_relevance_tier", F.concat(F.lit("topics.id:"), "topic_id", F.lit(where)).alias("filter"))


def journal_filters(targets: DataFrame, resolved: DataFrame, first_year: int) -> DataFrame:
    """One filter a resolved source of a journal; targets without a source are listed with none."""
    asked = F.concat(F.lit("primary_location.source.id:"), "source_id", F.lit(f",from_publication_date:{first_year}-01-01"))
    return targets.join(resolved.select("target_id", "source_id"), "target_id", "left").select("target_id", F.col("source_id").alias("source_identifier"), F.col("title").alias("source_display_name"), F.lit("journal").alias("source_type"), asked.alias("filter"), F.when(F.col("source_id").isNull(), F.lit("NO_SOURCE_RESOLVED")).alias("status"))


def authorised(token: Callable[[], str], call: Callable[[str, str], tuple[int, str]]) -> Callable[[str], tuple[int, str]]:
    """call(key, token) for lookup(), with a token that the driver fetches once."""
    fetched = token()
    return lambda key: call(key, fetched)


def log_rows(pages_read: DataFrame) -> DataFrame:
    """The harvest log of pages read: the cursor is kept as its hash, page and count as they are."""
    return pages_read.select("timestamp", "topic_id", "topic_display_name", "topic_tier", "page", "works_returned", F.sha2(F.col("cursor").cast("string"), 256).alias("cursor_hash"), "status", "message")


def target_identifiers(targets: DataFrame) -> DataFrame:
    """ISSNs of targets; the electronic one only if it differs."""
    rows = targets.select("target_id", "print_issn", F.expr("stack(2, 'print', print_issn, 'electronic', electronic_issn) AS (kind, issn)"))
    return rows.where("issn != '' AND (kind = 'print' OR issn != print_issn)").select("target_id", "kind", "issn")


def resolve_sources(targets: DataFrame, identifiers: DataFrame, records: DataFrame, cached: DataFrame) -> DataFrame:
    """target_id, source_id, how: what is cached, else by ISSN, else by the exact title. records: id, display_name, issn (array)."""
    todo = targets.join(cached, "target_id", "left_anti")
    by_issn = identifiers.join(todo.select("target_id"), "target_id").join(records.select(F.col("id").alias("source_id"), F.explode("issn").alias("issn")), "issn").select("target_id", "source_id", F.lit("issn").alias("how"))
    rest = todo.join(by_issn, "target_id", "left_anti").withColumn("t", F.lower(F.trim("title")))
    by_title = rest.join(records.select(F.col("id").alias("source_id"), F.lower(F.trim("display_name")).alias("t")), "t").select("target_id", "source_id", F.lit("title").alias("how"))
    return cached.select("target_id", "source_id", F.lit("cached").alias("how")).unionByName(by_issn).unionByName(by_title).dropDuplicates(["target_id", "source_id"])


def retried(call: Callable[[str], tuple[int, str]], key: str, tries: int = 7, wait: Callable[[float], None] = time.sleep) -> tuple[int, str]:
    """call(key) gives status and text; 429, server errors and exceptions are tried again with capped exponential waits, 400 is final."""
    status, body = -1, ""
    for n in range(tries):
        try:
            status, body = call(key)
        except Exception as e:  # the row carries the error
            status, body = -1, str(e)[:2000]
        if status in (200, 400, 404):
            break
        if n + 1 < tries:
            wait(min(300.0, 10.0 * 2**n))
    return status, body


def lookup(keys: DataFrame, column: str, call: Callable[[str], tuple[int, str]], partitions: int = 6, interval: float = 0.12, tries: int = 7) -> DataFrame:
    """column, response_status, raw_json, error_text of every key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0.0
        for batch in batches:
            rows = []
            for key in batch[column]:
                time.sleep(max(0.0, last + partitions * interval - time.monotonic()))
                last = time.monotonic()
                status, body = retried(call, key, tries)
                rows.append((key, status, body if status == 200 else None, None if status == 200 else body[:2000]))
            yield pd.DataFrame(rows, columns=[column, "response_status", "raw_json", "error_text"])

    ship(keys.sparkSession)
    return keys.select(column).distinct().repartition(partitions, column).mapInPandas(run, f"{column} string, response_status int, raw_json string, error_text string")


def pages(call: Callable[[str, str], tuple[list[str], str | None]], targets: DataFrame, column: str, most_pages: int = 10_000) -> DataFrame:
    """Cursor-paged scan: call(target, cursor) gives the records of a page and the next cursor; one task a target."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for target in batch[column]:
                cursor: str | None = "*"
                for page in range(most_pages):
                    records, cursor = call(target, cursor)
                    if not records:
                        break
                    yield pd.DataFrame({column: target, "page": page, "raw_json": records})
                    if not cursor:
                        break

    ship(targets.sparkSession)
    n = max(1, targets.select(column).distinct().count())
    return targets.select(column).distinct().repartition(min(n, 1000), column).mapInPandas(run, f"{column} string, page int, raw_json string")
