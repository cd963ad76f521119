"""Scholarly tables laid over the star-schema test tables.

Each view is one SELECT in SQL that Spark and DuckDB both read; nulls, empty strings, spellings and
shared identifiers that the raw tables lack are put in by rules on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.raw_views import RAW_VIEWS
from tidewell.sources.flatten import once_a_row

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

VIEWS = {
    "works_flat": """
        SELECT 'W' || CAST(o_orderkey AS STRING) AS work_id,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
                    WHEN o_orderkey % 5 = 1 THEN 'https://doi.org/10.5555/AbC.' || CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING)
                    WHEN o_orderkey % 5 = 2 THEN 'http://dx.doi.org/10.5555/abc.' || CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING)
                    WHEN o_orderkey % 5 = 3 THEN ' doi:10.5555/ABC.' || CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING)
                    ELSE '10.5555/abc.' || CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING) END AS doi,
               'Work  ' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 4 = 0 THEN ' title ' ELSE ' title' END AS title,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS publication_year,
               CASE o_orderkey % 13 WHEN 0 THEN 'article' WHEN 1 THEN 'review' WHEN 2 THEN 'book' WHEN 3 THEN 'book-chapter' WHEN 4 THEN 'preprint' WHEN 5 THEN 'dataset' WHEN 6 THEN 'dissertation' WHEN 7 THEN 'report' WHEN 8 THEN 'editorial' WHEN 9 THEN 'letter' WHEN 10 THEN 'peer-review' WHEN 11 THEN 'erratum' ELSE 'article' END AS work_type,
               CASE WHEN o_orderkey % 17 = 0 THEN 'proceedings-article' ELSE 'journal-article' END AS type_crossref,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 1000) AS INT) END AS cited_by_count
        FROM {orders}""",
    "work_sources": """
        SELECT 'W' || CAST(o_orderkey AS STRING) AS work_id,
               CASE WHEN c_custkey % 10 IN (0, 1) THEN NULL ELSE 'S' || CAST(c_custkey AS STRING) END AS source_id,
               CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 8 = 3 THEN c_name || ' Proceedings' WHEN o_orderkey % 2 = 0 THEN c_name ELSE upper(c_name) END AS source_name,
               CASE c_custkey % 6 WHEN 0 THEN 'journal' WHEN 1 THEN 'repository' WHEN 2 THEN 'ebook platform' WHEN 3 THEN 'book series' WHEN 4 THEN 'journal' ELSE NULL END AS source_type,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '1234-' || lpad(CAST(c_custkey % 500 AS STRING), 4, '0') END AS issn_l,
               CASE WHEN c_custkey % 4 = 1 THEN '' ELSE '1234-' || lpad(CAST(c_custkey % 500 AS STRING), 4, '0') || '; 5678-' || lpad(CAST(c_custkey % 300 AS STRING), 4, '0') END AS issn,
               'Publisher ' || CAST(c_nationkey AS STRING) AS publisher, o_orderkey % 2 = 0 AS is_oa
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "authorships": """
        SELECT 'W' || CAST(l_orderkey AS STRING) AS work_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax) AS INT) AS author_order,
               CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'A' || CAST(l_partkey AS STRING) END AS author_id,
               p_name || ' ' || p_brand AS author_name,
               CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN '0000-0001-0000-' || lpad(CAST(p_size AS STRING), 4, '0') ELSE '0000-0002-0000-' || lpad(CAST(p_partkey % 9999 AS STRING), 4, '0') END AS orcid,
               l_linenumber = 1 AS is_corresponding, l_suppkey, s_nationkey % 5 = 1 AS is_au_nz_affiliated
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey""",
    "curated_topics": """
        SELECT DISTINCT 'T' || CAST(length(p_type) * 100 + ascii(substr(p_type, 1, 1)) AS STRING) AS topic_id, min(p_type) AS topic_name,
               CASE CAST(ascii(substr(min(p_type), 1, 1)) AS INT) % 3 WHEN 0 THEN 'core' WHEN 1 THEN 'adjacent' ELSE NULL END AS education_relevance_tier
        FROM {part} GROUP BY 'T' || CAST(length(p_type) * 100 + ascii(substr(p_type, 1, 1)) AS STRING)""",
    "work_topics": """
        SELECT 'W' || CAST(l_orderkey AS STRING) AS work_id, 'https://topics.example.org/T' || CAST(length(p_type) * 100 + ascii(substr(p_type, 1, 1)) AS STRING) AS topic_id,
               min(p_type) AS topic_name, round(max(l_discount), 4) AS topic_score
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        GROUP BY 'W' || CAST(l_orderkey AS STRING), 'https://topics.example.org/T' || CAST(length(p_type) * 100 + ascii(substr(p_type, 1, 1)) AS STRING)""",
    "researcher_institutions": """
        SELECT DISTINCT 'A' || CAST(l_partkey AS STRING) AS author_id, 'W' || CAST(l_orderkey AS STRING) AS work_id, 'I' || CAST(s_suppkey AS STRING) AS institution_id,
               CASE WHEN s_suppkey % 9 = 2 THEN 'The ' || s_name || ' & Co.' ELSE s_name END AS institution_name,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 7 = 0 THEN '' ELSE 'R' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING) END AS institution_ror,
               CASE s_nationkey % 5 WHEN 1 THEN 'AU' WHEN 2 THEN 'NZ' WHEN 3 THEN NULL ELSE n_name END AS institution_country, 'education' AS institution_type
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
        WHERE l_partkey % 97 <> 0""",
    "ror_raw": """
        SELECT '{{"id":"R' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING) || '","name":"Org ' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) AS STRING) || '","status":"' || CASE WHEN s_suppkey % 6 = 0 THEN 'inactive' ELSE 'active' END
               || '","links":["http://l' || CAST(s_nationkey AS STRING) || '",{{"type":"website","value":"http://m' || CAST(s_nationkey AS STRING) || '"}}],"domains":["d' || CAST(s_nationkey AS STRING) || '.org","e.org"],"external_ids":{{"GRID":{{"preferred":"g' || CAST(s_suppkey AS STRING) || '","all":["g' || CAST(s_suppkey AS STRING) || '","h"]}}}},'
               || '"relationships":[{{"id":"R' || CAST(CAST(floor(s_suppkey / 4) AS BIGINT) AS STRING) || '","label":"Up","type":"Parent"}},{{"id":"R' || CAST(CAST(floor(s_suppkey / 2) AS BIGINT) + 1 AS STRING) || '","label":"Side","type":"Related"}}]}}' AS raw_json
        FROM {supplier} WHERE s_suppkey % 2 = 0""",
    "journal_registry_seed": """
        SELECT 'J' || CAST(c_custkey AS STRING) AS registry_id, c_name AS title, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '1234-' || lpad(CAST(c_custkey % 500 AS STRING), 4, '0') END AS issn_print,
               CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '5678-' || lpad(CAST(c_custkey % 300 AS STRING), 4, '0') END AS issn_online,
               CASE WHEN c_custkey % 2 = 0 THEN 'AU' ELSE 'NZ' END AS country, CASE c_custkey % 3 WHEN 0 THEN 'core' ELSE 'adjacent' END AS priority_band,
               CASE c_custkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN ' No ' WHEN 2 THEN 'yes' ELSE '' END AS active
        FROM {customer} WHERE c_custkey % 5 = 0""",
    "harvest_log": """
        SELECT event_id, 'run' || CAST(user_id % 4 AS STRING) AS run_id, 'w' || CAST(user_id AS STRING) AS record_id, event_type AS status, value, props AS raw_json, CAST(CAST(ts AS TIMESTAMP) AS STRING) AS seen_at
        FROM {events}""",
}
VIEWS |= RAW_VIEWS


def tables(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}


#: Bytes of Parquet from which a task makes raw records: some ten thousand rows, each of which becomes a kilobyte of JSON.
DEALT = 1 << 20


def dealt(table: DataFrame) -> DataFrame:
    """The rows of files over as many tasks as their bytes ask for, by their key (the first column); a row group, which one task reads, may hold a million rows."""
    files = table.sparkSession.read.format("binaryFile").load(table.inputFiles())  # contents are not read
    tasks = files.agg(F.sum("length")).first()[0] // DEALT
    return table.repartition(tasks, table.columns[0]) if tasks > 1 else table


#: Aggregating views whose rows belong to a work or an author: table, its column, and what stands before it in the key.
KEYED = {"work_topics": ("lineitem", "l_orderkey", "W"), "researcher_institutions": ("lineitem", "l_partkey", "A")}


def keyed(spark: SparkSession, sf_dir: str, name: str, tasks: int) -> DataFrame:
    """A view of KEYED, aggregated in so many tasks by its key: narrow rows are sent to it before they become strings, and no task of a scan sorts or hashes what it reads."""
    table, column, prefix = KEYED[name]
    held = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in VIEWS[name]}
    held[table] = held[table].repartition(tasks, F.concat(F.lit(prefix), F.col(column).cast("string")))
    return spark.sql(VIEWS[name], **held)


def met(spark: SparkSession, sf_dir: str, name: str, table: str) -> DataFrame:
    """A view whose join with this table sends the rows of both to their keys; Spark would broadcast it by the size of its file, which tells little of its rows' size in memory."""
    held = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in VIEWS[name]}
    held[table] = held[table].hint("merge")
    return spark.sql(VIEWS[name], **held)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view; the rows that raw records are made of are dealt out before they become JSON, which is far larger and dear to parse."""
    if name not in RAW_VIEWS:
        return spark.sql(VIEWS[name].format(**tables(spark, sf_dir)))
    raw = spark.sql(VIEWS[name], **{t: dealt(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in TABLES if f"{{{t}}}" in VIEWS[name]})
    return once_a_row(raw, "raw_json", F.col("raw_json")) if "raw_json" in raw.columns else raw


def ctes(*names: str) -> str:
    """WITH clause that defines the views for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)
