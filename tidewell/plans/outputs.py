"""Publication outputs: cleaned text, canonical sources, classified works, metrics, enrichment scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import ladders, text
from tidewell.operators.kept import numbered


def text_cleaning_review(rows: DataFrame, key: str, column: str, normalise: bool = True) -> DataFrame:
    """Rows whose cleaned text differs from what is stored, null-safely."""
    out = rows.select(key, F.col(column).alias("before"), F.col(column).alias("after"))
    out = (text.normalised(out, text.nfkc, "after") if normalise else out).withColumn("after", text.clean_text(F.col("after"), False))
    return out.where(~F.col("before").eqNullSafe(F.col("after")))


def source_key(source_id: Column, issn_l: Column, name: Column) -> Column:
    """The best identifier there is."""
    full = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(full(source_id), F.concat(F.lit("ISSNL:"), full(issn_l)), F.concat(F.lit("NAME:"), text.alphanumeric_key(name)), F.lit("MISSING_SOURCE"))


def keyed_sources(sources: DataFrame) -> DataFrame:
    return sources.withColumn("source_key", source_key(F.col("source_id"), F.col("issn_l"), F.col("source_name")))


def source_ids(sources: DataFrame) -> DataFrame:
    """source_key, canonical_source_id: the distinct keys, numbered in their order."""
    keys = keyed_sources(sources).select("source_key").distinct()
    return numbered(keys, "source_key").select("source_key", text.surrogate("CS", 8, F.col("_n")).alias("canonical_source_id"))


def canonical_sources(sources: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row a source; ids: source_ids(sources), or none for the sources without their ids."""
    one = keyed_sources(sources).groupBy("source_key").agg(F.min("source_name").alias("source_name"), F.min("source_type").alias("source_type"), F.min("publisher").alias("publisher"), F.count_distinct("work_id").alias("works"), text.sorted_list(F.col("source_name")).alias("name_variants"), text.sorted_list(F.col("issn")).alias("issn_variants"))
    name, kind = F.col("source_name"), F.col("source_type")
    out = (one if ids is None else one.join(ids, "source_key")).withColumn("derived_source_class", ladders.source_class(name, kind))
    return out.withColumns({"is_journal_like": ladders.flag(kind == "journal"), "is_repository_like": ladders.flag(kind == "repository"), "is_book_like": ladders.flag(kind.isin("ebook platform", "book series")), "is_missing_source": name.isNull()})


def work_output_tags(works: DataFrame, sources: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Every work with its source and classes; with ids (source_ids) also with the canonical source's id."""
    side = keyed_sources(sources).select("work_id", "source_name", "source_type", "issn_l", "issn", "is_oa", "source_key")
    df = works.join(side, "work_id", "left").withColumn("source_key", F.coalesce("source_key", F.lit("MISSING_SOURCE")))
    df = df if ids is None else df.join(ids.select("source_key", "canonical_source_id"), "source_key", "left")
    name, kind, work = F.col("source_name"), F.col("source_type"), F.col("work_type")
    df = df.withColumns(ladders.output_flags(name, kind, work))
    return df.withColumns({"derived_output_class": ladders.output_class(name, kind, work, F.col("type_crossref")), "broad_output_family": ladders.output_family(name, kind, work)})


def source_metrics(tags: DataFrame) -> DataFrame:
    count = lambda c: F.sum(F.when(F.col(c), 1).otherwise(0))
    cites = F.col("cited_by_count")
    by = [c for c in ("canonical_source_id", "source_key") if c in tags.columns]
    return tags.groupBy(*by).agg(
        F.count_distinct("work_id").alias("works"), F.sum(F.coalesce(cites, F.lit(0))).alias("citations"), F.round(F.avg(cites), 6).alias("mean_citations"), F.median(cites).alias("median_citations"), F.max(cites).alias("max_citations"),
        F.min("publication_year").alias("first_year"), F.max("publication_year").alias("last_year"), count("is_journal_article_like").alias("journal_articles"), count("is_grey_literature_likely").alias("grey_literature"), count("is_oa").alias("open_access"), text.sorted_list(F.col("derived_output_class")).alias("output_classes"),
    )


def output_type_metrics(tags: DataFrame) -> DataFrame:
    cites = F.col("cited_by_count")
    return tags.groupBy("work_type", "type_crossref", "source_type", "derived_output_class", "broad_output_family").agg(F.count_distinct("work_id").alias("works"), F.sum(F.coalesce(cites, F.lit(0))).alias("citations"), F.round(F.avg(cites), 6).alias("mean_citations"), F.median(cites).alias("median_citations"))


def _doi_rows(tags: DataFrame) -> DataFrame:
    return tags.where("doi is not null and trim(doi) != ''")


def _first_a_doi(rows: DataFrame, order: list[Column]) -> DataFrame:
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("doi_clean").orderBy(*order, F.desc_nulls_last("publication_year"), "work_id")))
    return ranked.where("_n = 1").select("doi_clean", "work_id", "publication_year", "scope_reason")


def scope_books_and_missing(tags: DataFrame) -> DataFrame:
    """Works to look up first: without a source, or book-like."""
    book, missing, work, cls = F.col("is_book_or_chapter_like"), F.col("is_missing_source"), F.col("work_type").isin("book", "book-chapter"), F.col("derived_output_class").isin("book", "book_chapter", "ebook_platform_record", "book_series_record")
    reason = ladders.ladder([(missing & book, "missing_source_and_book_like"), (missing, "missing_source"), (book, "book_or_chapter_like"), (work, "book_work_type"), (cls, "book_output_class")], "other")
    return _doi_rows(tags).where(missing | book | work | cls).select("work_id", text.strip_doi_url(F.trim("doi")).alias("doi_clean"), reason.alias("scope_reason"))


def scope_all(tags: DataFrame) -> DataFrame:
    """One row a DOI."""
    book, missing, family = F.col("is_book_or_chapter_like"), F.col("is_missing_source"), F.col("broad_output_family")
    reason = ladders.ladder([(missing & book, "all_dois_missing_source_and_book_like"), (missing, "all_dois_missing_source"), (book, "all_dois_book_or_chapter_like"), (family == "core_scholarly", "all_dois_core_scholarly"), (family == "repository_or_open_output", "all_dois_repository_or_open_output"), (family == "grey_literature", "all_dois_grey_literature"), (family == "scholarly_service_or_minor_output", "all_dois_minor_or_service_output")], "all_dois_other")
    rows = _doi_rows(tags).withColumns({"doi_clean": text.strip_doi_url(F.trim("doi")), "scope_reason": reason})
    return _first_a_doi(rows, [F.desc("is_missing_source"), F.desc("is_book_or_chapter_like")])


def scope_delta(tags: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """One row a DOI that hasn't been fetched with success; fetched: doi_clean, response_status, or nothing for the whole scope."""
    family = F.col("broad_output_family")
    named = [("core_scholarly",) * 2, ("book_based_scholarly",) * 2, ("repository_or_open_output",) * 2, ("grey_literature",) * 2, ("scholarly_service_or_minor_output", "minor_or_service_output")]
    reason = ladders.ladder([(family == f, f"crossref_delta_{label}") for f, label in named] + [(F.col("is_missing_source"), "crossref_delta_missing_source")], "crossref_delta_other")
    rows = _doi_rows(tags).withColumns({"doi_clean": text.normalize_doi(F.col("doi")), "scope_reason": reason})
    first = _first_a_doi(rows.withColumn("_core", family == "core_scholarly"), [F.desc("_core"), F.desc("is_missing_source")])
    if fetched is None:
        return first
    done = fetched.where("response_status = 200").select(text.normalize_doi(F.col("doi_clean")).alias("doi_clean")).distinct()
    return first.join(done, "doi_clean", "left_anti")


def registry(seed: DataFrame) -> DataFrame:
    return seed.select("registry_id", "title", F.nullif(F.trim("issn_print"), F.lit("")).alias("issn_print"), F.nullif(F.trim("issn_online"), F.lit("")).alias("issn_online"), "country", "priority_band", ladders.registry_active(F.col("active")).alias("is_active"), text.alphanumeric_key(F.col("title")).alias("title_key"))


def registry_identifiers(reg: DataFrame) -> DataFrame:
    return reg.select("registry_id", F.expr("stack(2, 'print', issn_print, 'online', issn_online) AS (kind, issn)")).where("issn is not null")


def registry_coverage(reg: DataFrame, tags: DataFrame) -> DataFrame:
    """Works of each registered journal: an equi join on the single ISSNs instead of a substring search.

    Journals and works that share an ISSN never meet as pairs. Works are counted by ISSN, and by the two
    ISSNs of one journal where a work has both; a journal has the works of its two ISSNs less those that
    have both. Each pair of ISSNs is told once, however many journals have it.
    """
    a, b = F.coalesce("issn_print", "issn_online"), F.nullif("issn_online", F.coalesce("issn_print", "issn_online"))
    journals = reg.withColumns({"_a": a, "_b": b})
    sets = journals.where("_a is not null").select("_a", "_b").distinct()
    wanted = sets.select(F.explode(F.array("_a", "_b")).alias("issn")).where("issn is not null").distinct()
    article = F.col("is_journal_article_like")
    held = F.array_distinct(F.array_compact(F.concat(F.split(F.coalesce("issn", F.lit("")), "; "), F.array("issn_l"))))
    rows = tags.select("work_id", "source_name", "publication_year", "is_journal_article_like", held.alias("held"))
    works = rows.groupBy("work_id").agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("issns"), F.array_distinct(F.flatten(F.collect_list(F.when(article, F.col("held"))))).alias("_articles"))
    one = works.select(F.explode("issns").alias("issn"), "_articles").groupBy("issn").agg(F.count("*").alias("works"), F.count_if(F.array_contains("_articles", F.col("issn"))).alias("journal_articles"))
    names = rows.select("source_name", "publication_year", F.explode("held").alias("issn")).join(wanted, "issn", "left_semi")
    names = names.groupBy("issn", "source_name").agg(F.min("publication_year").alias("first_year"), F.max("publication_year").alias("last_year"))
    names = names.groupBy("issn").agg(F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.collect_set("source_name").alias("names"))
    told = one.join(names, "issn")
    x, y = (told.toDF(*(f"{c}_{s}" if c != "issn" else f"_{s}" for c in told.columns)) for s in "ab")
    two = works.where(F.size("issns") > 1).select(F.explode("issns").alias("_a"), "issns", "_articles").select("_a", F.explode("issns").alias("_b"), "_articles").where("_a != _b")
    two = two.join(sets.where("_b is not null"), ["_a", "_b"], "left_semi").groupBy("_a", "_b").agg(
        F.count("*").alias("works_ab"), F.count_if(F.array_contains("_articles", F.col("_a")) & F.array_contains("_articles", F.col("_b"))).alias("journal_articles_ab")
    )
    met = sets.join(x, "_a", "left").join(y, "_b", "left").join(two, ["_a", "_b"], "left")
    n = lambda c: F.coalesce(f"{c}_a", F.lit(0)) + F.coalesce(f"{c}_b", F.lit(0)) - F.coalesce(f"{c}_ab", F.lit(0))
    found = met.select(
        "_a", F.coalesce("_b", F.lit("")).alias("_b"), n("works").alias("works"), n("journal_articles").alias("journal_articles"), F.least("first_year_a", "first_year_b").alias("first_year"), F.greatest("last_year_a", "last_year_b").alias("last_year"),
        F.nullif(F.array_join(F.array_sort(F.array_union(F.coalesce("names_a", F.array()), F.coalesce("names_b", F.array()))), "; "), F.lit("")).alias("matched_names"),
    )
    out = journals.withColumn("_b", F.coalesce("_b", F.lit(""))).join(found, ["_a", "_b"], "left").drop("_a", "_b")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("works", "journal_articles")})


def registry_bands(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("country", "priority_band").agg(F.count("*").alias("journals"), F.sum(F.when(F.col("works") > 0, 1).otherwise(0)).alias("covered"), F.sum("works").alias("works"), F.count_if("is_active").alias("active"))
