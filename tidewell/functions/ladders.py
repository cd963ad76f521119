"""Classification ladders; the first rung that holds wins, and a null condition doesn't hold.

The labels and the work and source types tested are fixed values: results have to carry them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rungs: list[tuple[Column, str]], otherwise: str) -> Column:
    out = None
    for cond, label in rungs:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def has(c: Column, *terms: str) -> Column:
    found = F.lit(False)
    for t in terms:
        found = found | F.contains(F.lower(c), F.lit(t))
    return found


def source_class(name: Column, kind: Column) -> Column:
    return ladder([(name.isNull(), "missing_source"), (kind == "journal", "scholarly_journal"), (kind == "repository", "repository_or_preprint_platform"), (kind == "ebook platform", "ebook_platform"), (kind == "book series", "book_series"), (has(name, "proceeding", "conference"), "conference_or_proceedings")], "other_source")


def output_class(name: Column, kind: Column, work: Column, crossref: Column) -> Column:
    return ladder(
        [(name.isNull(), "missing_source"), (work == "preprint", "preprint"), (work == "dataset", "dataset"), (work == "dissertation", "dissertation"), (work == "book", "book"), (work == "book-chapter", "book_chapter"), ((work == "review") & (kind == "journal"), "journal_review_article"), ((work == "article") & (kind == "journal"), "journal_article"), ((work == "article") & (kind == "repository"), "repository_article_or_preprint_record"), ((work == "review") & (kind == "repository"), "repository_review_or_preprint_record"), (work.isin("editorial", "letter"), "editorial_or_letter"), (work == "report", "report"), (work == "peer-review", "peer_review_record"), (kind == "ebook platform", "ebook_platform_record"), (kind == "book series", "book_series_record"), (has(name, "proceeding", "conference") | has(crossref, "proceeding"), "conference_output")],
        "other_output",
    )


def output_flags(name: Column, kind: Column, work: Column) -> dict[str, Column]:
    article = work.isin("article", "review") & (kind == "journal")
    return {
        "is_journal_article_like": flag(article),
        "is_standard_journal_article": flag((work == "article") & (kind == "journal")),
        "is_review_article": flag((work == "review") & (kind == "journal")),
        "is_peer_review_likely": flag(article),
        "is_repository_or_preprint_like": flag(kind == "repository") | flag(work == "preprint"),
        "is_book_or_chapter_like": flag(work.isin("book", "book-chapter")) | flag(kind.isin("ebook platform", "book series")),
        "is_grey_literature_likely": flag(work.isin("report", "dissertation")) | flag(kind == "repository") | name.isNull(),
        "is_data_output": flag(work == "dataset"),
        "is_missing_source": name.isNull(),
    }


def output_family(name: Column, kind: Column, work: Column) -> Column:
    return ladder(
        [(work.isin("article", "review") & (kind == "journal"), "core_scholarly"), (flag(work.isin("book", "book-chapter")) | flag(kind.isin("ebook platform", "book series")), "book_based_scholarly"), (flag(kind == "repository") | flag(work.isin("preprint", "dataset")), "repository_or_open_output"), (work.isin("report", "dissertation"), "grey_literature"), (work.isin("editorial", "letter", "peer-review", "erratum", "paratext", "retraction"), "scholarly_service_or_minor_output"), (name.isNull(), "source_missing")],
        "other",
    )


def presence_level(n: Column) -> Column:
    return ladder([(n >= 10, "substantial"), (n >= 3, "moderate")], "small")


def topic_profile(core: Column, adjacent: Column) -> Column:
    return ladder([((core > 0) & (adjacent > 0), "core_and_adjacent"), (core > 0, "core_only"), (adjacent > 0, "adjacent_only")], "unclassified")


def registry_active(c: Column) -> Column:
    """true, false or null."""
    c = F.lower(F.trim(c))
    return F.when(c.isin("true", "yes", "1", "active"), F.lit(True)).when(c.isin("false", "no", "0", "inactive"), F.lit(False))
