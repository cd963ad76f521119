"""Cleaning and key functions for bibliographic strings, as columns.

Everything runs in the JVM but Unicode normalisation, which Spark lacks: nfkc() and nfc() are Arrow
UDFs, and normalised() sends only the rows through them that they can change.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@pandas_udf(StringType())
def nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def normalised(rows: DataFrame, form, *columns: str) -> DataFrame:
    """rows with these columns in the form given (nfc or nfkc).

    Every form leaves ASCII as it is, so only rows with other characters go through Python; the rest
    stays in the JVM. The order of rows isn't kept.
    """
    odd = reduce(lambda x, y: x | y, (F.coalesce(F.col(c).rlike(r"[^\x00-\x7F]"), F.lit(False)) for c in columns))
    return rows.where(~odd).unionByName(rows.where(odd).withColumns({c: form(F.col(c)) for c in columns}))


def clean(c: Column) -> Column:
    """Trimmed; null becomes empty."""
    return F.coalesce(F.trim(c), F.lit(""))


def clean_text(c: Column, normalise: bool = True) -> Column:
    """Compatibility form, control and format characters deleted, white space squeezed; null stays null."""
    c = nfkc(c) if normalise else c
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\p{C}", ""), r"[\s\p{Z}]+", " "))


def strip_doi_url(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)^https?://(dx\.)?doi\.org/", "")


def normalize_doi(c: Column) -> Column:
    """Trimmed, without resolver or scheme, lower case."""
    return F.lower(F.regexp_replace(strip_doi_url(F.trim(c)), r"(?i)^doi:", ""))


def alphanumeric_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "")


def short_id(c: Column, prefix: str = "") -> Column:
    """The last part of a path; a number gets the prefix."""
    last = F.element_at(F.split(F.regexp_replace(clean(c), "/+$", ""), "/"), -1)
    return F.when(last.rlike(r"^\d+$"), F.concat(F.lit(prefix), last)).otherwise(last)


def issn(c: Column) -> Column:
    """NNNN-NNNX, or empty if it isn't one."""
    digits = F.regexp_replace(F.upper(clean(c)), "[^0-9X]", "")
    return F.when(F.length(digits) == 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 4))).otherwise(F.lit(""))


def orcid(c: Column) -> Column:
    """A bare identifier, or empty if it isn't one."""
    bare = F.upper(F.regexp_replace(F.regexp_replace(clean(c), r"(?i)^(https?://)?(www\.)?orcid\.org/", ""), "/+$", ""))
    return F.when(bare.rlike(r"^\d{4}-\d{4}-\d{4}-\d{3}[\dX]$"), bare).otherwise(F.lit(""))


def _folded(c: Column) -> Column:
    return F.translate(F.translate(c, "‐‑‒–—−", "------"), "’‘ʼ`´", "'''''")


def person_name(c: Column, normalise: bool = True) -> Column:
    c = nfc(c) if normalise else c
    words = F.regexp_replace(_folded(F.lower(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}_\s\p{Z}\-']", " ")
    return F.trim(F.regexp_replace(words, r"[\s\p{Z}]+", " "))


def institution_name(c: Column, normalise: bool = True) -> Column:
    c = nfkc(c) if normalise else c
    words = F.regexp_replace(_folded(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" and "))), r"[^\p{L}\p{N}_\s\p{Z}]", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(words, r"[\s\p{Z}]+", " ")), "^the ", "")


def surname(name: Column) -> Column:
    return F.element_at(F.split(name, " "), -1)


def initials_key(name: Column) -> Column:
    """surname|first letters of the other names; a single name has no key."""
    parts = F.split(name, " ")
    letters = F.array_join(F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.substring(x, 1, 1)), "")
    return F.when(F.size(parts) > 1, F.concat(surname(name), F.lit("|"), letters))


def topic_tokens(c: Column) -> Column:
    """Names in "a (3); b (2)"."""
    names = F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(F.substring_index(x, " (", 1)))
    return F.array_distinct(F.filter(names, lambda x: x != ""))


def sorted_list(c: Column) -> Column:
    """The distinct values of a group, sorted, joined by "; "; null if there is none."""
    return F.nullif(F.array_join(F.sort_array(F.collect_set(c)), "; "), F.lit(""))


def surrogate(prefix: str, width: int, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def hashed(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.sha1(F.concat(*parts)))
