"""Joins on keys that a large part of all rows may hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more rows than LEAST, and than one row in MOST of all: so at most MOST keys are.
LEAST, MOST, SALTS = 100_000, 100_000, 64


def hot_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """The hot keys of rows, at most MOST of them; None where no key can be hot. Give it a written table: it is read twice."""
    n = rows.count()
    if n <= LEAST:
        return None
    counted = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    return counted.where((F.col("_rows") > max(LEAST, n // MOST)) & F.col(key).isNotNull()).select(key)


def met(many: DataFrame, one: DataFrame, key: str, hot: DataFrame | None, salts: int = SALTS) -> DataFrame:
    """Inner join of rows with what there is once for their key. A hot key's rows are dealt over salts tasks, to each of which its one row goes."""
    if hot is None:
        return many.join(one, key)
    known = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*many.columns), F.lit(salts))).otherwise(0).cast("int")
    dealt = many.join(known, key, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = one.join(known, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(spread, [key, "_salt"]).drop("_salt")


def without(rows: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """rows but for those of hot keys, told apart before any shuffle."""
    return rows if hot is None else rows.join(F.broadcast(hot), key, "left_anti")
