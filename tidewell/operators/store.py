"""Write semantics over immutable tables: upserts, first-seen inserts, child replacement, counters, ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the order given (make it total)."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """New rows replace old rows of their key; among new rows of a key the first in the order wins."""
    new = latest(new, keys, order)
    return old.join(new, _same(old, new, keys), "left_anti").unionByName(new)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Old rows stay; new keys are added, the first in the order."""
    new = latest(new, keys, order)
    return old.unionByName(new.join(old, _same(new, old, keys), "left_anti"))


def replace_children(old: DataFrame, new: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """All children of the parents given are replaced by the new ones, also if there are none."""
    return old.join(parents, _same(old, parents, keys), "left_anti").unionByName(new)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that the condition holds for go; where it is null the row stays, as in SQL."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def count_seen(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """first_seen, latest_seen and seen_count of each key; new has a row and a seen_at for each sighting."""
    seen = new.groupBy(*keys).agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("latest_seen"), F.count("*").alias("seen_count"))
    return old.unionByName(seen).groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("latest_seen").alias("latest_seen"), F.sum("seen_count").alias("seen_count"))


def not_done(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to do: the skip list of a resumed run."""
    return wanted.join(done, _same(wanted, done, keys), "left_anti")


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def create_absent(spark: SparkSession, path: str, schema: str) -> bool:
    """An empty Parquet table at path, unless there is one; tells whether it was made."""
    if _folder(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return True


def append_absent(df: DataFrame, path: str, keys: list[str], order: list[Column]) -> None:
    """Appends to the Parquet table at path the rows whose key isn't in it, one a key."""
    spark, new = df.sparkSession, latest(df, keys, order)
    there = _folder(spark, path)
    (not_done(new, spark.read.schema(df.schema).parquet(path).select(*keys).distinct(), keys) if there else new).write.mode("append").parquet(path)


def publish(tables: dict[str, DataFrame], root: str, batch: str) -> None:
    """Several tables in one step: every table's rows are written to a folder of the batch, the note that publishes it comes last.

    A batch that fails on the way leaves nothing that published() shows; written again, it replaces what
    it left behind, and one that is published already is not written twice.
    """
    spark = next(iter(tables.values())).sparkSession
    note = f"{root}/_batches/batch={batch}"
    if _folder(spark, note):
        return
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
    spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").parquet(note)


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table's rows of all published batches, with their batch; the others' folders are pruned."""
    done = spark.read.parquet(f"{root}/_batches").select(F.col("batch").cast("string").alias("batch"))
    rows = spark.read.parquet(f"{root}/{table}")
    return rows.withColumn("batch", F.col("batch").cast("string")).join(F.broadcast(done) if done.count() <= 100_000 else done, "batch", "left_semi")


def _folder(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at path, on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
