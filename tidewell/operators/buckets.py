"""Keyed tables that a merge rewrites in part: rows lie in folders by a hash of their key, and only the folders that a batch touches are read and written.

A merge is one dynamic partition overwrite: what it reads stays in place until all its tasks have
ended, and a merge that failed can be run again, for every merge here gives the same table a second
time. Two merges of one table must not run at the same time.

Null keys are keys like others. A key that holds very many rows (children of one parent) is dealt over
several files of its bucket by the rebalancing of adaptive execution. A bucket that has lost its last
row is told from one that wasn't touched by a row that is none (NONE is true), which readers leave out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import store
from tidewell.operators.kept import kept

BUCKET, NONE = "bucket_of_key", "is_no_row"


@dataclass(frozen=True)
class Buckets:
    """The table at a path; schema as DDL. The number of buckets and the keys are the table's and don't change."""

    path: str
    schema: str
    keys: tuple[str, ...]
    count: int

    @staticmethod
    def create(rows: DataFrame, path: str, keys: list[str], count: int = 256) -> Buckets:
        """A new table with these rows."""
        spark, schema = rows.sparkSession, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        spark.createDataFrame([(schema, keys, count)], "schema string, keys array<string>, count int").coalesce(1).write.parquet(f"{path}/about")
        table = Buckets(path, schema, tuple(keys), count)
        table._write(rows, list(range(count)))
        return table

    @staticmethod
    def open(spark: SparkSession, path: str) -> Buckets:
        about = spark.read.parquet(f"{path}/about").first()
        return Buckets(path, about["schema"], tuple(about["keys"]), about["count"])

    def rows(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(BUCKET)

    def old(self, spark: SparkSession, touched: list[int]) -> DataFrame:
        """The stored rows of these buckets; no other folder is read."""
        return self._stored(spark).where(F.col(BUCKET).isin(touched)).drop(BUCKET)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of rows: at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def upsert(self, new: DataFrame, order: list[Column]) -> list[int]:
        """New rows replace old ones of their key; of several the first in the order. Tells which buckets were rewritten."""
        return self.merge(new, lambda old: store.upsert(old, new, list(self.keys), order))

    def put(self, new: DataFrame) -> list[int]:
        """upsert() of wide rows of which there is one a key, no key null: only keys are sent to be compared, and no row to be written.

        Each task writes what it has of every bucket, so it suits tables of few buckets. Old rows are
        sent only if new ones replace any of them.
        """
        touched = self.touched(new)
        if touched:
            old, keys = self.old(new.sparkSession, touched), list(self.keys)
            same = kept(old.select(*keys).join(new.select(*keys), keys, "left_semi"), "replaced")
            self._write((old if same.isEmpty() else old.join(same, keys, "left_anti")).unionByName(new), touched, dealt=False)
        return touched

    def insert_absent(self, new: DataFrame, order: list[Column]) -> list[int]:
        """Rows of keys that the table doesn't hold; of several the first in the order."""
        return self.merge(new, lambda old: store.insert_absent(old, new, list(self.keys), order))

    def replace_children(self, new: DataFrame, parents: DataFrame) -> list[int]:
        """All rows of the parents' keys go, the new rows of these keys come."""
        parents = parents.select(*self.keys).distinct()
        own = new.join(parents, store._same(new, parents, list(self.keys)), "left_semi")
        return self.merge(parents, lambda old: store.replace_children(old, own, parents, list(self.keys)))

    def delete(self, gone: DataFrame) -> list[int]:
        """All rows of the keys in gone go."""
        return self.replace_children(self.rows(gone.sparkSession).limit(0), gone)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int").alias(BUCKET)

    def _stored(self, spark: SparkSession) -> DataFrame:
        stored = spark.read.schema(f"{self.schema}, {NONE} boolean, {BUCKET} int").parquet(f"{self.path}/rows")
        return stored.where(F.col(NONE).isNull()).drop(NONE)

    def merge(self, by: DataFrame, merge) -> list[int]:
        """The buckets of by get the rows that merge makes of their old ones; a merge that may run twice has to give the same then."""
        touched = self.touched(by)
        if touched:
            self._write(merge(self.old(by.sparkSession, touched)), touched)
        return touched

    def _write(self, rows: DataFrame, touched: list[int], dealt: bool = True) -> None:
        """dealt: whether rows are sent to as few tasks a bucket as they fit into."""
        placed = rows.select("*", F.lit(None).cast("boolean").alias(NONE), self._bucket())
        marks = rows.sparkSession.createDataFrame([(True, b) for b in touched], f"{NONE} boolean, {BUCKET} int")
        whole = placed.unionByName(marks, allowMissingColumns=True)
        whole, codec = (whole.hint("rebalance", BUCKET), None) if dealt else (whole, "zstd")
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{self.path}/rows", compression=codec)
