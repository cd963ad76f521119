"""Tables kept between steps, and row numbers over a whole table without a single-task sort."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset and there is one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/checkpoints/tidewell"
    return folder.rstrip("/")


def kept(df: DataFrame, name: str = "kept", codec: str | None = None) -> DataFrame:
    """Written to the folder that driver and executors share, and read again: the plan runs once, and a lost executor costs this step at most. codec: for long texts."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of files whose rows a task of tasks_for() gets: some hundred thousand narrow rows.
TASK_BYTES = 2 << 20


def tasks_for(table: DataFrame) -> int:
    """As many tasks as the files of table ask for by their bytes, so that a task's memory doesn't grow with the table."""
    files = table.sparkSession.read.format("binaryFile").load(table.inputFiles())  # contents are not read
    return max(table.sparkSession.sparkContext.defaultParallelism, (files.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES)


def kept_by(df: DataFrame, key: str, tasks: int, name: str = "kept") -> DataFrame:
    """kept() in buckets: the rows of a key are in one of tasks files, so that steps by this key shuffle nothing more."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    df.repartition(tasks, key).write.format("parquet").bucketBy(tasks, key).option("path", f"{shared_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


_once: dict[tuple, object] = {}


def once(name: str, sources: list[DataFrame], make):
    """make(), once an application for all who ask for it again.

    The result belongs to the files that sources read, by their paths, sizes and times: once a file
    changes, it is made anew.
    """
    spark = sources[0].sparkSession
    files = spark.read.format("binaryFile").load(sorted({f for s in sources for f in s.inputFiles()}))  # contents are not read
    state = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, name, *state)
    if key not in _once:
        _once[key] = make()
    return _once[key]


def kept_once(name: str, sources: list[DataFrame], make) -> DataFrame:
    """make() as a table that is written once an application, see once()."""

    def written():
        table = kept(make(), name)
        return table.schema, table.inputFiles()

    spark, (schema, paths) = sources[0].sparkSession, once(name, sources, written)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def numbered(df: DataFrame, *order: Column | str, name: str = "_n") -> DataFrame:
    """df with a number from 1 by the order given, which has to be total. Give it keys rather than whole rows, and join back.

    The sort is by ranges; each row gets its place in its range, and a prefix sum over the ranges' sizes
    gives what comes before a range. That sum has a row a range, so a table of ranges is broadcast,
    never one of rows. Ranges are read from the written sort, so both sides see the same ones.
    """
    placed = df.orderBy(*order).withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = kept(placed, "numbered")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    return placed.join(F.broadcast(first), "_range").withColumn(name, (F.col("_first") + F.col("_place") + 1).cast("long")).drop("_range", "_place", "_first")
