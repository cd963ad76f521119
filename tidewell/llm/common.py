"""Session, storage and key helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import ship

#: Arrow batches sent to Python: bounded in rows and in bytes, whatever the length of the texts.
ARROW_ROWS, ARROW_BYTES = 2000, 4 << 20


def session(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session so that very long texts cannot fill a Python worker, and give workers the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return ship(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/checkpoints/tidewell"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts lineage, survives lost executors, runs its plan once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Between steps: what the driver no longer refers to goes, so that Spark's cleaner removes finished shuffles and broadcasts everywhere."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df has it in any case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def size_of(df: DataFrame) -> int:
    """Bytes of df's sources as Catalyst knows them (of files: on disk); sources of unknown size count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_key(text: str = "text") -> Column:
    """With doc_id, the key of a row: rows that repeat both are the same document. Null and empty texts differ."""
    return F.xxhash64(F.col(text), F.col(text).isNull())


def same_row(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality of the key columns of a and b."""
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def nullable(column: pa.Array | pa.ChunkedArray):
    """The same values, with every field allowed to be null, as Spark expects them back."""

    def loose(t):
        if pa.types.is_struct(t):
            return pa.struct([pa.field(f.name, loose(f.type)) for f in t])
        return pa.list_(loose(t.value_type)) if pa.types.is_list(t) else t

    return column.cast(loose(column.type))
