"""Results that are written once and read again.

On a cluster they go to the folder in spark.checkpoint.dir, which driver and
executors share, so that a lost executor takes nothing with it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.

    Where it is unset, a new temporary folder that is then set if all runs on
    this machine; on a cluster, whose executors would each write to a disk of
    their own, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='sequoir-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def forget(df: DataFrame) -> None:
    """Delete what settled(), a written table in the shared folder, left for df."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, name: str = "settled", compression: str | None = None) -> DataFrame:
    """df written as Parquet into the shared folder and read again: a cut lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_whole(spark: SparkSession, text: str, path: str) -> None:
    """A small text at a path, put there by one rename, so that nobody reads half of it; FileExistsError if the path is taken."""
    half = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    whole = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(half)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(whole) or not fs.rename(half, whole):
        fs.delete(half, False)
        raise FileExistsError(path)


def once(df: DataFrame, path: str) -> DataFrame:
    """df materialised at a path unless a whole result is there already: results are remembered by path."""
    spark = df.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str | None, schema: T.StructType | str) -> DataFrame:
    """Parquet at a path, or no rows of the schema if there is none."""
    if path and exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


#: Bytes of input that spread() shuffles at most.
SPREAD_BYTES = 1 << 30


def spread(scan: DataFrame) -> DataFrame:
    """A table as it is read, dealt over all cores if it has fewer splits than there are cores.

    A small file of one row group would otherwise be one task's work. Inputs
    with a split for every core, and inputs of more than SPREAD_BYTES, are left
    as they are, so nothing that is large is shuffled by this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    query = scan._jdf.queryExecution()
    if query.toRdd().getNumPartitions() >= cores:
        return scan
    size = int(str(query.optimizedPlan().stats().sizeInBytes()))
    return scan.repartition(cores) if size <= SPREAD_BYTES else scan
