"""Session helpers: table loading and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_spread(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """Like ``load``, for work that costs far more per row than reading it.

    A table too small to give every core a full split is spread over the cores by ``key``.
    A larger one already comes in enough splits and is left where it is.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    cores = spark.sparkContext.defaultParallelism
    df = load(spark, folder, name)
    if files.getContentSummary(path).getLength() >= cores * (128 << 20):
        return df
    return df.repartition(cores, key)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder, because there the driver is the only machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: For wide rows: a task that writes or reads holds a row group, by default of 128 MB.
SMALL_GROUPS = {"parquet.block.size": str(16 << 20)}


def written(df: DataFrame, label: str = "cut", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    A written table cuts the lineage, keeps values such as partition numbers fixed
    when a task is repeated, and lets later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    schema = df.schema
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
