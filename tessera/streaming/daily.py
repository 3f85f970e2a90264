"""Incremental daily totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.session import fresh_path
from tessera.streaming.runs import drain


def windowed_totals(stream: DataFrame, event_time: str, amount: Column, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Totals per time window; rows later than ``late`` are refused, so that state can be dropped."""
    timed = stream.withColumn("_time", F.col(event_time).cast("timestamp"))
    return timed.withWatermark("_time", late).groupBy(F.window("_time", width).alias("window")).agg(
        F.sum(amount).alias("total_amount"))


class DailyTotals:
    """Totals per day of event time, kept up to date by a stream that writes changed days only.

    A watermark of ``late`` lets state go: rows that come later than that behind the newest row are refused, and so are
    repeated rows (equal ``key``) that come within it. Each batch writes the days that it changed, under its own number, so
    a batch that is repeated after a failure overwrites what it wrote; a day's total is that of its last batch.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, late: str = "7 days"):
        self.spark, self.late = spark, late
        self.folder = folder or fresh_path(spark, "daily")
        self.schema: StructType | None = None

    def stream(self, rows: DataFrame, event_time: str, amount: Column, key: str | None = None) -> DataFrame:
        """The changing totals, in update mode: a row for each day that a batch touches."""
        timed = rows.withColumn("_time", F.col(event_time).cast("timestamp")).withWatermark("_time", self.late)
        once = timed.dropDuplicatesWithinWatermark([key]) if key else timed
        return once.groupBy(F.window("_time", "1 day").alias("_day")).agg(F.sum(amount).alias("total_amount")).select(
            F.to_date("_day.start").alias("date"), "total_amount")

    def run(self, rows: DataFrame, event_time: str, amount: Column, key: str | None = None) -> DataFrame:
        """Take in everything that has arrived since the last run; the totals after it."""
        changes = self.stream(rows, event_time, amount, key)
        self.schema = changes.schema

        def upsert(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={batch_id}")

        drain(changes, upsert, mode="update", checkpoint=f"{self.folder}/checkpoint")
        return self.totals()

    def changes(self) -> DataFrame:
        """``date, total_amount, batch``: every version of every day."""
        versions = StructType([*self.schema, StructField("batch", LongType())])
        return self.spark.read.schema(versions).parquet(f"{self.folder}/changes")

    def totals(self) -> DataFrame:
        return self.changes().groupBy("date").agg(F.max_by("total_amount", "batch").alias("total_amount"))
