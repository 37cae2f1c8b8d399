"""An extension: the ledger's daily and per-host counts as a Structured Streaming query with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 10) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def daily_counts(events: DataFrame, ts: str, kind: str, lateness: str = "1 day") -> DataFrame:
    """(day, kind, n) in day windows; rows later than the watermark are dropped, closed days are emitted once in append mode."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", lateness)
    return timed.groupBy(F.window("__ts", "1 day"), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), kind, "n")
