"""Frames as they arrive: resumable ingest of files, and counts over event time."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType, key: str = "id", files_each: int = 100) -> StreamingQuery:
    """Appends rows of new Parquet files to target, each key once, and stops when all are in.

    What was read and which keys were seen is in the checkpoint, so a rerun goes on where it stopped.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(source)
    return rows.dropDuplicates([key]).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, by: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts per window and key of a stream (or table); rows later than `late` are dropped by a stream."""
    rows = events.withWatermark(time, late)
    return rows.groupBy(F.window(time, window).alias("w"), by).agg(F.count("*").alias("n")).select("w.start", "w.end", by, "n")
