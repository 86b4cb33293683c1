"""Progress of a growing log as Structured Streaming.

Counters and numbered deltas are written by batch. A batch that is run again after a
failure replaces its own output (it is written to a folder of its number), so both
are exactly once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sievework.shared import shared_dir


def tail(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None, form: str = "json") -> DataFrame:
    """Rows of the files of a folder as they appear; a line is read when its file is complete."""
    r = spark.readStream.schema(schema).format(form)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


def write_batches(stream: DataFrame, out: str, checkpoint: str, aggregate, available_now: bool = True) -> StreamingQuery:
    """``aggregate(batch)`` of each batch under ``out``/batch=N."""

    def write(batch: DataFrame, number: int) -> None:
        aggregate(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def counters(batch: DataFrame, by: str, value: str) -> DataFrame:
    return batch.groupBy(by).agg(F.count("*").alias("n"), F.sum(value).alias("value"))


def numbered(batch: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their position in the batch; with the batch's number it orders all rows."""
    from pyspark.sql import Window

    return batch.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def delta_since(spark: SparkSession, out: str, batch: int, position: int) -> DataFrame:
    """Numbered rows after (batch, position)."""
    return spark.read.parquet(out).where((F.col("batch") > batch) | ((F.col("batch") == batch) & (F.col("position") > position)))


def latest(rows: DataFrame, n: int = 400) -> DataFrame:
    """The last n numbered rows."""
    return rows.orderBy(F.desc("batch"), F.desc("position")).limit(n)


def streamed_counts(spark: SparkSession, path: str, schema: StructType, by: str, value: str) -> DataFrame:
    """Counters of all files that are there now, by a stream that ends."""
    root = f"{shared_dir(spark)}/sievework/stream-{uuid.uuid4().hex}"
    folder, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path if not spark._jvm.java.io.File(path).isFile() else f"{folder}/{name[:-1]}[{name[-1]}]")
    write_batches(stream, f"{root}/out", f"{root}/checkpoint", lambda b: counters(b, by, value)).awaitTermination()
    done = spark.read.schema(f"{by} string, n long, value double, batch int").parquet(f"{root}/out")
    return done.groupBy(by).agg(F.sum("n").alias("n"), F.round(F.sum("value"), 4).alias("value"))


def events_by_minute(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Rows each minute of event time, closed when the watermark passes."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("minute"), "n")


def run_until_empty(start, pending, most: int = 40) -> int:
    """Start a run that ends by itself until nothing is pending; the number of runs. ``start()`` returns a query, ``pending()`` a count."""
    for attempt in range(1, most + 1):
        start().awaitTermination()
        if not pending():
            return attempt
    return most
