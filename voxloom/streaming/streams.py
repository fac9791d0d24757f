"""Streaming front ends: incremental runs over new files, windows with watermarks, sessions by gap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from voxloom.session import new_table


def incremental(spark: SparkSession, source: str, schema: str, sink: Callable[[DataFrame, int], None], checkpoint: str, fmt: str = "parquet") -> int:
    """Hand every file that is new since the last run to ``sink`` as batches; return how many batches ran.

    The checkpoint remembers what was done, so a restart neither repeats nor forgets a file.
    """
    ran = []

    def each(df: DataFrame, epoch: int) -> None:
        sink(df, epoch)
        ran.append(epoch)

    query = (spark.readStream.format(fmt).schema(schema).load(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(ran)


def window_counts(events: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None, late: str = "10 minutes", value: str = "value") -> DataFrame:
    """Tumbling or sliding windows of a stream (or table) with late rows up to ``late``."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (events.withWatermark(ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
            .select(F.col("w.start").alias("from_ts"), F.col("w.end").alias("to_ts"), *by, "n", "total"))


def sessions(events: DataFrame, ts: str, by: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of rows less than ``gap`` apart (a gap of exactly ``gap`` stays in the session, unlike a gap marker)."""
    return (events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("from_ts"), F.col("w.end").alias("to_ts"), *by, "n"))


def run_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Drive a stream over what is there now into a table of the shared folder and return it.

    Batches are written by the executors under their number, so a batch that is done again replaces itself; in ``complete`` mode
    the last one is the result.
    """
    spark = stream.sparkSession
    out = new_table(spark)
    spark.createDataFrame([], stream.schema).write.parquet(f"{out}/rows/batch=-1")

    def each(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/rows/batch={epoch}")

    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{out}/done").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{out}/rows")
    if mode == "complete":
        rows = rows.join(F.broadcast(rows.agg(F.max("batch").alias("batch"))), "batch")  # one row
    return rows.drop("batch")
