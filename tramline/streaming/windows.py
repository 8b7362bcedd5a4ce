"""Arrival metrics and single predictions kept up to date by state, not by looking again.

``minutes`` counts predictions per minute and line. State holds the minutes that may
still change, those younger than the newest prediction less the delay; each batch
writes the counts it changed. ``minute_counts`` reads them: counts only grow, so the
highest of a minute is the present one, and a replayed batch replaces itself.

``distinct_predictions`` lets a prediction pass once however often it was polled: the
same line, route, stop and predicted moment. State forgets a prediction when the
watermark has passed it by the delay.

Both leave out rows that come later than the delay behind the newest prediction of
earlier batches, and rows without a time; the progress of the query reports the late
ones as ``numRowsDroppedByWatermark``. State lives in the checkpoint, so a restarted
query goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.streaming.jobs import PERIOD, Writer, parquet_writer

DELAY = "1 hour"
PREDICTION = ("line", "route_id", "stop_id", "predicted")


def minutes(arrivals: DataFrame, delay: str = DELAY) -> DataFrame:
    """``minuto, line, total_llegadas`` of streamed arrivals; needs output mode ``update``."""
    timed = arrivals.where("event_timestamp IS NOT NULL").withWatermark("event_timestamp", delay)
    counted = timed.groupBy(F.window("event_timestamp", "1 minute").alias("span"), "line")
    counted = counted.agg(F.count(F.lit(1)).alias("total_llegadas"))
    return counted.select(F.col("span.start").alias("minuto"), "line", "total_llegadas")


def minute_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts that ``minutes`` wrote, as they stand now."""
    return spark.read.parquet(path).groupBy("minuto", "line").agg(F.max("total_llegadas").alias("total_llegadas"))


def distinct_predictions(arrivals: DataFrame, delay: str = DELAY) -> DataFrame:
    """Arrivals with the moment they are predicted for, each prediction once."""
    moment = F.timestamp_seconds(F.unix_micros(F.col("event_timestamp").cast("timestamp")) / 1000000 + F.col("arrival_seconds"))
    timed = arrivals.where("event_timestamp IS NOT NULL").withColumn("predicted", moment)
    return timed.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(list(PREDICTION))


def start(frame: DataFrame, path: str, checkpoint: str, mode: str, once: bool = False) -> StreamingQuery:
    """Keep a table of what the stream gives out, a partition for each batch."""
    write: Writer = parquet_writer(path)
    trigger = {"availableNow": True} if once else {"processingTime": PERIOD}
    stream = frame.writeStream.foreachBatch(write).outputMode(mode)
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start()
