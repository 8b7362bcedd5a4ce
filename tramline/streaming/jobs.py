"""Sources, sinks and the long-running query for arrival predictions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.sources.tables import append_jdbc
from tramline.streaming import events

# Topic names and the feed period.
ARRIVALS_TOPIC = "gtfs-realtime"
ALERTS_TOPIC = "transport-alerts"
ERRORS_TOPIC = "transport-errors"
PERIOD = "30 seconds"

Writer = Callable[[DataFrame, int], None]


def kafka_source(spark: SparkSession, servers: str, topic: str = ARRIVALS_TOPIC) -> DataFrame:
    """New messages of a topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def text_source(spark: SparkSession, folder: str, files_per_trigger: int = 0) -> DataFrame:
    """One message per line of the text files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def kafka_writer(servers: str, topic: str) -> Writer:
    def write(df: DataFrame, batch_id: int) -> None:
        (
            df.select("value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )

    return write


# The property in which Spark names the query whose batch is being handled.
QUERY_ID = "sql.streaming.queryId"
DIRECT = "direct"  # rows written outside of any query


def parquet_writer(path: str, *partitions: str) -> Writer:
    """Batches as partitions of a table; a replayed batch replaces itself.

    A batch is known by its query and number. Queries keep their id as long as
    their checkpoint, so two queries, or one with a new checkpoint, that write
    to one table never replace each other's rows. An empty batch writes no
    partition, without being evaluated to find out.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or DIRECT
        (
            df.withColumn("query_id", F.lit(query))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions, "query_id", "batch_id")
            .parquet(path)
        )

    return write


def arrivals_writer(path: str) -> Writer:
    """The arrivals table: predictions plus the time they were stored.

    Days are partitions, so that metrics over the last hour read one or two of
    them. The day follows from the prediction, so a replay meets its own files.
    """
    write = parquet_writer(path, "event_date")

    def stamped(df: DataFrame, batch_id: int) -> None:
        write(
            df.withColumns(
                {
                    "created_at": F.current_timestamp(),
                    "event_date": F.to_date("event_timestamp"),
                }
            ),
            batch_id,
        )

    return stamped


def jdbc_writer(url: str, table: str, **options: str) -> Writer:
    """Append to a relational table; replays append again (at least once)."""

    def write(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            append_jdbc(df, url, table, **options)

    return write


def topics(checked: DataFrame) -> dict[str, DataFrame]:
    """Checked messages routed to the three topics, as JSON in ``value``."""
    good = events.valid(checked)
    return {
        ARRIVALS_TOPIC: good.select("value"),
        ALERTS_TOPIC: events.alert_messages(events.alerts(events.parse_messages(good))),
        ERRORS_TOPIC: events.error_messages(events.error_records(checked)),
    }


def outputs(checked: DataFrame) -> dict[str, DataFrame]:
    """Checked messages as tables: arrivals, alerts, errors and the cycle's counters."""
    good = events.valid(checked)
    return {
        "arrivals": events.arrivals(good),
        "alerts": events.alerts(events.parse_messages(good)),
        "errors": events.error_records(checked),
        "cycles": events.counters(checked),
    }


def table_writers(root: str) -> dict[str, Writer]:
    root = root.rstrip("/")
    return {
        "arrivals": arrivals_writer(f"{root}/arrivals"),
        **{n: parquet_writer(f"{root}/{n}") for n in ("alerts", "errors", "cycles")},
    }


def fan_out(
    writers: Mapping[str, Writer],
    route: Callable[[DataFrame], Mapping[str, DataFrame]] = outputs,
) -> Writer:
    """A micro-batch handler: messages are checked and parsed once and feed all outputs."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = events.with_message(events.check_messages(batch.select("value"))).persist()
        try:
            for name, df in route(checked).items():
                if name in writers:
                    writers[name](df, batch_id)
        finally:
            checked.unpersist()

    return handle


def start(
    source: DataFrame,
    handler: Writer,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Run the handler on every micro-batch, or once over all that is available."""
    trigger = {"availableNow": True} if once else {"processingTime": PERIOD}
    return (
        source.writeStream.foreachBatch(handler)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
