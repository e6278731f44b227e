"""Starting and awaiting streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from signalmill.session import shuffle_partitions

# Pace of rollups, ingest and relays, and of the CSV to JSON feed.
CADENCE = "10 seconds"
FEED_CADENCE = "5 seconds"


def run_available(
    writer: DataStreamWriter, spark: SparkSession | None = None, state_partitions: int | None = None
) -> StreamingQuery:
    """Processes what the source holds now, then stops; raises if the stream failed.

    With ``state_partitions`` (and the session), the stream gets so many state partitions. It copies the
    session's settings as it starts, so the session has its own again while the stream runs.
    """
    if state_partitions:
        with shuffle_partitions(spark, state_partitions):
            query = writer.trigger(availableNow=True).start()
    else:
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def skip_present(stream: DataFrame, checkpoint: str) -> None:
    """Marks what the source holds now as seen, reading none of it.

    A stream that then starts with the same checkpoint begins with what comes after, whatever the
    records' times are: the checkpoint notes files or offsets.
    """
    run_available(stream.writeStream.foreachBatch(lambda batch, n: None).option("checkpointLocation", checkpoint))


def replay_then_follow(
    replay: DataStreamWriter, follow: DataStreamWriter, checkpoint: str, every: str | None = CADENCE
) -> StreamingQuery:
    """Replays a topic's log, then follows it, on one checkpoint: each record is seen exactly once.

    Both writers come from the same source. The first takes all that is there and ends; the second goes on
    behind it, at a cadence, or once over what is there by then if ``every`` is None.
    """
    run_available(replay.option("checkpointLocation", checkpoint))
    follow = follow.option("checkpointLocation", checkpoint)
    return start(follow, every) if every else run_available(follow)


def start(writer: DataStreamWriter, every: str = CADENCE) -> StreamingQuery:
    """Starts a stream that runs until stopped."""
    return writer.trigger(processingTime=every).start()


def await_all(spark: SparkSession) -> None:
    """Waits until every active stream has ended; raises as soon as one fails."""
    while spark.streams.active:
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()


def to_console(stream: DataFrame, output_mode: str, checkpoint: str) -> DataStreamWriter:
    """A writer that prints each batch without shortening its values."""
    return (
        stream.writeStream.format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
