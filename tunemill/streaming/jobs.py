"""Running stream jobs: three topics to the lake, and the live aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tunemill.operators.aggregates import auth_success_rate, song_trends, user_engagement
from tunemill.streaming.ingest import ingest_checked
from tunemill.streaming.keyed import keyed_table_sink
from tunemill.streaming.sinks import TRIGGER, checked_lake_sink, table_sink


def run_ingest(spark: SparkSession, writers: list[DataStreamWriter],
               wait: bool = True) -> list[StreamingQuery]:
    """Start all queries in one session; with ``wait``, return once any of them ends."""
    spark.streams.resetTerminated()
    running = [writer.start() for writer in writers]
    if wait:
        spark.streams.awaitAnyTermination()
    return running


def finish(running: list[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; a failed one raises."""
    for query in running:
        query.awaitTermination()


def ingest_all_topics(sources: dict[str, DataFrame], base: str,
                      trigger: str = TRIGGER) -> list[DataStreamWriter]:
    """One writer per topic in ``sources``, each with its own checkpoint.

    Rows land in ``base/<topic>``, messages that can't in ``base/quarantine/<topic>``.
    """
    return [checked_lake_sink(ingest_checked(source, topic), f"{base}/{topic}", f"{base}/quarantine/{topic}",
                              f"{base}/checkpoint/{topic}", trigger)
            for topic, source in sources.items()]


def realtime_aggregates(listen: DataFrame, auth: DataFrame, base: str,
                        trigger: str = TRIGGER) -> list[DataStreamWriter]:
    """Writers of the three live aggregates over ingested streams.

    Windows are written once, when the watermark has passed their end; the user
    averages are kept in a table of their latest values.
    """
    def at(name: str) -> tuple[str, str]:
        return f"{base}/{name}", f"{base}/checkpoint/{name}"

    return [table_sink(song_trends(listen), *at("real_listen"), "append", trigger),
            keyed_table_sink(user_engagement(listen), *at("real_user"), ("userId",), trigger),
            table_sink(auth_success_rate(auth), *at("real_auth"), "append", trigger)]
