"""Kafka readers, and the pure functions that build their options."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bootstrap_servers(host: str, ports: str | int | Iterable[str | int]) -> str:
    """``host:port`` list for one or any number of ports."""
    many = [ports] if isinstance(ports, (str, int)) else list(ports)
    if not many:
        raise ValueError("at least one port is needed")
    return ",".join(f"{host}:{port}" for port in many)


def kafka_options(servers: str, topic: str, group: str | None = None,
                  starting: str = "earliest", streaming: bool = True,
                  fail_on_data_loss: bool = False, max_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Source options. ``kafka.group.id`` (with the prefix) is what Spark hands on.

    A stream goes on over lost offsets unless ``fail_on_data_loss``; a batch fails on them.
    ``max_per_trigger`` bounds a micro-batch, above all the first from the earliest offset, and
    ``min_partitions`` splits topic partitions among more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if streaming:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
        if max_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if group is not None:
        options["kafka.group.id"] = group
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, group: str | None = None,
                 starting: str = "earliest", fail_on_data_loss: bool = False,
                 max_per_trigger: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """Endless read of one topic; options as in :func:`kafka_options`."""
    options = kafka_options(servers, topic, group, starting, True, fail_on_data_loss,
                            max_per_trigger, min_partitions)
    return spark.readStream.format("kafka").options(**options).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Bounded read of a topic from its earliest offset."""
    options = kafka_options(servers, topic, streaming=False)
    return spark.read.format("kafka").options(**options).load()


def to_kafka_records(df: DataFrame, key_cols: list[str], value_cols: list[str] | None = None
                     ) -> DataFrame:
    """Rows to keyed JSON messages (``key``, ``value``)."""
    value = F.struct(*(value_cols or df.columns))
    return df.select(F.to_json(F.struct(*key_cols)).alias("key"), F.to_json(value).alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str) -> None:
    """Publish ``key`` and ``value`` rows; executors write in parallel."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())
