"""Message topics. The connector jar is the deployment's choice; only the options are ours."""

from pyspark.sql import DataFrame, SparkSession


def kafka_source_options(servers: str, topic: str, starting: str | None = "latest",
                         fail_on_data_loss: bool | None = False, max_offsets: int | None = None,
                         min_partitions: int | None = None) -> dict:
    """Options of a topic source. None leaves an option at the connector's default.

    Live jobs start at "latest", the archive at "earliest" so that it takes in the backlog. `max_offsets` cuts a backlog
    into micro-batches of that many messages, `min_partitions` reads each in more tasks than the topic has partitions.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting is not None:
        options["startingOffsets"] = starting
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_source(spark: SparkSession, options: dict) -> DataFrame:
    """Streaming (value, timestamp) rows of a topic."""
    rows = spark.readStream.format("kafka").options(**options).load()
    return rows.selectExpr("cast(value as string) as value", "timestamp")


def kafka_sink_options(servers: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic}
