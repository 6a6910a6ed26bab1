"""Topics: append-only logs of (key, value, timestamp).

A topic is a folder of parquet files by default; ``fmt="kafka"`` reads a broker topic
when the Spark connector is on the class path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "key string, value string, timestamp timestamp"
# Fixed value: offsets per micro-batch of a broker topic, unless the caller says otherwise.
OFFSETS_PER_TRIGGER = 50_000


def read_topic(
    spark: SparkSession,
    topic: str,
    stream: bool = True,
    fmt: str = "parquet",
    per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The topic's records from the earliest on, as a stream or as a batch.

    ``per_trigger`` limits a micro-batch: files for a folder, offsets for a broker.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**(options or {}))
    if fmt == "kafka":
        if stream:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger or OFFSETS_PER_TRIGGER)
        return reader.option("subscribe", topic).option("startingOffsets", "earliest").load()
    if per_trigger and stream:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.schema(ENVELOPE).load(topic)


def to_records(
    df: DataFrame, key: Column | None = None, at: Column | None = None, skip: tuple[str, ...] = ()
) -> DataFrame:
    """Every row as one JSON message, with an optional key and event time."""
    body = [F.col(f"`{c}`") for c in df.columns if c not in skip]
    return df.select(
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        F.to_json(F.struct(*body)).alias("value"),
        (F.current_timestamp() if at is None else at).cast("timestamp").alias("timestamp"),
    )


def write_topic(
    records: DataFrame, topic: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> int:
    """Append messages to the topic and return how many went out.

    The count is observed by the write itself, so the records are produced once.
    """
    from pyspark.sql import Observation

    sent = Observation()
    out = records.observe(sent, F.count(F.lit(1)).alias("n"))
    writer = out.write.format(fmt).mode("append").options(**(options or {}))
    if fmt == "kafka":
        writer.option("topic", topic).save()
    else:
        writer.save(topic)
    return sent.get["n"]


def envelope(df: DataFrame, topic: str) -> DataFrame:
    """Bronze form of topic records: text key and value, event time, arrival, topic name."""
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingest_time"),
        F.current_date().alias("ingest_date"),
        F.lit(topic).alias("topic"),
    )
