"""Case events over Kafka, or over files with the same rows.

The Kafka connector is a separate Spark package; without it use the file source,
which gives the same DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

CASE_SCHEMA = (
    "primaryid bigint, sex string, age double, reporter_country string, "
    "drugs array<string>, reactions array<string>, outcomes array<string>, stream_timestamp string"
)


def parse_cases(values: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to case columns; text that does not parse is dropped."""
    parsed = values.select(F.from_json(F.col(column).cast("string"), CASE_SCHEMA).alias("case"))
    return parsed.select("case.*").filter(F.col("primaryid").isNotNull()).withColumn(
        "ts", F.try_to_timestamp("stream_timestamp")
    )


def read_kafka_cases(spark: SparkSession, servers: str, topic: str, starting: str = "latest", per_trigger: int | None = None):
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return parse_cases(reader.load())


def read_file_cases(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """JSON text files as the stream, one case per line."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return parse_cases(lines)


def to_messages(df: DataFrame, key: str = "primaryid") -> DataFrame:
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )


def stamp_cases(cases: DataFrame) -> DataFrame:
    """Assembled cases with the time they enter the stream."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return cases.withColumn("stream_timestamp", now)


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        to_messages(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
