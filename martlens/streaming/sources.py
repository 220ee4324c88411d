"""Stream sources (S1) and record parsing.

Kafka is the production source; its connector is not bundled with plain
PySpark, so ``kafka_stream`` only builds the reader and Spark reports a
missing connector when the query starts. Tests use file streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 **options: str) -> DataFrame:
    """Subscribe to one topic. Columns: value (string), ingest_time (timestamp),
    topic, partition, offset. Offsets are tracked by the query checkpoint."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                F.col("timestamp").alias("ingest_time"),
                                "topic", "partition", "offset")


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON document per line of the files under ``path``. The file's
    modification time stands in for the broker's ingest timestamp."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(path)
                  .select("value", F.col("_metadata.file_modification_time").alias("ingest_time")))


def parse_json(stream: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind the JSON ``value`` to ``schema`` by field name; keep ingest_time.
    Numbers may come as text (change images carry them so); what does not read
    as the field's type is null."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    keep = [c for c in stream.columns if c != "value"]
    rec = stream.select(*keep, F.from_json("value", text).alias("r"))
    return rec.select(*keep, *[F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema])
