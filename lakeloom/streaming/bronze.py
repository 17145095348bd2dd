"""Streams to raw files: stateless projection, partitions by time of ingestion, exactly once by checkpoint."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: What a message has in common, whatever the broker.
MESSAGE = "key string, value string, topic string, partition int, offset long, timestamp timestamp"

# The columns of a raw record, the broker's option names and how days and hours are written.
RAW_COLUMNS: dict[str, str] = {
    "raw_value": "cast(value AS string)",
    "message_key": "cast(key AS string)",
    "kafka_topic": "topic",
    "kafka_partition": "partition",
    "kafka_offset": "offset",
    "kafka_timestamp": "timestamp",
    "bronze_ingested_at": "current_timestamp()",
}
FOLDERS: dict[str, str] = {"ingest_date": "yyyy-MM-dd", "ingest_hour": "HH"}
TOPIC_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5000"}


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic. What a trigger reads at most, and where it starts, are options of the broker's reader."""
    reader = spark.readStream.format("kafka")
    for name, value in {"kafka.bootstrap.servers": servers, "subscribe": topic, **TOPIC_OPTIONS, **options}.items():
        reader = reader.option(name, value)
    return reader.load()


def file_stream(spark: SparkSession, path: str, most_files: int = 100) -> DataFrame:
    """Messages from JSON files, one a line: the same columns without a broker."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", most_files).json(path)


def raw_records(messages: DataFrame) -> DataFrame:
    """Messages as raw records, with the folders they go to."""
    columns: list[Column] = [F.expr(e).alias(name) for name, e in RAW_COLUMNS.items()]
    columns += [F.date_format(F.current_timestamp(), form).alias(name) for name, form in FOLDERS.items()]
    return messages.select(columns)


@dataclass(frozen=True)
class RawSink:
    """Compressed JSON files below path, each message once as long as the checkpoint is kept."""

    path: str
    checkpoint: str

    def drain(self, records: DataFrame) -> StreamingQuery:
        """Started: writes all there is, then stops."""
        return self._start(records, availableNow=True)

    def follow(self, records: DataFrame, every: str = "30 seconds") -> StreamingQuery:
        """Started: writes what has come in since, at an interval, until it is stopped."""
        return self._start(records, processingTime=every)

    def _start(self, records: DataFrame, **trigger) -> StreamingQuery:
        options = {"path": self.path, "checkpointLocation": self.checkpoint, "compression": "gzip"}
        return records.writeStream.partitionBy(*FOLDERS).trigger(**trigger).options(**options).format("json").start()


def progress(query: StreamingQuery) -> dict[str, int]:
    """Rows and duration over the batches that the query still remembers."""
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    return {"batches": len(batches), "rows": sum(p["numInputRows"] for p in batches), "ms": sum(p["batchDuration"] for p in batches)}
