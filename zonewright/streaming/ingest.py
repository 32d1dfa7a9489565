"""The event archive as an incremental job: new landed files in, events that the archive lacks out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonewright.sources import readers, writers


def ingest_events(spark: SparkSession, landing: str, archive: str, checkpoint: str, schema: str) -> StreamingQuery:
    """Take what has landed since the last run and stop. Each batch is appended idempotently, so a batch that runs twice
    after a failure adds nothing the second time."""

    def append(batch: DataFrame, _: int) -> None:
        writers.append_events(batch, readers.archive(spark, archive, schema), archive)

    landed = spark.readStream.schema(schema).json(landing)
    return landed.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events by day and type over a stream with a column ts; rows later than `late` are not counted."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
