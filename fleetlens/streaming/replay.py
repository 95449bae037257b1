"""Fixes as a stream: a folder of time-ordered files, a few files per trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetlens.operators.filters import last
from fleetlens.sources import events as E

# A long backlog is worked off in micro-batches of this size.
BACKLOG_BYTES = 256 * 1024**3


def read_replay(
    spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream the files under `path`, a number of files or else a number of bytes per trigger."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_trigger is None:
        return reader.option("maxBytesPerTrigger", BACKLOG_BYTES).parquet(path)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Cleaned trajectory frame over a stream of event files."""
    return E.project(E.clean_events(read_replay(spark, path, E.EVENT_COLUMNS, files_per_trigger)))


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query and pass on its failure, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def replay(stream: DataFrame, path: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the replayed fixes to a table partitioned by day, going on where an earlier replay into it stopped.

    `trigger` defaults to everything available now; `{"processingTime": "2 seconds"}` paces a live one.
    """
    return (
        stream.writeStream.format("parquet")
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", f"{path}/_state")
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def replay_status(replayed: DataFrame, source: DataFrame) -> DataFrame:
    """How many of the source's rows have been replayed."""
    return replayed.selectExpr("count(*) AS current").withColumn("total", last(source, "count(*)"))
