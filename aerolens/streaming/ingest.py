"""Incremental ingest of yearly flight files with Structured Streaming.

The batch path reads every yearly file at once. When files keep arriving (a
new year, a late month), the same scan and enrichment run as a file-source
stream: each trigger picks up only files not seen before, enriches them with
the static airport lookup (a stream-static left join; the lookup is broadcast
after its size check), and appends them to the enriched table partitioned by
Year. The checkpoint records which files were committed, so a restarted or
failed run neither skips nor duplicates a file.

``trigger(availableNow=True)`` processes everything present and stops, which
suits a scheduled job; ``processing_time`` keeps the query running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerolens.operators.enrich import enrich
from aerolens.session import checkpoint_dir
from aerolens.sources.schemas import FLIGHTS_CSV_SCHEMA


def flight_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType | str = FLIGHTS_CSV_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of header CSV flight files in ``source_dir``."""
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def enriched_stream(
    spark: SparkSession,
    source_dir: str,
    airports: DataFrame,
    schema: T.StructType | str = FLIGHTS_CSV_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The enrichment chain (trailing columns dropped, city/state, calendar,
    season, part of day) over the stream."""
    return enrich(flight_stream(spark, source_dir, schema, max_files_per_trigger), airports)


def start_ingest(
    stream: DataFrame,
    out_path: str,
    checkpoint_location: str | None = None,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append the enriched stream to Parquet at ``out_path``, partitioned by Year.

    The checkpoint defaults to a folder under the cluster's shared checkpoint
    directory; with none configured a location must be given.
    """
    if checkpoint_location is None:
        base = checkpoint_dir(stream.sparkSession)
        if base is None:
            raise ValueError("no spark.checkpoint.dir configured: pass checkpoint_location")
        checkpoint_location = f"{base.rstrip('/')}/ingest-{query_name or 'flights'}"
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location)
        .partitionBy("Year")
    )
    if query_name:
        writer = writer.queryName(query_name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)
