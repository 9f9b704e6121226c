"""Harvest what is new since the last run.

The file source remembers in its checkpoint which files it has taken, so every
package or feed is processed once.  Each micro-batch replaces its own output,
which makes a batch repeated after a failure leave no copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sheaf.plans.harvest import Stage, package_documents, write_documents
from sheaf.plans.registry import SourceSpec, source as find_source
from sheaf.sources.landing import is_package, read_documents, read_feed, split_nodes

_BINARY = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def read_landing_stream(
    spark: SparkSession, spec: SourceSpec, path: str, max_files: int = 1000
) -> DataFrame:
    """New files of a source as a stream of documents or archives."""
    if spec.kind == "feed":
        return read_feed(
            spark, path, spec.tags[0], stream=True, max_files=max_files, bare=spec.bare_tag
        )
    if spec.kind == "package":
        archives = (
            spark.readStream.format("binaryFile")
            .schema(_BINARY)
            .option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.{zip,tar}")
            .load(path)
        )
        return archives.where(is_package(F.col("path")))
    return read_documents(spark, path, stream=True, max_files=max_files)


def stream_harvest(
    spark: SparkSession,
    source: str,
    path: str,
    results: str,
    checkpoint: str,
    run_id: str,
    stages: Sequence[tuple[int, Stage]] = (),
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Start a query that takes all files there are and then ends.

    Bad documents never stop it; they are written beside the records.
    """
    spec = find_source(source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if spec.kind == "package":
            batch = package_documents(spec, batch)
        elif spec.kind == "page" and spec.tags:
            batch = split_nodes(batch, spec.tags)
        write_documents(batch, source, results, run_id, batch_id, stages, **options)

    return (
        read_landing_stream(spark, spec, path, max_files)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landing_counts(documents: DataFrame, late: str = "1 day") -> DataFrame:
    """Documents landed per day and source; works on streams and tables."""
    if documents.isStreaming:
        documents = documents.withWatermark("harvested_at", late)
    return (
        documents.groupBy(F.window("harvested_at", "1 day").alias("day"), "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("day.start", "yyyy-MM-dd").alias("day"), "source", "n")
    )
