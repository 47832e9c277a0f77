"""Continuous ingest: the map-only operators work on a stream as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from docspark.functions.media import file_name
from docspark.plans.documents import parse_documents


def read_files_stream(spark: SparkSession, path: str, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """New files below a folder as a streaming table of documents."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = reader.schema(schema).load(path)
    return files.select("path", file_name(F.col("path")).alias("name"), "modificationTime", "length", "content")


def read_table_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a table as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def parse_stream(sdf: DataFrame, **options) -> DataFrame:
    """Parse a stream of documents: stateless, so no watermark and no late data."""
    return parse_documents(sdf, **options)


def write_stream_split(sdf: DataFrame, out: str, checkpoint: str, error: str = "error") -> StreamingQuery:
    """Write a parsed stream with its bad rows apart, up to the data available now.

    Each batch is written once, into a folder of its own with good and bad rows in partitions. A batch that is run again
    after a failure overwrites its folder, so every row is there exactly once. :func:`read_split` reads both tables.
    """
    def write(batch: DataFrame, number: int) -> None:
        (batch.withColumn("quarantined", F.col(error).isNotNull())
         .write.mode("overwrite").partitionBy("quarantined").parquet(f"{out}/batch={number}"))

    return (sdf.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_split(spark: SparkSession, out: str, schema, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of what :func:`write_stream_split` wrote; ``schema`` is the stream's."""
    typed = StructType([*schema.fields, StructField("quarantined", BooleanType()), StructField("batch", LongType())])
    rows = spark.read.schema(typed).option("basePath", out).parquet(out).drop("batch")
    return rows.where("NOT quarantined").drop("quarantined", error), rows.where("quarantined").drop("quarantined")


def write_stream(sdf: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write a stream as Parquet with exactly-once files, up to the data available now."""
    return (
        sdf.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
