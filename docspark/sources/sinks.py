"""Output modes: files of extracted text, bounded chunks, extracted children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark import fixed_values as V


def output_path(path: Column, output_format: str) -> Column:
    """Swap the suffix of the last path segment; a name without suffix stays as it is."""
    if output_format not in V.OUTPUT_FORMATS:
        raise ValueError(f"{V.INVALID_OUTPUT_FORMAT}: {output_format}")
    return F.regexp_replace(path, r"(^|/)([^/]*[^/.][^/]*)\.[^/.]+$", f"$1$2.{output_format}")


def extracted_rows(df: DataFrame, output_format: str, path: str = "path", content: str = "content") -> DataFrame:
    return df.withColumn("output_path", output_path(F.col(path), output_format)).withColumn(
        "content_length", F.octet_length(F.col(content)).cast("bigint")
    )


def write_extracted(df: DataFrame, out: str, output_format: str, path: str = "path", content: str = "content",
                    mode: str = "errorifexists") -> DataFrame:
    """Persist extracted content as Parquet and return the written table.

    The text is always UTF-8. ``output_path`` carries the name each document would have as
    a file; the rows share large Parquet files instead of one small file per document.
    """
    rows = extracted_rows(df, output_format, path, content)
    rows.write.mode(mode).parquet(out)
    return df.sparkSession.read.schema(rows.schema).parquet(out)


def chunk_content(df: DataFrame, size: int = 8192, content: str = "content") -> DataFrame:
    """One row ``(…, chunk_no, chunk)`` per ``size`` bytes of UTF-8 content.

    Bytes are cut instead of characters: each cut is a constant-time slice, and joining
    the chunks in order gives the content back, also where a cut divides a character. NULL
    content has one chunk, NULL.
    """
    if size < 1:
        raise ValueError(f"{V.INVALID_ARGUMENT}: size must be positive")
    kind = dict(df.dtypes)[content]
    value = F.col(content) if kind == "binary" else F.encode(F.col(content), "UTF-8")
    keep = [c for c in df.columns if c != content]
    starts = F.sequence(F.lit(0), F.octet_length("_bytes") - 1, F.lit(size))
    # Encoded before the explode, or each chunk would encode the whole text again.
    encoded = df.select(*keep, value.alias("_bytes"))
    numbered = encoded.select(
        *keep, "_bytes", F.explode_outer(F.when(F.octet_length("_bytes") > 0, starts)).alias("_start")
    )
    start = F.coalesce(F.col("_start"), F.lit(0))
    return numbered.select(
        *keep,
        (start / size).cast("int").alias("chunk_no"),
        F.substring(F.col("_bytes"), start + 1, F.lit(size)).alias("chunk"),
    )


def embedded_rows(children: DataFrame) -> DataFrame:
    """Columns of the children table, with the length of each child and its error where there is that column."""
    return children.select(
        "root_id", "depth", F.col("safe_name").alias("rel_path"), "media_type", "content",
        F.octet_length("content").cast("bigint").alias("content_length"), *[c for c in children.columns if c == "error"],
    )


def write_embedded(children: DataFrame, out: str, mode: str = "errorifexists") -> DataFrame:
    """Persist children in place of files in a folder: equal names stay separate rows."""
    rows = embedded_rows(children)
    rows.write.mode(mode).parquet(out)
    return children.sparkSession.read.schema(rows.schema).parquet(out)
