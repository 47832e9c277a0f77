"""Documents from files and from tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark import fixed_values as V
from docspark.functions.media import file_name


def read_files(spark: SparkSession, path: str | list[str], glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """Scan files as ``(path, name, modificationTime, length, content)``.

    Filters on length and modificationTime reach the scan, and the bytes are read only by
    plans that use ``content``. A missing path raises ``FileNotFoundError``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") + str(e):
            raise FileNotFoundError(f"{V.INPUT_NOT_FOUND}: {path}") from e
        raise
    return files.select("path", file_name(F.col("path")).alias("name"), "modificationTime", "length", "content")


def documents_from_table(df: DataFrame, content: str, name: str | None = None,
                         content_type: str | None = None) -> DataFrame:
    """Any table as documents: adds ``content`` (bytes), ``path`` and ``content_type_hint``."""
    kind = df.schema[content].dataType
    if isinstance(kind, T.StringType):
        value = F.encode(F.col(content), "UTF-8")
    elif isinstance(kind, T.BinaryType):
        value = F.col(content)
    else:
        raise TypeError(f"{V.INVALID_INPUT}: {content} is {kind.simpleString()}, not text or bytes")
    missing = F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in {content, name, content_type, "content", "path", "content_type_hint"}]
    return df.select(
        *rest,
        (F.col(name) if name else missing).alias("path"),
        value.alias("content"),
        (F.col(content_type) if content_type else missing).alias("content_type_hint"),
        F.octet_length(value).cast("bigint").alias("length"),
    )
