"""Validation of inputs and routing of bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark import fixed_values as V
from docspark.session import materialize

ERROR_TYPE = "struct<error_class:string,message:string>"


def make_error(error_class: str, message: Column | str) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(error_class).alias("error_class"), message.alias("message"))


def input_error(content: Column, path: Column | None, output_format: Column | None = None) -> Column:
    """Error struct of an unusable input row, NULL for a usable one."""
    case = F
    if path is not None:
        case = case.when(path.isNotNull() & (F.trim(path) == ""),
                         make_error(V.INPUT_NOT_FOUND, "File not found: empty path"))
    case = case.when(content.isNull(), make_error(V.INVALID_INPUT, "Invalid input: content is NULL"))
    if output_format is not None:
        bad = output_format.isNull() | ~output_format.isin(*V.OUTPUT_FORMATS)
        message = F.concat(F.lit("Invalid output format: "), F.coalesce(output_format, F.lit("NULL")))
        case = case.when(bad, make_error(V.INVALID_OUTPUT_FORMAT, message))
    return case.otherwise(F.lit(None).cast(ERROR_TYPE))


def validate_input(df: DataFrame, content: str = "content", path: str | None = None,
                   output_format: str | None = None) -> DataFrame:
    """Add an ``error`` column; a column of the wrong type fails at analysis."""
    kind = df.schema[content].dataType
    if not isinstance(kind, (T.BinaryType, T.StringType)):
        raise TypeError(f"Invalid input type: {kind.simpleString()}")
    error = input_error(
        F.col(content),
        F.col(path) if path else None,
        F.col(output_format) if output_format else None,
    )
    return df.withColumn("error", error)


def split_errors(df: DataFrame, error: str = "error", written: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows).

    The rows are written once and both sides read the table. Without that, Catalyst would
    push the filter on ``error`` below the projections that compute it, and every parser
    would run for each side and again for the filter. Pass ``written=True`` for a table
    that is stored already.
    """
    df = df if written else materialize(df, "parsed")
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def raise_on_error(df: DataFrame, error: str = "error") -> DataFrame:
    """Strict mode: fail the job at the first bad row instead of carrying the error."""
    message = F.concat(F.col(error)["error_class"], F.lit(": "), F.col(error)["message"])
    checked = F.when(F.col(error).isNotNull(), F.raise_error(message).cast(ERROR_TYPE)).otherwise(F.col(error))
    return df.withColumn(error, checked)
