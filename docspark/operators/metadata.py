"""Raw metadata, normalised fields, long form and comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions import metadata as M
from docspark.functions.charsets import charset_name, markup_charset
from docspark.functions.text import decode_text, text_encoding
from docspark.operators.parsing import markup_text, package_document_path, part_named


def raw_metadata_column(media_type: Column, content: Column, text: Column, name: Column | None = None,
                        override: Column | None = None, parts: Column | None = None,
                        parsed_by: Column | None = None) -> Column:
    """Raw map: what the document says about itself, then what the file says about it."""
    missing = F.lit(None).cast("string")
    is_text = F.startswith(media_type, F.lit("text/")) | media_type.isin(V.XML, V.XHTML)
    is_markup = F.endswith(media_type, F.lit("xml")) | media_type.isin(V.TEXT_HTML)
    encoding = F.when(is_text, text_encoding(content, charset_name(F.when(is_markup, markup_charset(content)))))
    own = F.when(media_type.isin(V.TEXT_HTML, V.XHTML), M.html_fields(text)).when(
        media_type == V.MESSAGE, M.mail_fields(content)
    )
    if parts is not None:
        own = own.when(media_type.isin(V.DOCX, V.XLSX, V.PPTX),
                       M.package_fields(part_named(parts, "docProps/core.xml"), part_named(parts, "docProps/app.xml")))
        own = own.when(media_type == V.EPUB, M.book_fields(part_named(parts, package_document_path(parts))))
    file_entries = M.file_fields(
        missing if name is None else name, F.octet_length(content), media_type, encoding,
        missing if override is None else override,
    )
    by = M.entries_of([(V.PARSED_BY, missing if parsed_by is None else parsed_by)])
    # Keys about the file itself are facts, not claims of the document.
    facts = [V.RESOURCE_NAME, V.CONTENT_LENGTH, V.CONTENT_TYPE, V.CONTENT_TYPE_OVERRIDE, V.PARSED_BY]
    own = F.filter(own.otherwise(None), lambda e: ~e["key"].isin(facts))
    return M.merge_entries(own, file_entries, by)


def raw_metadata(df: DataFrame, media_type: str = "media_type", content: str = "content",
                 name: str | None = None, output: str = "raw_metadata") -> DataFrame:
    """Add the raw key → value map of each document."""
    kind = F.col(media_type)
    markup = kind.isin(V.TEXT_HTML, V.XHTML)
    return df.withColumn("_text", F.when(markup, markup_text(F.col(content)))).withColumn(
        output, raw_metadata_column(kind, F.col(content), F.col("_text"), F.col(name) if name else None),
    ).drop("_text")


def embedded_metadata(df: DataFrame, raw: str = "raw_metadata", depth: str = "depth",
                      relationship_id: str = "relationship_id") -> DataFrame:
    """Add the keys that only embedded documents have."""
    extra = M.entries_of([(V.EMBEDDED_DEPTH, F.col(depth)), (V.EMBEDDED_RELATIONSHIP_ID, F.col(relationship_id))])
    return df.withColumn(raw, M.merge_entries(F.map_entries(raw), extra))


def select_metadata(df: DataFrame, raw: str = "raw_metadata") -> DataFrame:
    """One text column per field, by the first present key and before any conversion."""
    return df.select("*", *[F.expr(M.raw_value(raw, keys)).alias(name) for name, _, keys in V.METADATA_FIELDS])


def normalize_metadata(df: DataFrame, raw: str = "raw_metadata", output: str = "metadata") -> DataFrame:
    """Add the struct of typed fields."""
    return df.withColumn(output, M.normalized(raw))


def coerce_metadata(df: DataFrame, raw: str = "raw_metadata", strict: bool = False) -> DataFrame:
    """Add the typed struct ``metadata`` and ``metadata_unparsed`` (text that did not convert).

    With ``strict`` a numeric field that fails to convert fails the job.
    """
    df = normalize_metadata(df, raw).withColumn("metadata_unparsed", M.unparsed(raw))
    if strict:
        bad = F.size("metadata_unparsed") > 0
        message = F.concat(F.lit(f"{V.PARSE_ERROR}: "), F.to_json("metadata_unparsed"))
        failed = F.raise_error(message).cast(M.EMPTY_MAP)
        df = df.withColumn("metadata_unparsed", F.when(bad, failed).otherwise(F.col("metadata_unparsed")))
    return df


def metadata_entries(df: DataFrame, id_cols: Sequence[str] = ("doc_id",), raw: str = "raw_metadata") -> DataFrame:
    """Long form: one row per document and key."""
    return df.select(*id_cols, F.explode(raw).alias("key", "value"))


def metadata_diff(left: DataFrame, right: DataFrame, ignore: Sequence[str] = (),
                  id_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Keys that only one side has, or with different values.

    Both sides are in long form; ``(id, key)`` spreads the rows of a large document.
    """
    on = [*id_cols, "key"]

    def side(df: DataFrame, name: str) -> DataFrame:
        df = df.filter(~F.col("key").isin(list(ignore))) if ignore else df
        return df.select(*on, F.struct("value").alias(name))

    joined = side(left, "l").join(side(right, "r"), on, "full_outer")
    state = (
        F.when(F.col("r").isNull(), "only_left")
        .when(F.col("l").isNull(), "only_right")
        .when(~F.col("l.value").eqNullSafe(F.col("r.value")), "different")
    )
    return joined.select(
        *on, state.alias("state"), F.col("l.value").alias("left_value"), F.col("r.value").alias("right_value")
    ).filter(F.col("state").isNotNull())
