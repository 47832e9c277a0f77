"""Parse and analyse documents end to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions import metadata as M
from docspark.functions.html import html_to_text, xml_to_text
from docspark.functions.charsets import markup_charset
from docspark.functions.mail import mail_parts_with_body, mail_text
from docspark.functions.xhtml import to_xhtml
from docspark.operators.errors import ERROR_TYPE, input_error, make_error, raise_on_error
from docspark.operators.language import with_language
from docspark.functions.media import MagicRule
from docspark.operators.media_types import Detector, media_type_column, with_magic
from docspark.operators.metadata import raw_metadata_column
from docspark.operators.unpack import (describe_embedded, embedded_name, is_container, rolled_up_text, unpack_documents,
                                       unpack_result)
from docspark.operators.parsing import (ColumnParser, PACKAGE_TYPES, apply_custom_parsers, markup_text, package_parts,
                                        package_text, plain_text, xml_is_malformed)
from docspark.session import materialize

HTML_TYPES = (V.TEXT_HTML, V.XHTML)


def _is_textual(media_type):
    return F.startswith(media_type, F.lit("text/")) | media_type.isin("application/json", "application/javascript")


def parse_documents(df: DataFrame, content: str = "content", name: str | None = "path",
                    hint: str | None = None, output_format: str = "xhtml", mode: str = "string",
                    custom_detectors: Sequence[Detector] = (),
                    custom_parsers: Mapping[str, ColumnParser] | None = None,
                    strict: bool = False, charset: str | None = None, embedded_depth: int = 0,
                    rules: Sequence[MagicRule] | None = None, globs: Sequence[tuple[str, Sequence[str]]] | None = None,
                    supertypes: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``media_type, text, content, raw_metadata, metadata, error`` to documents.

    ``charset`` names a column with declared charsets, for documents that declare none themselves. With
    ``embedded_depth`` the text goes on with that of the documents embedded in it, down to that depth and in their
    order; the parsed rows are then written once, and only the contents of containers beside them. Detectors, ``rules``,
    ``globs`` and ``supertypes`` are those of :func:`detect_media_type`; they hold for embedded documents too.

    One narrow pass: detect, dispatch by type, describe, render. The source bytes are
    replaced by the extracted content. Packages are opened in Python, which gets no bytes of
    other documents.
    """
    if mode not in ("string", "file", "stream"):
        raise ValueError(f"{V.INVALID_ARGUMENT}: output mode {mode}")
    if mode != "string" and output_format not in V.OUTPUT_FORMATS:
        raise ValueError(f"{V.INVALID_OUTPUT_FORMAT}: {output_format}")
    if embedded_depth:
        out = _parse_with_embedded(df, embedded_depth, content, name, hint, output_format, custom_parsers, charset,
                                   custom_detectors=custom_detectors, rules=rules, globs=globs, supertypes=supertypes)
        return raise_on_error(out) if strict else out
    keep = [c for c in df.columns if c not in {content, name, hint, charset}]
    missing = F.lit(None).cast("string")
    given = F.nullif(F.trim(F.col(hint)), F.lit("")) if hint else missing
    path = F.col(name) if name else missing
    df, magic = with_magic(df, content, rules)
    detected = media_type_column(F.col(content), path, given if hint else None, custom_detectors, rules, globs, supertypes, magic)

    docs = df.select(
        *keep, path.alias("_name"), given.alias("_override"), F.col(content).alias("_bytes"),
        detected.alias("media_type"), input_error(F.col(content), path if name else None).alias("_input_error"),
        (F.col(charset) if charset else missing).alias("_charset"),
    )
    kind = F.col("media_type")
    parsed_as_text = _is_textual(kind) | kind.isin(V.XML, V.XHTML) | F.endswith(kind, F.lit("+xml"))
    marked_up = kind.isin(V.XML, *HTML_TYPES) | F.endswith(kind, F.lit("+xml"))
    own = F.when(marked_up, markup_charset(F.col("_bytes")))
    decoded = plain_text(F.col("_bytes"), F.coalesce(own, F.col("_charset")))
    docs = docs.withColumn("_text", F.when(parsed_as_text, decoded))
    docs = docs.withColumn("_mail", F.when(kind == V.MESSAGE, mail_parts_with_body(F.col("_bytes"))))
    docs = docs.withColumn("_parts", package_parts(F.col("_bytes"), kind))
    parts = F.col("_parts")
    if custom_parsers:
        docs = apply_custom_parsers(docs, custom_parsers, "_bytes", "media_type", "_custom")
    else:
        docs = docs.withColumn("_custom", missing).withColumn("parsed_by", missing)

    is_xml = (kind == V.XML) | (F.endswith(kind, F.lit("+xml")) & (kind != V.XHTML))
    bad_xml = is_xml & F.col("parsed_by").isNull() & xml_is_malformed(F.when(is_xml, F.col("_text")))
    error = F.when(F.col("_input_error").isNotNull(), F.col("_input_error")).when(
        bad_xml, make_error(V.PARSE_ERROR, "malformed XML"))
    error = error.when(kind.isin(*PACKAGE_TYPES) & parts.isNull() & F.col("parsed_by").isNull(),
                       make_error(V.PARSE_ERROR, "broken package"))
    docs = docs.withColumn("error", error.otherwise(F.lit(None).cast(ERROR_TYPE)))

    text = (
        F.when(F.col("error").isNotNull(), missing)
        .when(F.col("parsed_by").isNotNull(), F.col("_custom"))
        .when(kind.isin(*HTML_TYPES), html_to_text(F.col("_text")))
        .when(is_xml, xml_to_text(F.col("_text")))
        .when(kind == V.MESSAGE, mail_text(F.col("_mail")))
        .when(_is_textual(kind), F.col("_text"))
    )
    text = text.when(kind.isin(*PACKAGE_TYPES), package_text(parts, kind))
    # Types without a parser have no text, which is no error.
    docs = docs.withColumn("text", text.otherwise(F.when(kind.isNotNull(), F.lit(""))))

    has_parser = parsed_as_text | kind.isin(V.MESSAGE, *PACKAGE_TYPES)
    by = F.coalesce("parsed_by", F.when(F.col("error").isNull(), F.when(has_parser, "DefaultParser").otherwise("EmptyParser")))
    raw = raw_metadata_column(kind, F.col("_bytes"), F.col("_text"), F.col("_name"), F.col("_override"), parts, by)
    docs = docs.withColumn("raw_metadata", raw).withColumn("metadata", M.normalized("raw_metadata"))
    rendered = F.col("text")
    if output_format == "xhtml":
        rendered = to_xhtml(F.col("text"), F.col("metadata.title"), F.col("raw_metadata"))
    out = docs.select(
        *keep, F.col("_name").alias(name or "path"), "media_type", "text", rendered.alias("content"),
        "raw_metadata", "metadata", "error",
    )
    return raise_on_error(out) if strict else out


def _parse_with_embedded(df: DataFrame, depth: int, content: str, name: str | None, hint: str | None, output_format: str,
                         custom_parsers: Mapping[str, ColumnParser] | None, charset: str | None, **detection) -> DataFrame:
    numbered = df.withColumn("_root", F.monotonically_increasing_id()).withColumn("_source", F.col(content))
    parsed = parse_documents(numbered, content, name, hint, "txt", custom_parsers=custom_parsers, charset=charset, **detection)
    opened = is_container(F.col("media_type")) & F.col("error").isNull()
    parsed = materialize(parsed.withColumn("_source", F.when(opened, F.col("_source"))), "parsed")
    children = unpack_documents(parsed.where("_source IS NOT NULL"), depth, "_root", "_source", name, "media_type", "_root", **detection)
    # A body that stands for its message, what a page runs, and a book's chapters are in their parent's text already.
    in_mail = F.col("parent_type").rlike("^message/rfc822$|^multipart/")
    body = in_mail & F.col("name").isNull() & F.col("media_type").rlike("^text/(?:plain|html)$|^multipart/")
    within = body | F.col("parent_type").isin(*HTML_TYPES, V.EPUB)
    texts = parse_documents(
        children.where(F.col("error").isNull() & ~within).select("root_no", "ord_path", "name", "media_type", "charset", "content"),
        name="name", hint="media_type", output_format="txt", custom_parsers=custom_parsers, charset="charset")
    rolled = rolled_up_text(texts).select(F.col("root_no").alias("_root"), F.col("text").alias("_embedded"))
    joined = parsed.drop("_source").join(rolled, "_root", "left").drop("_root")
    whole = F.when(F.col("text").isNull(), None).otherwise(F.concat_ws("\n", F.nullif("text", F.lit("")), F.col("_embedded")))
    joined = joined.withColumn("text", whole).drop("_embedded")
    rendered = F.col("text")
    if output_format == "xhtml":
        rendered = to_xhtml(F.col("text"), F.col("metadata.title"), F.col("raw_metadata"))
    return joined.withColumn("content", rendered)


def parse_to_string(df: DataFrame, output_format: str = "txt", **options) -> DataFrame:
    """Default output mode: the content in a column beside the metadata."""
    return parse_documents(df, output_format=output_format, mode="string", **options)


def analyze_documents(df: DataFrame, profiles: DataFrame, id_cols: list[str], **options) -> DataFrame:
    """Media type, text, metadata and language of documents, without a shuffle.

    The parsed rows are written once: the language scorer names the text several times, and the
    plan would otherwise parse each document as often.
    """
    parsed = materialize(parse_documents(df, output_format="txt", **options), "parsed")
    return with_language(parsed, profiles, id_cols, "text")


def unpack(df: DataFrame, max_depth: int = 1, id_col: str = "doc_id", content: str = "content",
           name: str | None = None, hint: str | None = None, custom_detectors: Sequence[Detector] = (),
           rules: Sequence[MagicRule] | None = None, globs: Sequence[tuple[str, Sequence[str]]] | None = None,
           supertypes: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(result, children): root metadata with lists of children, and the children's content.

    The children are the flat table to write out; the result lists them by name and
    metadata, without content. A root without content has an empty list and a ``root_error``; roots of equal or
    no id keep their own children.
    """
    missing = F.lit(None).cast("string")
    path = F.col(name) if name else missing
    given = F.nullif(F.trim(F.col(hint)), F.lit("")) if hint else missing
    df, magic = with_magic(df, content, rules)
    kind = media_type_column(F.col(content), path, given if hint else None, custom_detectors, rules, globs, supertypes, magic)
    typed = df.select(
        id_col, path.alias("_name"), given.alias("_override"), F.col(content).alias("_bytes"), kind.alias("_kind"))
    text = F.when(F.col("_kind").isin(*HTML_TYPES), markup_text(F.col("_bytes")))
    parts = package_parts(F.col("_bytes"), F.col("_kind"))
    typed = typed.withColumn("_text", text).withColumn("_parts", parts)
    raw = raw_metadata_column(F.col("_kind"), F.col("_bytes"), F.col("_text"), F.col("_name"), F.col("_override"), F.col("_parts"))
    # Written once: the numbers that tell roots apart hold for both results, and only containers keep their bytes.
    roots = materialize(typed.select(
        id_col, F.monotonically_increasing_id().alias("root_no"), "_name", "_kind", raw.alias("raw_metadata"),
        F.when(is_container(F.col("_kind")), F.col("_bytes")).alias("_bytes"),
        input_error(F.col("_bytes"), F.col("_name") if name else None).alias("root_error")), "roots")
    children = unpack_documents(roots, max_depth, id_col, "_bytes", "_name", "_kind", "root_no",
                                custom_detectors=custom_detectors, rules=rules, globs=globs, supertypes=supertypes)
    children = describe_embedded(embedded_name(children, max_depth))
    described = roots.withColumn("metadata", M.normalized("raw_metadata"))
    return unpack_result(described, children, id_col), children
