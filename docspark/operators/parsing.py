"""Content extraction per kind of document, and dispatch over all of them."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions.charsets import charset_name, declared_text, markup_charset
from docspark.functions.html import html_to_text, xml_to_text
from docspark.functions.mail import header_map, mail_parts_with_body, mail_text
from docspark.functions.text import (UTF16_BE_BOM, UTF16_LE_BOM, XML_NAMES, collapse_blank, decode_bytes, decode_text, let, normalize_newlines,
                                    text_encoding, unescape_entities)
from docspark.functions.xhtml import to_xhtml
from docspark.operators.errors import ERROR_TYPE, make_error

# A parser maps the content column to a text column (Column expression or pandas UDF).
ColumnParser = Callable[[Column], Column]

PACKAGE_TYPES = (V.DOCX, V.XLSX, V.PPTX, V.EPUB)
WORKBOOK_RELATIONS = "xl/_rels/workbook.xml.rels"
PARTS_TYPE = "array<struct<ord:int,name:string,content:binary>>"


def parse_text(df: DataFrame, content: str = "content", output: str = "text", charset: str | None = None) -> DataFrame:
    """Decode text and add its ``encoding``: by its mark, else the declared ``charset`` column, else by detection."""
    if charset is None:
        return df.withColumn("encoding", text_encoding(F.col(content))).withColumn(output, decode_text(F.col(content)))
    return df.withColumn("encoding", text_encoding(F.col(content), charset_name(F.col(charset)))).withColumn(
        output, plain_text(F.col(content), F.col(charset)))


def markup_text(content: Column) -> Column:
    """Text of a page or XML document by the charset that it declares itself."""
    return plain_text(content, markup_charset(content))


def plain_text(content: Column, charset: Column | None = None) -> Column:
    """Text of bytes by a charset given with them, else by detection."""
    if charset is None:
        return decode_text(content)
    return let(let(charset_name(charset), lambda name: declared_text(content, name)), lambda known: decode_text(content, known))


def parse_html_text(df: DataFrame, html: str = "html", output: str = "text") -> DataFrame:
    """Visible text of a page given as text, or as bytes in the charset that it declares."""
    page = markup_text(F.col(html)) if dict(df.dtypes)[html] == "binary" else F.col(html)
    return df.withColumn(output, html_to_text(page))


def xml_is_malformed(xml: Column) -> Column:
    """Whether the text is not one well-formed XML element. A NULL text is not judged."""
    # Declaration, comments and processing instructions may stand before and after the root.
    misc = r"\s++|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[[^\]]*\]\s*)?>"
    # The trailing search starts behind a tag only, so a long run of blanks is read once.
    body = F.regexp_replace(xml, rf"(?s)^\uFEFF?(?:{misc})*+|(?<=>)(?:{misc})++\z", "")
    return xml.isNotNull() & let(body, _is_broken_element)


def _is_broken_element(body: Column) -> Column:
    name = F.regexp_extract(body, r"^<([^\s<>/!?&]+)", 1)
    closing = F.regexp_extract(body, r"</([^\s<>/]+)\s*>\z", 1)
    alone = body.rlike(r"^<[^<]*/>\z")
    # The reader stops at the end of the first element. Renaming the outermost pair of tags
    # makes a second root, or text behind the first, a mismatch that it reports.
    renamed = F.concat(F.lit("<_root"), F.substring(body, F.length(name) + 2, F.length(body)))
    renamed = F.regexp_replace(renamed, r"</[^\s<>/]+\s*>\z", "</_root>")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    broken = F.from_xml(renamed, "_corrupt STRING", options)["_corrupt"].isNotNull()
    return (name == "") | (~alone & (closing != name)) | broken


def parse_xml(df: DataFrame, xml: str = "xml", output: str = "text") -> DataFrame:
    """Text nodes of XML; malformed input gives a NULL text and an ``error``."""
    malformed = xml_is_malformed(F.col(xml))
    return df.withColumn(
        "error", F.when(malformed, make_error(V.PARSE_ERROR, "malformed XML")).otherwise(F.lit(None).cast(ERROR_TYPE))
    ).withColumn(output, F.when(F.col("error").isNull(), xml_to_text(F.col(xml))))


def parse_message(df: DataFrame, eml: str = "eml") -> DataFrame:
    """Headers as a map, the decoded parts, and the preferred text of each message."""
    kind = dict(df.dtypes)[eml]
    content = F.col(eml) if kind == "binary" else F.encode(F.col(eml), "UTF-8")
    return (
        df.withColumn("headers", header_map(content))
        .withColumn("parts", mail_parts_with_body(content))
        .withColumn("text", mail_text(F.col("parts")))
    )


def _read_parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Text-bearing members of a ZIP package in the order of the archive; NULL when broken."""

    def wanted(name: str) -> bool:
        return name.lower().endswith((".xml", ".xhtml", ".html", ".htm", ".opf")) or name == WORKBOOK_RELATIONS

    def plain(data: bytes) -> bytes:
        # Of the charsets that XML parts may be in, all but UTF-16 keep ASCII as it is.
        return data.decode("utf-16", "replace").encode() if data[:2] in (UTF16_LE_BOM, UTF16_BE_BOM) else data

    def read(blob: bytes | None) -> list[dict] | None:
        if blob is None:
            return None
        try:
            with zipfile.ZipFile(io.BytesIO(blob)) as package:
                return [
                    {"ord": i, "name": info.filename, "content": plain(package.read(info))}
                    for i, info in enumerate(package.infolist()) if wanted(info.filename)
                ]
        except (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError, EOFError, ValueError, zlib.error):
            return None

    for batch in batches:
        yield batch.map(read)


def package_parts(content: Column, media_type: Column) -> Column:
    """Parts of packages; the bytes of other documents never leave the JVM."""
    return F.pandas_udf(_read_parts, PARTS_TYPE)(F.when(media_type.isin(*PACKAGE_TYPES), content))


def _is_text_part(media_type: Column, name: Column) -> Column:
    return (
        F.when(media_type == V.DOCX, name.rlike(r"^word/(?:document|header\d*|footer\d*|footnotes|endnotes)\.xml$"))
        .when(media_type == V.PPTX, name.rlike(r"^ppt/(?:slides|notesSlides)/[^/]+\.xml$"))
        .when(media_type == V.XLSX, name.rlike(r"^xl/worksheets/[^/]+\.xml$"))
        .otherwise(name.rlike(r"(?i)\.x?html?$"))
    )


def _part_order(name: Column, position: Column) -> Column:
    """Numbered parts (slides, sheets) by their number, others by their place in the package."""
    number = F.regexp_extract(name, r"/[A-Za-z]+(\d{1,9})\.xml$", 1)
    group = F.regexp_replace(name, r"\d+\.xml$", "")
    return F.struct(F.when(number != "", group).otherwise("").alias("g"),
                    F.when(number != "", number.cast("int")).otherwise(position).alias("n"))


def part_named(parts: Column, name: Column | str) -> Column:
    """Text of one part, NULL where the package has none of that name."""
    match = F.filter(parts, lambda p: p["name"] == name)
    return let(F.try_element_at(match, F.lit(1))["content"], _part_text)


def _part_text(content: Column) -> Column:
    return F.regexp_replace(normalize_newlines(decode_bytes(content)), "^\uFEFF", "")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an XML tag, NULL where it is absent or empty."""
    return F.nullif(F.regexp_extract(tag, rf"""\s{name}\s*=\s*["']([^"']*)""", 1), F.lit(""))


def _tags(xml: Column, name: str) -> Column:
    """Start tags of an element, whatever its prefix."""
    return F.coalesce(F.regexp_extract_all(xml, F.lit(rf"<(?:\w+:)?{name}\s[^>]*>"), F.lit(0)), F.array().cast("array<string>"))


def _path(folder: Column, target: Column) -> Column:
    """Name of the member that ``target`` means, seen from a folder; ``..`` goes up, a leading slash means the root."""
    whole = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(folder, target))

    def step(kept: Column, name: Column) -> Column:
        return F.when(name.isin("", "."), kept).when(name == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(
            F.concat(kept, F.array(name)))

    return F.array_join(F.aggregate(F.split(whole, "/"), F.array().cast("array<string>"), step), "/")


NAMED_PARTS = "array<struct<title:string,name:string>>"


def _sheets(parts: Column) -> Column:
    """(title, member) of the sheets in the order of the workbook; none without one."""
    def listed(book: Column, relations: Column) -> Column:
        targets = F.transform(_tags(relations, "Relationship"), lambda t: F.struct(
            _attribute(t, "Id").alias("id"), _attribute(t, "Target").alias("target")))

        def member(tag: Column) -> Column:
            key = _attribute(tag, r"\w+:id")
            found = F.try_element_at(F.filter(targets, lambda r: r["id"] == key), F.lit(1))["target"]
            return F.struct(unescape_entities(_attribute(tag, "name"), XML_NAMES).alias("title"), _path(F.lit("xl/"), found).alias("name"))

        return F.filter(F.transform(_tags(book, "sheet"), member), lambda s: s["name"].isNotNull())

    found = let(F.struct(part_named(parts, "xl/workbook.xml").alias("b"), part_named(parts, WORKBOOK_RELATIONS).alias("r")),
                lambda x: listed(x["b"], x["r"]))
    return found.cast(NAMED_PARTS)


def _in_order(parts: Column, media_type: Column) -> Column:
    """(no title, member) of the parts that hold text, numbered ones by number, others as they stand in the archive."""
    chosen = F.filter(parts, lambda p: _is_text_part(media_type, p["name"]))
    ordered = F.array_sort(F.transform(chosen, lambda p: F.struct(
        _part_order(p["name"], p["ord"]).alias("key"), p["name"].alias("name"))))
    return F.transform(ordered, lambda p: F.struct(F.lit(None).cast("string").alias("title"), p["name"].alias("name"))).cast(NAMED_PARTS)


def _spine(parts: Column) -> Column:
    """(no title, member) of a book's chapters in reading order; none without a package document."""
    def chapters(path: Column, opf: Column) -> Column:
        folder = F.regexp_replace(path, r"[^/]*$", "")
        items = F.transform(_tags(opf, "item"), lambda t: F.struct(
            _attribute(t, "id").alias("id"), _path(folder, F.try_url_decode(
                F.replace(F.replace(_attribute(t, "href"), F.lit("&amp;"), F.lit("&")), F.lit("+"), F.lit("%2B")))).alias("name")))

        def member(tag: Column) -> Column:
            key = _attribute(tag, "idref")
            found = F.try_element_at(F.filter(items, lambda i: i["id"] == key), F.lit(1))["name"]
            return F.struct(F.lit(None).cast("string").alias("title"), found.alias("name"))

        return F.filter(F.transform(_tags(opf, "itemref"), member), lambda s: s["name"].isNotNull())

    found = let(package_document_path(parts), lambda path: let(part_named(parts, path), lambda opf: chapters(path, opf)))
    return found.cast(NAMED_PARTS)


def package_document_path(parts: Column) -> Column:
    """Name of a book's package document: the one its container names, else the first."""
    first = F.try_element_at(F.filter(parts, lambda p: p["name"].rlike(r"(?i)\.opf$")), F.lit(1))["name"]
    named = F.try_element_at(_tags(part_named(parts, "META-INF/container.xml"), "rootfile"), F.lit(1))
    return F.coalesce(_attribute(named, "full-path"), first)


def _without(xml: Column, name: str) -> Column:
    """XML without an element and all inside it, however deep elements of that name stand in each other."""
    start, end = f"<{name}", f"</{name}>"
    pieces = F.split(F.regexp_replace(xml, rf"<{name}(?:\s[^>]*)?/>", ""), rf"(?=<{name}[\s>])|(?<=</{name}>)")
    state = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(held: Column, piece: Column) -> Column:
        depth = held["depth"] + F.startswith(piece, F.lit(start)).cast("int")
        kept = F.when(depth == 0, F.concat(held["kept"], F.array(piece))).otherwise(held["kept"])
        # An end without a start changes nothing.
        return F.struct(F.greatest(depth - F.endswith(piece, F.lit(end)).cast("int"), F.lit(0)).alias("depth"), kept.alias("kept"))

    return let(xml, lambda x: F.when(F.contains(x, F.lit(start)), F.array_join(
        F.aggregate(pieces, state, step, lambda held: held["kept"]), "")).otherwise(x))


def package_text(parts: Column, media_type: Column) -> Column:
    """Text of a package: its text-bearing parts in their order; sheets with their names, chapters as the book lists them."""
    def text_of(shared: Column, chosen: Column) -> Column:
        def part(p: Column) -> Column:
            content = F.try_element_at(F.filter(parts, lambda x: x["name"] == p["name"]), F.lit(1))["content"]
            text = let(let(content, _part_text), lambda x: F.when(media_type == V.XLSX, _sheet_text(x, shared)).when(
                media_type == V.EPUB, html_to_text(x)).otherwise(_office_text(x)))
            return F.concat_ws("\n", F.nullif(p["title"], F.lit("")), F.nullif(text, F.lit("")))

        return F.array_join(F.filter(F.transform(chosen, part), lambda t: t != ""), "\n")

    shared = F.when(media_type == V.XLSX, let(part_named(parts, "xl/sharedStrings.xml"), _shared_strings))
    listed = F.when(media_type == V.XLSX, _sheets(parts)).when(media_type == V.EPUB, _spine(parts))
    chosen = let(listed, lambda s: F.when(F.size(s) > 0, s).otherwise(_in_order(parts, media_type)))
    # Both are bound once, however many parts read them.
    return F.when(parts.isNotNull(), let(F.struct(shared.alias("shared"), chosen.alias("chosen")), lambda x: text_of(x["shared"], x["chosen"])))


def _runs_text(xml: Column) -> Column:
    """The ``t`` elements of a string item joined; what spells how it is read does not count."""
    runs = F.regexp_extract_all(F.regexp_replace(xml, r"(?s)<rPh\b.*?</rPh>", ""), F.lit(r"(?s)<(?:\w+:)?t(?:\s[^>]*)?>(.*?)</(?:\w+:)?t>"), F.lit(1))
    return unescape_entities(F.array_join(runs, ""), XML_NAMES)


def _shared_strings(xml: Column) -> Column:
    """The strings of a workbook, by number."""
    items = F.regexp_extract_all(xml, F.lit(r"(?s)<(?:\w+:)?si(?:\s[^>]*)?(?:/>|>.*?</(?:\w+:)?si>)"), F.lit(0))
    return F.transform(items, _runs_text)


def _sheet_text(xml: Column, shared: Column) -> Column:
    """A line for each cell that holds something, row by row: a shared string by its number, other values as they are."""
    cells = F.regexp_extract_all(xml, F.lit(r"(?s)<(?:\w+:)?c(?:\s[^>]*)?>.*?</(?:\w+:)?c>"), F.lit(0))

    def value(cell: Column) -> Column:
        kind = F.regexp_extract(cell, r"""^<(?:\w+:)?c\s[^>]*?\bt\s*=\s*["']([A-Za-z]+)""", 1)
        raw = unescape_entities(F.regexp_extract(cell, r"(?s)<(?:\w+:)?v(?:\s[^>]*)?>(.*?)</(?:\w+:)?v>", 1), XML_NAMES)
        number = raw.try_cast("int")
        return (F.when(kind == "s", F.coalesce(F.get(shared, number), F.lit("")))
                .when(kind == "inlineStr", _runs_text(cell))
                .when(kind == "b", F.when(raw == "1", "TRUE").when(raw == "0", "FALSE").otherwise(raw)).otherwise(raw))

    return collapse_blank(F.array_join(F.filter(F.transform(cells, value), lambda v: v != ""), "\n"))


def _office_text(xml: Column) -> Column:
    """Paragraphs end lines, runs inside them join without a break; field codes and deleted text are no text."""
    hidden = F.regexp_replace(xml, r"(?s)<w:(instrText|delText|delInstrText)(?:\s[^>]*)?>.*?</w:\1>", "")
    # Of two forms of the same content the first is read.
    tidy = F.regexp_replace(_without(hidden, "mc:Fallback"), r">\s*\n\s*<", "><")
    broken = F.regexp_replace(tidy, r"</(?:w:p|a:p)>|<(?:w:br|a:br|w:cr)\s*/>", "\n")
    broken = F.regexp_replace(broken, r"<w:tab\s*/>", "\t")
    office = F.regexp_replace(broken, r"(?s)<[a-zA-Z/!?][^>]*(?:>|\z)", "")
    return collapse_blank(unescape_entities(office, XML_NAMES))


def parse_package(df: DataFrame, content: str = "content", media_type: str = "media_type",
                  output: str = "text") -> DataFrame:
    """Text of docx, xlsx, pptx and epub packages. The parts stay in the row: no shuffle."""
    parts = df.withColumn("parts", package_parts(F.col(content), F.col(media_type)))
    is_package = F.col(media_type).isin(*PACKAGE_TYPES)
    return parts.withColumn(output, package_text(F.col("parts"), F.col(media_type))).withColumn(
        "error",
        F.when(is_package & F.col("parts").isNull(), make_error(V.PARSE_ERROR, "broken package"))
        .otherwise(F.lit(None).cast(ERROR_TYPE)),
    )


def render_content(df: DataFrame, output_format: str = "xhtml", mode: str = "string", text: str = "text",
                   title: str | None = None, raw: str | None = None, output: str = "content") -> DataFrame:
    """Render text as ``txt`` or ``xhtml``.

    In string mode any other format means plain text; in file and stream mode it is an error.
    """
    if mode not in ("string", "file", "stream"):
        raise ValueError(f"{V.INVALID_ARGUMENT}: output mode {mode}")
    if mode != "string" and output_format not in V.OUTPUT_FORMATS:
        raise ValueError(f"{V.INVALID_OUTPUT_FORMAT}: {output_format}")
    value = F.col(text)
    if output_format == "xhtml":
        value = to_xhtml(
            value,
            F.col(title) if title else F.lit(None).cast("string"),
            F.col(raw) if raw else F.create_map().cast("map<string,string>"),
        )
    return df.withColumn(output, value)


def apply_custom_parsers(df: DataFrame, custom_parsers: Mapping[str, ColumnParser], content: str = "content",
                         media_type: str = "media_type", output: str = "text") -> DataFrame:
    """Text by the user's parser of the row's type, NULL for types without one.

    Adds ``parsed_by``. Each parser sees the content of its own type and NULL elsewhere,
    so a pandas UDF ships only the bytes that it parses.
    """
    text, by = F, F
    for kind, parser in custom_parsers.items():
        own = F.col(media_type) == kind
        text = text.when(own, parser(F.when(own, F.col(content))))
        by = by.when(own, getattr(parser, "__name__", type(parser).__name__))
    if not custom_parsers:
        return df.withColumn(output, F.lit(None).cast("string")).withColumn("parsed_by", F.lit(None).cast("string"))
    return df.withColumn(output, text.otherwise(None)).withColumn("parsed_by", by.otherwise(None))
