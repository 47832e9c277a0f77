"""Text, title and embedded resources of HTML, and text of XML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.text import ALL_NAMES, XML_NAMES, collapse_blank, let, unescape_entities

# The rest of a tag behind its name. A quoted value may hold any character; where a quote stays open, or beyond
# 256 values, the tag ends at the next '>'. Bounded and without backtracking, so odd input costs no stack.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+){0,256}+[^>]*+(?:>|\z)"""
_TAG = r"<[a-zA-Z/!?]" + _REST


def _raw_element(name: str) -> str:
    """An element whose content is no markup; a page may be cut off before its end."""
    return rf"<{name}(?=[\s/>]){_REST}.*?(?:</{name}\s*>|\z)"


# One pass reads the pieces of a page: invisible ones, and tags as a whole (group 1), so that neither a comment mark
# inside a quoted value nor a '>' in one is taken for markup.
INVISIBLE = rf"(?is)<!--.*?(?:-->|\z)|{_raw_element('script')}|{_raw_element('style')}|{_raw_element('title')}|({_TAG})"
BLOCK_TAGS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header"
    r"|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)(?=[\s/>]|\z)" + _REST
)
ANY_TAG = r"(?s)" + _TAG

# Comments, instructions and the document type go; sections and tags (group 1) stay for the later steps.
XML_PIECES = (r"(?s)<!--.*?(?:-->|\z)|<\?.*?(?:\?>|\z)|<!DOCTYPE[^>\[]*+(?:\[.*?\]\s*+)?+>"
              r"|(<!\[CDATA\[.*?(?:\]\]>|\z)|<[^\s<>!?&]" + _REST + ")")
XML_TAG = r"(?s)<[^\s<>!?&]" + _REST

_DATA_TYPE = r"data:[a-z]+/[a-z0-9.+-]+(?:;[a-z0-9-]+=[^;,\"'\s<>]+)*"
EMBEDDED = (
    rf"(?is){_raw_element('script')}|{_raw_element('style')}"
    rf"|{_DATA_TYPE};base64,[a-z0-9+/=]+|(?<=[\"'(=]){_DATA_TYPE},[^\"'\s<>)]*"
)


def html_to_text(html: Column) -> Column:
    """Visible text of a page, one line per block."""
    text = F.regexp_replace(html, INVISIBLE, "$1")
    text = F.regexp_replace(text, BLOCK_TAGS, "\n")
    text = F.regexp_replace(text, ANY_TAG, "")
    return collapse_blank(unescape_entities(text, ALL_NAMES))


def html_title(html: Column) -> Column:
    title = F.regexp_extract(html, rf"(?is)<title(?=[\s/>]){_REST}(.*?)(?:</title\s*>|\z)", 1)
    title = F.regexp_replace(F.regexp_replace(title, ANY_TAG, ""), r"\s+", " ")
    return F.nullif(F.trim(unescape_entities(title)), F.lit(""))


def html_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute inside one start tag: double quoted, single quoted or bare."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.nullif(unescape_entities(F.concat(*groups)), F.lit(""))


def html_language(html: Column) -> Column:
    return let(F.regexp_extract(html, rf"(?is)<html(?=[\s/>]){_REST}", 0), lambda tag: html_attribute(tag, "lang"))


def html_charset(html: Column) -> Column:
    charset = F.regexp_extract(html, r"""(?is)<meta\s[^>]*charset\s*=\s*["']?([a-z0-9_:.-]+)""", 1)
    return F.nullif(F.upper(charset), F.lit(""))


def html_meta(html: Column) -> Column:
    """Array of (key, value) from ``<meta name=... content=...>`` tags."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<meta(?=[\s/]){_REST}"), F.lit(0))
    pairs = F.transform(
        tags,
        lambda tag: F.struct(html_attribute(tag, "name").alias("key"),
                             html_attribute(tag, "content").alias("value")),
    )
    return F.filter(pairs, lambda p: p["key"].isNotNull() & p["value"].isNotNull())


def html_embedded(html: Column) -> Column:
    """Array of inline resources: scripts, style sheets and data URIs."""
    pieces = F.regexp_extract_all(html, F.lit(EMBEDDED), F.lit(0))

    def resource(piece: Column) -> Column:
        is_data = F.lower(F.substring(piece, 1, 5)) == "data:"
        is_script = F.lower(F.substring(piece, 1, 7)) == "<script"
        inner = F.regexp_replace(piece, rf"(?is)^<{_REST}|</(?:script|style)\s*>\z", "")
        payload = F.regexp_replace(piece, r"^[^,]*,", "")
        data = F.when(piece.rlike("(?i)^[^,]*;base64,"), F.try_to_binary(payload, F.lit("base64"))).otherwise(_percent_bytes(payload))
        media_type = (
            F.when(is_data, F.lower(F.regexp_extract(piece, r"(?i)^data:([a-z]+/[a-z0-9.+-]+)", 1)))
            .when(is_script, "application/javascript")
            .otherwise("text/css")
        )
        return F.struct(
            F.lit(None).cast("string").alias("name"),
            F.lit(None).cast("string").alias("relationship_id"),
            media_type.alias("media_type"),
            F.when(is_data, F.coalesce(data, F.encode(piece, "UTF-8")))
            .otherwise(F.encode(inner, "UTF-8")).alias("content"),
            F.lit(None).cast("string").alias("charset"),
        )

    return F.transform(pieces, resource)


def _percent_bytes(text: Column) -> Column:
    """Bytes of a percent-encoded text; a mark that no code follows stands for itself."""
    def piece(value: Column, index: Column) -> Column:
        code, plain = F.substring(value, 1, 2), F.hex(F.encode(value, "UTF-8"))
        return (F.when(index == 0, plain)
                .when(code.rlike("^[0-9A-Fa-f]{2}$"), F.concat(F.upper(code), F.substring(plain, F.lit(5), F.length(plain))))
                .otherwise(F.concat(F.lit("25"), plain)))

    return F.unhex(F.array_join(F.transform(F.split(text, "%"), piece), ""))


def xml_to_text(xml: Column) -> Column:
    """Text nodes of well-formed XML."""
    text = F.regexp_replace(xml, XML_PIECES, "$1")
    # A CDATA section is literal text: escape its markup so that the steps below keep it.
    text = let(text, lambda t: F.when(F.contains(t, F.lit("<![CDATA[")), _open_cdata(t)).otherwise(t))
    text = F.regexp_replace(text, XML_TAG, "\n")
    return collapse_blank(unescape_entities(text, XML_NAMES))


def _open_cdata(text: Column) -> Column:
    def piece(value: Column, index: Column) -> Column:
        literal = F.substring_index(value, "]]>", 1)
        rest = F.substring(value, F.length(literal) + 4, F.length(value))
        return F.when(index == 0, value).otherwise(F.concat(escape_markup(literal), rest))

    return F.array_join(F.transform(F.split(text, r"<!\[CDATA\["), piece), "")


def escape_markup(text: Column) -> Column:
    """Escape text for XML content and attribute values."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text
