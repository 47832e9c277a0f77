"""Raw metadata maps per kind of document, and normalisation to typed fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions.html import html_attribute, html_charset, html_language, html_meta, html_title
from docspark.functions.mail import ENTRIES, first_entries, message_fields
from docspark.functions.text import XML_NAMES, let, unescape_entities

EMPTY_MAP = "map<string,string>"


def entries_of(fields: list[tuple[str, Column]]) -> Column:
    """Array of (key, value) of the fields that have a value."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in fields])
    return F.filter(entries, lambda e: e["value"].isNotNull())


def merge_entries(*parts: Column) -> Column:
    """Map of all entries; the first value of a repeated key wins."""
    empty = F.array().cast(ENTRIES)
    return let(F.flatten(F.array(*[F.coalesce(p.cast(ENTRIES), empty) for p in parts])), first_entries)


def file_fields(name: Column, length: Column, media_type: Column, encoding: Column,
                override: Column) -> Column:
    return entries_of([
        (V.RESOURCE_NAME, name),
        (V.CONTENT_LENGTH, length),
        (V.CONTENT_TYPE, media_type),
        (V.CONTENT_TYPE_OVERRIDE, override),
        (V.CONTENT_ENCODING, encoding),
    ])


def html_fields(html: Column) -> Column:
    known = entries_of([
        ("dc:title", html_title(html)),
        ("dc:language", html_language(html)),
        (V.CONTENT_ENCODING, html_charset(html)),
    ])
    return F.concat(known, html_meta(html))


def mail_fields(content: Column) -> Column:
    return F.filter(message_fields(content), lambda e: e["value"].isNotNull())


def package_fields(core_xml: Column, app_xml: Column) -> Column:
    def fields(table: list[tuple[str, str]]):
        patterns = [rf"(?s)<{name}(?:\s[^>]*)?>([^<]*)</{name}>" for name, _ in table]
        return lambda xml: F.transform(
            F.arrays_zip(F.lit([key for _, key in table]).alias("key"),
                         F.array(*[F.trim(F.regexp_extract(xml, p, 1)) for p in patterns]).alias("value")),
            lambda e: F.struct(e["key"].alias("key"),
                               F.nullif(unescape_entities(e["value"], XML_NAMES), F.lit("")).alias("value")))

    empty = F.array().cast(ENTRIES)
    both = F.concat(F.coalesce(let(core_xml, fields(V.CORE_PROPERTIES)), empty),
                    F.coalesce(let(app_xml, fields(V.APP_PROPERTIES)), empty))
    return F.filter(both, lambda e: e["value"].isNotNull())


def book_fields(opf: Column) -> Column:
    """What a book's package document says: the Dublin Core fields and its version."""
    version = let(F.regexp_extract(opf, r"<(?:\w+:)?package\s[^>]*>", 0), lambda tag: html_attribute(tag, "version"))
    return F.concat(package_fields(opf, F.lit(None).cast("string")), entries_of([("epub:version", version)]))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def raw_value(raw: str, keys: list[str]) -> str:
    """SQL for the value under the first key that is present, even when it is empty."""
    if len(keys) == 1:
        return f"try_element_at({raw}, {_quoted(keys[0])})"
    cases = " ".join(f"WHEN map_contains_key({raw}, {_quoted(k)}) THEN {raw}[{_quoted(k)}]" for k in keys)
    return f"CASE {cases} END"


# Number texts that convert: single underscores may stand between digits.
INTEGER = r"^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$"
FLOATING = (r"(?i)^\\s*[+-]?(([0-9]+(_[0-9]+)*\\.?([0-9]+(_[0-9]+)*)?|\\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?"
            r"|inf|infinity|nan)\\s*$")


def _number(value: str, kind: str) -> str:
    pattern = INTEGER if kind == "bigint" else FLOATING
    return f"CASE WHEN {value} RLIKE '{pattern}' THEN try_cast(replace({value}, '_', '') AS {kind}) END"


def coerced(value: str, kind: str) -> str:
    """SQL for the typed value; empty text and zero become NULL, text that fails to convert too."""
    if kind in ("bigint", "double"):
        return f"nullif({_number(value, kind)}, CAST(0 AS {kind}))"
    if kind == "array<string>":
        trimmed = f"transform(split({value}, ','), x -> regexp_replace(x, '^\\\\s+|\\\\s+$', ''))"
        return f"CASE WHEN {value} <> '' THEN {trimmed} END"
    return f"nullif({value}, '')"


def normalized(raw: str) -> Column:
    """Struct of the normalised fields of the raw map in column ``raw``."""
    fields = [(name, kind, coerced(raw_value(raw, keys), kind)) for name, kind, keys in V.METADATA_FIELDS]
    fields += [(name, kind, "NULL") for name, kind in V.UNMAPPED_FIELDS]
    return F.expr("named_struct(" + ", ".join(f"'{n}', CAST({v} AS {k})" for n, k, v in fields) + ")")


def unparsed(raw: str) -> Column:
    """Map of numeric fields whose text did not convert."""
    pairs = []
    for name, kind, keys in V.METADATA_FIELDS:
        if kind in ("bigint", "double"):
            value = raw_value(raw, keys)
            pairs.append(f"'{name}', CASE WHEN {value} <> '' AND {_number(value, kind)} IS NULL THEN {value} END")
    return F.expr(f"map_filter(map({', '.join(pairs)}), (k, v) -> v IS NOT NULL)")
