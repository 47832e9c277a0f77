"""Rendering of extracted text as well-formed XHTML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.html import escape_markup

# Characters that XML 1.0 does not allow.
ILLEGAL = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{FFFE}\\x{FFFF}]"


def _clean(text: Column) -> Column:
    return escape_markup(F.regexp_replace(text, ILLEGAL, ""))


def to_xhtml(text: Column, title: Column, metadata: Column) -> Column:
    """XHTML document: sorted metadata, title, one paragraph per line of text."""
    metas = F.array_join(
        F.transform(
            F.array_sort(F.map_entries(F.map_filter(metadata, lambda k, v: v.isNotNull()))),
            lambda e: F.concat(F.lit('<meta name="'), _clean(e["key"]), F.lit('" content="'),
                               _clean(e["value"]), F.lit('"/>\n')),
        ),
        "",
    )
    body = F.regexp_replace(_clean(text), "\n+", "</p>\n<p>")
    return F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><html xmlns="http://www.w3.org/1999/xhtml">\n<head>\n'),
        F.coalesce(metas, F.lit("")),
        F.lit("<title>"), _clean(F.coalesce(title, F.lit(""))), F.lit("</title>\n</head>\n<body><p>"),
        body, F.lit("</p>\n</body></html>"),
    )
