"""Internet messages: headers, MIME parts and preferred text, as column expressions.

A message is handled as Latin-1 text, where each character stands for one byte, so bodies
of any charset pass through unchanged until a part is decoded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions.charsets import charset_name, declared_text
from docspark.functions.html import html_to_text
from docspark.functions.text import decode_bytes, decode_text, let, normalize_newlines

ENTRIES = "array<struct<key:string,value:string>>"


def message_text(content: Column) -> Column:
    text = normalize_newlines(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, r"^\n+", "")


def _head(entity: Column) -> Column:
    head = F.when(F.startswith(entity, F.lit("\n")), "").otherwise(F.substring_index(entity, "\n\n", 1))
    return F.regexp_replace(head, r"\n[ \t]+", " ")


def _body(entity: Column) -> Column:
    skipped = F.length(F.substring_index(entity, "\n\n", 1)) + 2
    start = F.when(F.startswith(entity, F.lit("\n")), 1).otherwise(skipped)
    return F.substring(entity, start + 1, F.length(entity))


def to_bytes(text: Column) -> Column:
    return F.encode(text, "ISO-8859-1")


def header_values(head: Column, names: list[str]) -> Column:
    """Array with the first value of each header, NULL where absent."""
    values = F.array(*[F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*)$", 1) for name in names])
    return F.transform(values, lambda v: decode_words(F.nullif(F.rtrim(v), F.lit(""))))


def parameter(value: Column, name: str) -> Column:
    """Parameter of a structured header, quoted or bare."""
    found = F.regexp_extract(value, rf'(?i);\s*{name}\s*=\s*("[^"]*"|[^\s;"]+)', 1)
    return F.nullif(F.replace(found, F.lit('"'), F.lit("")), F.lit(""))


def quoted_printable(text: Column) -> Column:
    """Decode quoted-printable to bytes: runs of codes are hex but for their marks, any other text gives the hex of its bytes."""

    def piece(value: Column) -> Column:
        codes = F.startswith(value, F.lit("=")) & (F.length(value) > 1)
        return F.when(codes, F.replace(value, F.lit("="), F.lit(""))).otherwise(F.hex(to_bytes(value)))

    unfolded = F.regexp_replace(text, r"=[ \t]*\n", "")
    # A mark that no code follows is text.
    pieces = F.regexp_extract_all(unfolded, F.lit(r"(?:=[0-9A-Fa-f]{2})++|[^=]++|="), F.lit(0))
    return F.unhex(F.array_join(F.transform(pieces, piece), ""))


def base64_bytes(text: Column) -> Column:
    # Runs of the alphabet are found much faster than what stands between them.
    runs = F.regexp_extract_all(text, F.lit("[A-Za-z0-9+/=]++"), F.lit(0))
    return F.try_to_binary(F.array_join(runs, ""), F.lit("base64"))


def decode_words(value: Column) -> Column:
    """Decode ``=?charset?B|Q?text?=`` words of a header by their charset; other bytes by charset detection."""
    word = r"^=\?([^?*]+)(?:\*[^?]*)?\?([bBqQ])\?([^?]*)\?=$"

    def token(part: Column) -> Column:
        kind, text = F.upper(F.regexp_extract(part, word, 2)), F.regexp_extract(part, word, 3)
        name = charset_name(F.regexp_extract(part, word, 1))
        content = (
            F.when(kind == "B", base64_bytes(text))
            .when(kind == "Q", quoted_printable(F.translate(text, "_", " ")))
            .otherwise(to_bytes(part))
        )
        return let(content, lambda c: F.coalesce(F.when(kind != "", declared_text(c, name)), decode_bytes(c)))

    def decoded(value: Column) -> Column:
        joined = F.regexp_replace(value, r"(\?=)[ \t]+(=\?)", "$1$2")
        tokens = F.regexp_extract_all(joined, F.lit(r"=\?[^?]+\?[bBqQ]\?[^?]*\?=|=|[^=]+"), F.lit(0))
        plain = value.isNull() | ~value.rlike(r"=\?|[^\x00-\x7F]")
        return F.when(plain, value).otherwise(F.array_join(F.transform(tokens, token), ""))

    return let(value, decoded)


def header_map(content: Column) -> Column:
    """All headers as a map; the first value wins when a header repeats."""
    lines = F.filter(F.split(_head(message_text(content)), "\n"), lambda x: x.rlike(r"^[!-9;-~]+:"))

    def entry(line: Column) -> Column:
        value = F.trim(F.regexp_replace(line, r"^[^:]*:", ""))
        return F.struct(F.substring_index(line, ":", 1).alias("key"), decode_words(value).alias("value"))

    return let(F.transform(lines, entry), first_entries)


def first_entries(pairs: Column) -> Column:
    """Map from an array of pairs; the first value of a repeated key wins."""
    keys = F.transform(pairs, lambda p: p["key"])
    return let(keys, lambda names: F.map_from_entries(
        F.filter(pairs, lambda p, i: F.array_position(names, p["key"]) == i + 1)))


def _boundary(head: Column) -> Column:
    content_type = F.regexp_extract(head, r"(?im)^content-type:[ \t]*(.*)$", 1)
    is_multipart = F.startswith(F.lower(content_type), F.lit("multipart/"))
    return F.when(is_multipart, parameter(content_type, "boundary"))


def _entities(message: Column) -> Column:
    """Leaf entities of a message: a multipart one opens to its parts, any other is itself."""
    return let(_boundary(_head(message)), lambda outer: F.when(outer.isNull(), F.array(message)).otherwise(_opened(message, outer)))


def _opened(message: Column, outer: Column) -> Column:
    """Leaf entities of a multipart message, in one pass over its boundary lines with a stack of open boundaries.

    The message is cut at the lines that any boundary named in it would make. A line of an open boundary ends the entity
    before it and all boundaries inside that one; it opens the next entity, or closes its level. Any other line is text.
    """
    said = F.regexp_extract_all(message, F.lit(r'(?i)boundary\s*=\s*("[^"\n]*"|[^\s;"]+)'), F.lit(1))
    names = F.filter(F.array_distinct(F.transform(said, lambda x: F.replace(x, F.lit('"'), F.lit("")))), lambda x: x != "")
    quoted = F.array_join(F.transform(names, lambda x: F.concat(F.lit("\\Q"), x, F.lit("\\E"))), "|")
    line = F.concat(F.lit(r"\n(?=--(?:"), quoted, F.lit(r")(?:--)?[ \t]*(?:\n|\z))"))
    # The first piece stands before all boundaries.
    pieces = F.split(F.concat(F.lit("\n"), _body(message)), line)
    nothing = F.lit(None).cast("string")
    start = F.struct(F.array(outer).alias("open"), F.array().cast("array<string>").alias("done"), nothing.alias("now"))

    def finished(held: Column) -> Column:
        return F.when(held["now"].isNull(), held["done"]).otherwise(F.concat(held["done"], F.array(held["now"])))

    def entered(held: Column, level: Column, entity: Column) -> Column:
        # A multipart entity has no text of its own; its boundary is open from here on.
        opened = F.slice(held["open"], 1, level)
        return let(_boundary(_head(entity)), lambda inner: F.struct(
            F.when(inner.isNull(), opened).otherwise(F.concat(opened, F.array(inner))).alias("open"),
            finished(held).alias("done"), F.when(inner.isNull(), entity).otherwise(nothing).alias("now")))

    def closed(held: Column, level: Column) -> Column:
        return F.struct(F.slice(held["open"], 1, level - 1).alias("open"), finished(held).alias("done"), nothing.alias("now"))

    def step(held: Column, piece: Column) -> Column:
        def by(mark: Column) -> Column:
            # The innermost boundary counts; a name that ends in dashes may look like the end of a shorter one.
            last = F.size(held["open"]) + 1
            starts = last - F.array_position(F.reverse(held["open"]), mark)
            ends = last - F.array_position(F.reverse(held["open"]), F.regexp_replace(mark, "--$", ""))
            rest = F.substring(piece, F.length(F.substring_index(piece, "\n", 1)) + 2, F.length(piece))
            more = F.struct(held["open"].alias("open"), held["done"].alias("done"),
                            F.concat(held["now"], F.lit("\n"), piece).alias("now"))
            closes = mark.endswith("--") & (ends < last)
            return F.when((starts < last) & ~(closes & (ends > starts)), entered(held, starts.cast("int"), rest)).when(
                closes, closed(held, ends.cast("int"))).otherwise(more)

        return let(F.regexp_replace(F.substring_index(piece, "\n", 1), r"^--|[ \t]+$", ""), by)

    return F.aggregate(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), start, step, finished)


def _part(entity: Column) -> Column:
    names = ["Content-Type", "Content-Disposition", "Content-Transfer-Encoding", "Content-ID"]
    headers = let(_head(entity), lambda head: header_values(head, names))
    return let(headers, lambda h: _decoded_part(entity, h[0], h[1], h[2], h[3]))


def _decoded_part(entity: Column, content_type: Column, disposition: Column, encoding: Column,
                  content_id: Column) -> Column:
    body = _body(entity)
    encoding = F.lower(F.trim(encoding))
    media_type = F.lower(F.regexp_extract(content_type, r"^\s*([^\s;]+/[^\s;]+)", 1))
    name = F.coalesce(parameter(disposition, "filename"), parameter(content_type, "name"))
    decoded = (
        F.when(encoding == "base64", base64_bytes(body))
        .when(encoding == "quoted-printable", quoted_printable(body))
        .when(F.startswith(media_type, F.lit("multipart/")), to_bytes(entity))
        .otherwise(to_bytes(body))
    )
    identifier = F.regexp_extract(content_id, "^<?([^>]*)>?$", 1)
    return F.struct(
        name.alias("name"),
        F.nullif(identifier, F.lit("")).alias("relationship_id"),
        F.coalesce(F.nullif(media_type, F.lit("")), F.lit(V.TEXT_PLAIN)).alias("media_type"),
        F.coalesce(decoded, to_bytes(body)).alias("content"),
        charset_name(parameter(content_type, "charset")).alias("charset"),
    )


def mime_parts(content: Column) -> Column:
    """Array of decoded parts of a multipart message; empty for a message with a plain body."""

    def entities(message: Column) -> Column:
        plain = _boundary(_head(message)).isNull()
        return F.when(plain, F.array().cast("array<string>")).otherwise(_entities(message))

    return F.transform(let(message_text(content), entities), _part)


def mail_parts_with_body(content: Column) -> Column:
    """Decoded leaf parts, the body of a plain message included."""
    return F.transform(_entities(message_text(content)), _part)


def preferred_part(parts: Column) -> Column:
    """The part whose text stands for a message: its first plain one, else its first in HTML."""

    def first(media_type: str) -> Column:
        match = F.filter(parts, lambda p: (p["media_type"] == media_type) & p["content"].isNotNull())
        return F.try_element_at(match, F.lit(1))

    return F.coalesce(first(V.TEXT_PLAIN), first(V.TEXT_HTML))


def mail_text(parts: Column) -> Column:
    """Preferred text of a message by its declared charset; HTML is rendered."""
    def text(part: Column) -> Column:
        decoded = let(declared_text(part["content"], part["charset"]), lambda known: decode_text(part["content"], known))
        return let(decoded, lambda t: F.when(part["media_type"] == V.TEXT_HTML, html_to_text(t)).otherwise(t))

    return F.rtrim(F.coalesce(let(preferred_part(parts), text), F.lit("")), F.lit("\n"))


def message_fields(content: Column) -> Column:
    """Array of (raw metadata key, value) of a message."""

    def fields(head: Column) -> Column:
        names = [name for name, _ in V.MESSAGE_HEADERS]
        known = F.arrays_zip(F.lit([key for _, key in V.MESSAGE_HEADERS]).alias("key"),
                             header_values(head, names).alias("value"))
        content_type = F.regexp_extract(head, r"(?im)^content-type:[ \t]*(multipart/.*)$", 1)
        subtype = F.nullif(F.regexp_extract(F.lower(content_type), r"^multipart/([^\s;]+)", 1), F.lit(""))
        extra = [("Multipart-Subtype", subtype), ("Multipart-Boundary", parameter(content_type, "boundary"))]
        more = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in extra])
        return F.concat(known.cast(ENTRIES), more.cast(ENTRIES))

    return let(_head(message_text(content)), fields)
