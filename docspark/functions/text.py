"""Bytes to text: charset detection, line ends, entities."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

UTF8_BOM, UTF16_LE_BOM, UTF16_BE_BOM = b"\xef\xbb\xbf", b"\xff\xfe", b"\xfe\xff"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body reads it.

    Catalyst inlines column expressions, and shares repeated ones neither inside lambdas nor
    across CASE branches; nesting would repeat a costly value exponentially.
    """
    # A body with a second, optional argument must not be given the index.
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a key in a constant table, NULL when absent.

    The table is one literal that folds to a map, where a CASE or ``create_map`` would put
    hundreds of nodes into every plan that uses it.
    """
    text = "\x02".join(f"{k}\x01{v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x01")), key)


def _starts(content: Column, prefix: bytes) -> Column:
    return F.substring(content, 1, len(prefix)) == F.lit(prefix)


def after(value: Column, count: int) -> Column:
    """``value`` without its first ``count`` characters or bytes."""
    return F.substring(value, count + 1, 2147483647)


def text_encoding(content: Column, charset: Column | None = None) -> Column:
    """Name of the charset: byte order mark first, then the declared one, then valid UTF-8, else Latin-1.

    ``charset`` is a declared charset by its ``charset_name``, NULL where none is known.
    """
    named = F.lit(None).cast("string") if charset is None else F.upper(charset)
    return (
        F.when(content.isNull(), None)
        .when(_starts(content, UTF16_LE_BOM), "UTF-16LE")
        .when(_starts(content, UTF16_BE_BOM), "UTF-16BE")
        .when(_starts(content, UTF8_BOM) & F.is_valid_utf8(content.cast("string")), "UTF-8")
        .when(named.isNotNull(), named)
        .when(F.is_valid_utf8(content.cast("string")), "UTF-8")
        .otherwise("ISO-8859-1")
    )


def normalize_newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def decode_text(content: Column, declared: Column | None = None) -> Column:
    """Decode bytes by :func:`text_encoding`, drop the mark and normalise line ends.

    ``declared`` is the text by the declared charset, NULL where none is known.
    """
    utf8 = F.regexp_replace(content.cast("string"), "^\uFEFF", "")
    valid = F.is_valid_utf8(content.cast("string"))
    text = F.when(_starts(content, UTF16_LE_BOM) | _starts(content, UTF16_BE_BOM), _utf16(content))
    if declared is not None:
        text = text.when(_starts(content, UTF8_BOM) & valid, utf8).when(declared.isNotNull(), declared)
    text = text.when(valid, utf8).otherwise(F.decode(content, "ISO-8859-1"))
    return normalize_newlines(text)


def decode_bytes(content: Column) -> Column:
    """Short byte strings without a mark, such as header values: UTF-8 if valid, else Latin-1."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(content, "ISO-8859-1"))


def _utf16(content: Column) -> Column:
    """Decode UTF-16 by its mark, or as Latin-1 when a surrogate has no partner."""
    # An odd trailing byte is no character; decode() would raise on it.
    even = F.substring(content, F.lit(1), (F.octet_length(content) / 2).cast("int") * 2)
    lead = F.when(_starts(content, UTF16_BE_BOM), 1).otherwise(3)
    units = F.regexp_extract_all(F.hex(even), F.lit(".{4}"), F.lit(0))
    # Most texts have no surrogates, which one search over the aligned units tells.
    some = F.when(_starts(content, UTF16_BE_BOM), F.hex(even).rlike("^(?:....)*?D[89A-F]")) \
        .otherwise(F.hex(even).rlike("^(?:....)*?..D[89A-F]"))
    # One letter per unit: a surrogate pair is "hl".
    # The position is bound outside the lambda, which would copy the content for each unit.
    kinds = let(lead, lambda at: F.array_join(F.transform(units, lambda u: F.regexp_replace(
        F.regexp_replace(F.substring(u, at, F.lit(2)), "^D[89AB]", "h"), "^D[C-F]", "l")), " "))
    lone = kinds.rlike("h(?! l)|(?<!h )l")
    return F.when(F.when(some, lone).otherwise(False), F.decode(content, "ISO-8859-1")).otherwise(F.decode(even, "UTF-16"))


def _code_point(number: Column) -> Column:
    """Character of a code point, NULL when the number is not one."""
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


# What XML defines, what HTML 4 does, and what HTML 5 does. Frequent names first: a search runs through the table.
XML_NAMES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
SHORT_NAMES = XML_NAMES | {"nbsp": "\xa0"} | {n: chr(code) for n, code in name2codepoint.items()}
ALL_NAMES = SHORT_NAMES | {n[:-1]: c for n, c in html5.items() if n.endswith(";")}


def _entity(name: Column, names: dict[str, str]) -> Column:
    named = lookup(names, name)
    # Longer digit strings cannot be code points; the guard keeps the casts from overflowing.
    decimal = F.regexp_extract(name, r"^#0*([0-9]{1,7})$", 1)
    hexadecimal = F.regexp_extract(name, r"^#[xX]0*([0-9A-Fa-f]{1,6})$", 1)
    return (
        F.when(~F.startswith(name, F.lit("#")), named)
        .when(decimal != "", _code_point(decimal.cast("long")))
        .when(hexadecimal != "", _code_point(F.conv(hexadecimal, 16, 10).cast("long")))
    )


def unescape_entities(text: Column, names: dict[str, str] = SHORT_NAMES) -> Column:
    """Decode character references once, in one pass over the pieces between ampersands.

    A table of all names makes a large plan, so each place takes the smallest that is right.
    """

    def piece(value: Column, index: Column) -> Column:
        # A reference is a name or a number of any length; the pattern ends at the first other character.
        name = F.regexp_extract(value, r"^(#[xX]?[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);", 1)
        char = F.when(name != "", _entity(name, names))
        decoded = F.concat(char, F.substring(value, F.length(name) + 2, F.length(value)))
        return F.when(index == 0, value).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), value)))

    return let(text, lambda t: F.when(
        F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), piece), "")).otherwise(t))


def collapse_blank(text: Column) -> Column:
    """Squeeze runs of blanks, keep one line end per run of blank lines, trim."""
    text = F.regexp_replace(text, r"[ \t\f\r\xA0]+", " ")
    text = F.regexp_replace(text, " ?\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+\z", "")
