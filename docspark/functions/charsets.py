"""Declared charsets: names to decoders.

A charset of one byte a character is Latin-1 with another upper half, so its text is a ``translate`` of the
Latin-1 text. Charsets of several bytes are decoded by name, which Spark does while ``JAVA_CHARSETS`` is set
(``docspark.configure`` sets it); without it such texts fall to detection. All of it is column expressions, also inside lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docspark.functions.text import let, lookup

JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"

# Charset names and the codecs that know them.
ONE_BYTE = {f"windows-{n}": f"cp{n}" for n in (874, *range(1250, 1259))}
ONE_BYTE |= {f"iso-8859-{n}": f"iso8859_{n}" for n in (*range(2, 12), 13, 14, 15, 16)}
ONE_BYTE |= {"koi8-r": "koi8_r", "koi8-u": "koi8_u", "ibm866": "cp866", "ibm850": "cp850", "ibm437": "cp437", "macintosh": "mac_roman",
             "x-mac-cyrillic": "mac_cyrillic"}
SEVERAL_BYTES = {
    "shift_jis": "windows-31j", "euc-jp": "EUC-JP", "iso-2022-jp": "ISO-2022-JP", "gb18030": "GB18030", "big5": "Big5-HKSCS",
    "euc-kr": "x-windows-949", "utf-16": "UTF-16", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE", "utf-32": "UTF-32",
}
OTHER_NAMES = {
    "cp866": "ibm866", "866": "ibm866", "cp850": "ibm850", "cp437": "ibm437", "koi8": "koi8-r", "koi8-ru": "koi8-u", "mac": "macintosh",
    "x-mac-roman": "macintosh", "latin2": "iso-8859-2", "latin5": "iso-8859-9", "latin9": "iso-8859-15", "l2": "iso-8859-2",
    "cyrillic": "iso-8859-5", "greek": "iso-8859-7", "hebrew": "iso-8859-8", "iso-8859-8-i": "iso-8859-8", "arabic": "iso-8859-6",
    "tis-620": "windows-874", "sjis": "shift_jis", "shift-jis": "shift_jis", "x-sjis": "shift_jis", "windows-31j": "shift_jis",
    "ms_kanji": "shift_jis", "ms932": "shift_jis", "x-euc-jp": "euc-jp", "gb2312": "gb18030", "gbk": "gb18030", "x-gbk": "gb18030",
    "cp936": "gb18030", "big5-hkscs": "big5", "x-x-big5": "big5", "cp950": "big5", "ks_c_5601-1987": "euc-kr", "korean": "euc-kr",
    "windows-949": "euc-kr", "cp949": "euc-kr", "utf16": "utf-16", "unicode": "utf-16le",
}

#: The characters of the upper half of Latin-1, and for each charset what stands there instead.
HIGH = "".join(map(chr, range(128, 256)))
TABLES = {name: bytes(range(128, 256)).decode(codec, "replace") for name, codec in ONE_BYTE.items()}


def _names() -> dict[str, str]:
    """Every spelling of a name: with ``cp`` or ``x-cp`` for ``windows-``, with or without the marks of ISO names."""
    names = {n: n for n in (*ONE_BYTE, *SEVERAL_BYTES)} | OTHER_NAMES
    for name in ONE_BYTE:
        if name.startswith("windows-"):
            names |= {name.replace("windows-", p): name for p in ("cp", "x-cp", "cp-", "win-", "ms-")}
        if name.startswith("iso-"):
            names |= {name.replace("iso-", p): name for p in ("iso", "iso_")} | {name.replace("iso-8859-", "iso8859"): name}
    return names


def charset_name(declared: Column) -> Column:
    """The name under which a declared charset is decoded; NULL for none, unknown ones, UTF-8 and Latin-1."""
    return lookup(_names(), F.lower(F.regexp_replace(declared, r"""[\s"';]+""", "")))


def one_byte_text(content: Column, name: Column) -> Column:
    """Text of a charset of one byte a character by its :func:`charset_name`; NULL for any other."""
    return let(lookup(TABLES, name), lambda table: F.when(
        table.isNotNull(), F.call_function("translate", F.decode(content, "ISO-8859-1"), F.lit(HIGH), table)))


def several_bytes_text(content: Column, name: Column) -> Column:
    """Text of a charset of several bytes a character by its :func:`charset_name`; NULL for any other."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.conf.get(JAVA_CHARSETS, "false") != "true":
        return F.lit(None).cast("string")
    return let(lookup(SEVERAL_BYTES, name), lambda codec: F.when(codec.isNotNull(), F.call_function("decode", content, codec)))


def declared_text(content: Column, name: Column) -> Column:
    """Text by the :func:`charset_name` of a declared charset; NULL where that is unknown."""
    return F.coalesce(one_byte_text(content, name), several_bytes_text(content, name))


def markup_charset(content: Column) -> Column:
    """What a page or XML document declares at its start: by XML declaration or by ``meta``."""
    def declared(head: Column) -> Column:
        names = [F.nullif(F.regexp_extract(head, pattern, 1), F.lit("")) for pattern in (
            r"""^\s*<\?xml[^>]{0,200}?encoding\s*=\s*["']([A-Za-z0-9_:.-]{1,40})""",
            r"""(?i)<meta\s[^>]{0,400}?charset\s*=\s*["']?\s*([a-z0-9_:.-]{1,40})""")]
        return F.coalesce(*names)

    return let(F.decode(F.substring(content, 1, 4096), "ISO-8859-1"), declared)

