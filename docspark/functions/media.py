"""Media types: signatures, extensions, text sniffing, containers and specialisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions.text import let, lookup

MagicRule = tuple[str, str, int]


def parse_signature(signature: str) -> list[tuple[int, bytes]]:
    """``"0:52494646 8:57454250"`` to ``[(0, b"RIFF"), (8, b"WEBP")]``."""
    return [(int(off), bytes.fromhex(hexed)) for off, hexed in (s.split(":") for s in signature.split())]


def magic_type(content: Column, rules: Sequence[MagicRule] = V.MAGIC) -> Column:
    """Media type by signature as one CASE in order of priority; NULL when none matches."""
    case = F
    for signature, media_type, _ in sorted(rules, key=lambda r: -r[2]):
        tests = [
            F.substring(content, offset + 1, len(magic)) == F.lit(magic)
            for offset, magic in parse_signature(signature)
        ]
        case = case.when(reduce(lambda a, b: a & b, tests), media_type)
    return case.otherwise(None) if case is not F else F.lit(None).cast("string")


def file_name(path: Column) -> Column:
    """Last path segment without URL query and fragment."""
    return F.regexp_extract(path, r"([^/\\?#]*)(?:[?#].*)?$", 1)


def extensions(name: Column) -> list[Column]:
    """Candidate suffixes of a name, longest first: ``tar.gz`` before ``gz``."""
    name = F.lower(file_name(name))
    return [
        F.nullif(F.regexp_extract(name, r"\.([^.\s]+\.[^.\s]+)$", 1), F.lit("")),
        F.nullif(F.regexp_extract(name, r"\.([^.\s]+)$", 1), F.lit("")),
    ]


def glob_type(name: Column, globs: Sequence[tuple[str, Sequence[str]]] = V.GLOBS) -> Column:
    """Media type by extension; NULL name has no opinion."""

    table = {suffix.lower(): media_type for media_type, suffixes in globs for suffix in suffixes}
    dotted = {s: t for s, t in table.items() if "." in s}
    double, single = extensions(name)
    found = lookup({s: t for s, t in table.items() if "." not in s}, single)
    return F.coalesce(lookup(dotted, double), found) if dotted else found


def sniff_type(content: Column) -> Column:
    """Type of content without a signature: markup roots, mail headers, text, or bytes."""
    # Latin-1 maps every byte to one character, so the patterns see any content without failing.
    return F.when(content.isNull(), None).otherwise(let(
        F.decode(content, "ISO-8859-1"), lambda text: _sniff(content, text)
    ))


def _sniff(content: Column, text: Column) -> Column:
    valid = F.is_valid_utf8(content.cast("string")) & ~text.rlike(r"\x00")
    no_control = ~text.rlike(r"[\x00-\x08\x0E-\x1A\x1C-\x1F]")
    mark = r"^(?:\xEF\xBB\xBF)?\s*"
    comment = r"<!--.*?-->\s*"
    misc = rf"(?:<\?xml[^>]*>\s*|{comment}|<!DOCTYPE[^>]*>\s*)*+"
    return (
        F.when(F.octet_length(content) == 0, V.OCTET_STREAM)
        .when(text.rlike(rf"(?is){mark}{misc}<html\s[^>]*xmlns\s*=\s*[\x22']http://www\.w3\.org/1999/xhtml"), V.XHTML)
        .when(text.rlike(rf"(?is){mark}(?:{comment})*+(?:<!DOCTYPE\s+html|<html[\s>]|<head[\s>]|<body[\s>])"),
              V.TEXT_HTML)
        .when(text.rlike(rf"{mark}<\?xml"), V.XML)
        .when(text.rlike(r"(?i)^\s*(?:MIME-Version|From|Message-ID|Received|Return-Path|Delivered-To): *[^\s]"
                         r"[^\n]*\n(?:[A-Za-z][A-Za-z0-9-]*:|[ \t]|\r?\n)"), V.MESSAGE)
        .when(valid | no_control, V.TEXT_PLAIN)
        .otherwise(V.OCTET_STREAM)
    )


def _little_endian(field: Column) -> Column:
    """Number in up to four bytes that are held as Latin-1 characters."""
    return F.conv(F.hex(F.encode(F.reverse(field), "ISO-8859-1")), 16, 10).cast("bigint")


def zip_directory(content: Column) -> Column:
    """Central directory of an archive as Latin-1 text; NULL without an end record.

    The end record stands in the last 64 KiB and says how long the directory before it is, so
    member contents, which may hold archives of their own, are never searched.
    """
    mark, size = "PK\x05\x06", F.octet_length(content)
    tail = F.decode(F.substring(content, F.greatest(size - 65556, F.lit(1)), F.lit(65557)), "ISO-8859-1")

    def directory(record: Column) -> Column:
        # What follows the last mark: 8 bytes of counts, the directory's length, its offset, a comment.
        end = size - F.length(record) - len(mark)
        return let(_little_endian(F.substring(record, 9, 4)), lambda length: F.when(
            (F.length(record) >= 18) & (length <= end),
            F.decode(F.substring(content, (end - length + 1).cast("int"), length.cast("int")), "ISO-8859-1")))

    return let(tail, lambda t: F.when(F.contains(t, F.lit(mark)), let(F.substring_index(t, mark, -1), directory)))


def _lists(directory: Column, name: str, whole: bool = True) -> Column:
    """Whether the directory has a member of this name, or of a name that starts like this.

    An entry's name stands 46 bytes behind its signature, its length 28 bytes behind it.
    """
    length = rf"\x{len(name):02x}\x00" if whole else ".."
    return directory.rlike(rf"(?s)PK\x01\x02.{{24}}{length}.{{16}}\Q{name}\E")


def container_type(content: Column) -> Column:
    """ZIP-based document format by the outer directory of the archive; NULL for other content."""
    # The format's own rule: an uncompressed member of this name and content comes first.
    head = F.decode(F.substring(content, 1, 256), "ISO-8859-1")
    epub = head.rlike(r"(?s)^PK\x03\x04.{26}mimetype.{0,160}?application/epub\+zip")

    def office(directory: Column) -> Column:
        case = F
        for main, _, media_type in V.PACKAGE_NAMES:
            case = case.when(_lists(directory, main), media_type)
        for _, folder, media_type in V.PACKAGE_NAMES:
            case = case.when(_lists(directory, folder, whole=False), media_type)
        return F.when(_lists(directory, V.OOXML_NAME), case.otherwise(V.OOXML))

    def has(name: str) -> Column:
        return F.contains(content, F.lit(name.encode()))

    # A cut archive has no directory; its bytes say what it was meant to be, and parsing gives an error.
    cut = F
    for _, folder, media_type in V.PACKAGE_NAMES:
        cut = cut.when(has(folder), media_type)
    cut = F.when(has(V.OOXML_NAME), cut.otherwise(V.OOXML))
    return (F.when(F.substring(content, 1, 4) != F.lit(bytes.fromhex("504B0304")), None)
            .when(epub, V.EPUB)
            .otherwise(let(zip_directory(content), lambda d: F.when(d.isNull(), cut).otherwise(office(d)))))


def supertype(media_type: Column, supertypes: Mapping[str, str] | None = None) -> Column:
    """Next broader type; ``supertypes`` adds types of the user to the known ones."""
    listed = lookup(dict(V.SUPERTYPES) | dict(supertypes or {}), media_type)
    return (
        F.when(media_type == V.OCTET_STREAM, None)
        .when(listed.isNotNull(), listed)
        .when(F.endswith(media_type, F.lit("+xml")), V.XML)
        .when(F.startswith(media_type, F.lit("text/")), V.TEXT_PLAIN)
        .otherwise(V.OCTET_STREAM)
    )


def _parent(name: str, parents: Mapping[str, str]) -> str | None:
    """The rules of :func:`supertype` for one name."""
    if name == V.OCTET_STREAM or name in parents:
        return parents.get(name)
    return V.XML if name.endswith("+xml") else V.TEXT_PLAIN if name.startswith("text/") else V.OCTET_STREAM


def ancestors(supertypes: Mapping[str, str] | None = None) -> dict[str, str]:
    """Transitive closure of the listed hierarchy: for each type its ancestors, each between spaces."""
    parents = dict(V.SUPERTYPES) | dict(supertypes or {})
    closed = {}
    for child in parents:
        found, above = [], _parent(child, parents)
        while above and above != V.OCTET_STREAM:
            if above == child or above in found:
                raise ValueError(f"{V.INVALID_MEDIA_TYPE}: {child} is among its own supertypes")
            found.append(above)
            above = _parent(above, parents)
        if found:
            closed[child] = f" {' '.join(found)} "
    return closed


def specializes(media_type: Column, current: Column, supertypes: Mapping[str, str] | None = None) -> Column:
    """Whether ``media_type`` is a proper descendant of ``current``."""
    above = lookup(ancestors(supertypes), media_type)
    listed = F.coalesce(F.contains(above, F.concat(F.lit(" "), current, F.lit(" "))), F.lit(False))
    # Types outside the list follow their name.
    any_xml = above.isNull() & F.endswith(media_type, F.lit("+xml")) & current.isin(V.XML, V.TEXT_PLAIN)
    any_text = above.isNull() & F.startswith(media_type, F.lit("text/")) & (current == V.TEXT_PLAIN)
    return (media_type != current) & ((current == V.OCTET_STREAM) | listed | any_xml | any_text)


def fold_types(*candidates: Column, supertypes: Mapping[str, str] | None = None) -> Column:
    """Fold candidates from the left: a later one wins only if it specialises the current one."""

    def step(current: Column, candidate: Column) -> Column:
        return F.when(specializes(candidate, current, supertypes), candidate).otherwise(current)

    # Each step reads its accumulator several times. aggregate() evaluates the step once
    # per candidate, where nested CASEs would double the expression at every level.
    known = F.filter(F.array(*candidates), lambda c: c.isNotNull())
    return F.aggregate(known, F.lit(V.OCTET_STREAM), step)
