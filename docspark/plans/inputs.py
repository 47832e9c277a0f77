"""Documents derived from the given tables by fixed formulas.

The tables hold text and pages; these builders wrap every row of them as files, messages,
archives and packages, so that each operator runs over whole tables and the expected
result is known from the source row. All of them are narrow.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from docspark.functions.html import escape_markup

# Kind, signature bytes in hex, text in place of the row's text, extension.
# Kinds 3 to 6 are real packages, see office_files.
FILE_KINDS = [
    (0, "255044462D", None, ".pdf"),
    (1, "255044462D", None, ".txt"),
    (2, "504B0304", None, ".zip"),
    (3, "", None, ".bin"),
    (4, "", None, ""),
    (5, "", None, ".zip"),
    (6, "", None, ".epub"),
    (7, "89504E470D0A1A0A", None, ".png"),
    (8, "FFD8FFE0", None, ".jpg"),
    (9, "474946383961", None, ".gif"),
    (10, "1F8B08", None, ".tar.gz"),
    (11, "D0CF11E0A1B11AE1", None, ".bin"),
    (12, "494433", None, ".mp3"),
    (13, "000000186674797069736F6D", None, ".mp4"),
    (14, "", None, ".xml"),
    (15, "", None, ".xml"),
    (16, "", None, ""),
    (17, "", None, ".csv"),
    (18, "", None, ".md"),
    (19, "0001020304FF", None, ""),
]


# Tables of at most this many bytes are dealt out over the cores.
SMALL_TABLE = 256 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one so small that its file has fewer splits than there are cores is dealt out over them."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    small = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= SMALL_TABLE
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if small and rows.rdd.getNumPartitions() < cores else rows


def _zip(members: list[tuple[str, bytes]], stored: bool = False) -> bytes:
    """Archive with fixed timestamps, so equal members give equal bytes."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as archive:
        for name, data in members:
            archive.writestr(zipfile.ZipInfo(name, (2020, 1, 1, 0, 0, 0)), data)
    return buffer.getvalue()


@F.pandas_udf(BinaryType())
def office_files(kinds: pd.Series, texts: pd.Series) -> pd.Series:
    """Real packages around a text, with names and stored members that belong to other formats."""
    types = ("[Content_Types].xml", b'<?xml version="1.0"?><Types></Types>')

    def build(kind: float, text: str) -> bytes | None:
        if pd.isna(kind):
            return None
        body = "".join(c for c in text or "" if c >= " " or c in "\t\n")
        body = body.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").encode("utf-8", "replace")
        word = ("word/document.xml", b"<w:document><w:body><w:p><w:r><w:t>" + body + b"</w:t></w:r></w:p></w:body></w:document>")
        if kind == 3:
            return _zip([types, ("customXml/keyxl/item1.xml", b"<a/>"), word])
        if kind == 4:
            sheet = b'<worksheet><sheetData><row><c t="inlineStr"><is><t>' + body + b"</t></is></c></row></sheetData></worksheet>"
            return _zip([types, ("xl/workbook.xml", b"<workbook/>"), ("xl/worksheets/sheet1.xml", sheet)])
        if kind == 5:
            slide = b"<p:sld><a:p><a:r><a:t>" + body + b"</a:t></a:r></a:p></p:sld>"
            return _zip([types, ("customXml/keyword/item1.xml", b"<a/>"), ("ppt/media/m.bin", b"\x00xl/word/" + body),
                         ("ppt/embeddings/d.docx", _zip([types, word], stored=True)),
                         ("ppt/presentation.xml", b"<p/>"), ("ppt/slides/slide1.xml", slide)], stored=True)
        page = b"<html><body><p>" + body + b"</p></body></html>"
        return _zip([("mimetype", b"application/epub+zip"), ("c.xhtml", page)], stored=True)

    return pd.Series([build(k, t) for k, t in zip(kinds, texts)])


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of one of 20 kinds, by ``doc_id % 20``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = F.col("doc_id") % 20
    prefix, suffix, body = F, F, F
    for k, signature, replacement, extension in FILE_KINDS:
        prefix = prefix.when(kind == k, F.lit(bytes.fromhex(signature)))
        suffix = suffix.when(kind == k, extension)
        if replacement:
            body = body.when(kind == k, replacement)
    # XML cannot hold most control characters, whatever their form.
    clean = escape_markup(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", ""))
    declaration = F.lit('<?xml version="1.0"?><a>')
    body = (
        body.when(kind == 14, F.concat(declaration, clean, F.lit("</a>")))
        .when(kind == 15, F.concat(declaration, clean))
        .when(kind == 16, F.concat(F.lit("<html><body>"), clean, F.lit("</body></html>")))
        .otherwise(F.col("text"))
    )
    office = kind.isin(3, 4, 5, 6)
    content = F.when(office, office_files(F.when(office, kind), F.when(office, F.col("text")))).otherwise(
        F.concat(prefix, F.encode(body, "UTF-8")))
    return docs.select(
        "doc_id", F.concat(F.lit("d/"), F.col("doc_id").cast("string"), suffix).alias("path"),
        content.alias("content"), F.octet_length(content).cast("bigint").alias("length"), "text",
    )


# Declared charsets, and letters of each that stand for a, e and o.
CHARSETS = [("windows-1251", "щжй"), ("ISO-8859-2", "šžč"), ("windows-1252", "€’ß"), ("Shift_JIS", "あ漢カ")]


def foreign(text: Column, number: Column) -> tuple[Column, Column, Column]:
    """(charset, text, bytes) of a text in the charset of that number: its ASCII part with letters of the charset."""
    ascii_part = F.regexp_replace(text, r"[^\x00-\x7F]", "")
    name, plain, content = F, F, F
    for k, (charset, letters) in enumerate(CHARSETS):
        value = F.translate(ascii_part, "aeo", letters)
        name, plain = name.when(number == k, charset), plain.when(number == k, value)
        content = content.when(number == k, F.encode(value, charset))
    return name.otherwise(None), plain.otherwise(None), content.otherwise(None)


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a file: of five, one in UTF-8 as it is, the others in a charset that they declare.

    Those start with the declaration, hold the ASCII part of the page, and end with a paragraph in the charset.
    """
    pages = table(spark, sf_dir, "pages")
    name, said, content = foreign(F.lit("one more"), F.col("page_id") % 5 - 1)
    start = F.concat(F.lit('<!DOCTYPE html><meta charset="'), name, F.lit('">'), F.regexp_replace("html", r"[^\x00-\x7F]", ""), F.lit("<p>"))
    own = F.concat(F.encode(start, "UTF-8"), content, F.encode(F.lit("</p>"), "UTF-8"))
    return pages.select("page_id", F.col("url").alias("path"),
                        F.when(F.col("page_id") % 5 == 0, F.encode("html", "UTF-8")).otherwise(own).alias("content"))


def _wrapped_base64(value: Column) -> Column:
    return F.regexp_replace(F.base64(value), r"\r\n", "\n")


def _quoted_printable(content: Column) -> Column:
    """Escape every byte, with a soft line break after every 20 bytes."""
    escaped = F.regexp_replace(F.hex(content), "(..)", "=$1")
    return F.regexp_replace(escaped, "((?:=..){20})", "$1=\n")


def messages(spark: SparkSession, sf_dir: str, charsets: bool = False) -> DataFrame:
    """Every conversation turn as a message: an alternative text and an attached copy.

    With ``charsets`` the texts and subjects of four in five are in a charset that they declare.

    The text part is quoted-printable when ``conv_id % 3 = 0`` and base64 otherwise. The
    attachment has no file name when ``conv_id % 5 = 0``. One message per turn keeps the
    builder free of a group that a single long conversation could fill.
    """
    turns = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    text = F.coalesce("text", F.lit(""))
    quoted = F.col("conv_id") % 3 == 0
    unnamed = F.col("conv_id") % 5 == 0
    number = F.col("conv_id") % 5 - 1 if charsets else F.lit(-1)
    charset, _, own = foreign(text, number)
    _, _, greeting = foreign(F.lit("one more"), number)
    body = F.coalesce(own, F.encode(text, "UTF-8"))
    word = F.concat(F.lit(" =?"), charset, F.lit("?B?"), F.base64(greeting), F.lit("?="))
    boundary = F.concat(F.lit("=_b"), conv)
    name = F.concat(F.col("role"), F.lit("-"), turn, F.lit(".txt"))
    eml = F.concat(
        F.lit("MIME-Version: 1.0\nSubject: Conversation "), conv, F.lit(" turn "), turn, F.coalesce(word, F.lit("")),
        F.lit("\nFrom: "), F.col("role"), F.lit(" <"), F.col("role"), F.lit("@example.com>\n"),
        F.lit("To: archive@example.com\nCc: copy"), conv, F.lit("@example.com\n"),
        F.lit('Content-Type: multipart/mixed;\n boundary="'), boundary, F.lit('"\n\nno MIME reader\n--'), boundary,
        F.lit("\nContent-Type: text/plain; charset="), F.coalesce(charset, F.lit("UTF-8")), F.lit("\nContent-Transfer-Encoding: "),
        F.when(quoted, "quoted-printable").otherwise("base64"), F.lit("\n\n"),
        F.when(quoted, _quoted_printable(body)).otherwise(_wrapped_base64(body)),
        F.lit("\n--"), boundary,
        F.lit("\nContent-Type: text/csv\nContent-Transfer-Encoding: base64\nContent-Disposition: attachment"),
        F.when(unnamed, "").otherwise(F.concat(F.lit('; filename="'), name, F.lit('"'))),
        F.lit("\n\n"), _wrapped_base64(F.encode(F.concat(F.lit("copy,"), text), "UTF-8")),
        F.lit("\n--"), boundary, F.lit("--\n"),
    )
    msg_id = F.concat_ws("/", conv, turn, F.col("role"))
    return turns.select(msg_id.alias("msg_id"), "conv_id", "turn", "role", eml.alias("eml"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an archive of ``page.html``; nested twice for even and thrice for ``% 4 = 0``."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                members = [("page.html", (html or "").encode())]
                if page_id % 2 == 0:
                    inner = [("embed1/embed1a.txt", f"url {url}".encode())]
                    if page_id % 4 == 0:
                        deep = _zip([("embed2/embed2a.txt", f"page {page_id}".encode())])
                        inner.append(("embed2.zip", deep))
                    members.append(("embed1.zip", _zip(inner)))
                out.append((page_id, _zip(members)))
            yield pd.DataFrame(out, columns=["page_id", "content"])

    return table(spark, sf_dir, "pages").mapInPandas(build, "page_id bigint, content binary")


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a package, by ``doc_id % 4``: text, workbook, slides or book.

    A workbook has a line a row, as shared strings numbered from the last; a book's chapters stand in the archive the
    wrong way round. All have properties.
    """
    docs = table(spark, sf_dir, "documents")
    clean = F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0D\x0E-\x1F\x{FFFE}\x{FFFF}]", "")
    title = F.concat(F.lit("Document "), F.col("doc_id").cast("string"))
    described = F.concat(F.lit("<dc:title>"), title, F.lit("</dc:title><dc:creator>"), F.col("source"), F.lit("</dc:creator><dc:language>"),
                         F.col("lang"), F.lit("</dc:language>"))
    words = F.when(F.col("doc_id") % 10 == 0, F.lit(0)).otherwise(F.col("n_chars"))
    app = F.concat(F.lit("<Properties><Words>"), words.cast("string"), F.lit("</Words></Properties>"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blobs = [_package(i % 4, i, x or "", d, a) for i, x, d, a in zip(batch["doc_id"], batch["body"], batch["described"], batch["app"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "content": blobs})

    return docs.select("doc_id", escape_markup(clean).alias("body"), F.coalesce(described, F.lit("")).alias("described"),
                       F.coalesce(app, F.lit("")).alias("app")).mapInPandas(build, "doc_id bigint, content binary")


def _package(kind: int, number: int, body: str, described: str, app: str) -> bytes:
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    lines = body.split("\n")
    if kind == 3:
        opf = (f'{head}<package xmlns:dc="d" version="3.0"><metadata>{described}</metadata><manifest><item id="a" href="a.xhtml"/>'
               '<item id="z" href="z.xhtml"/></manifest><spine><itemref idref="z"/><itemref idref="a"/></spine></package>')
        members = [("mimetype", "application/epub+zip"), ("META-INF/container.xml", '<container><rootfile full-path="b/c.opf"/></container>'),
                   ("b/c.opf", opf), ("b/a.xhtml", f"<html><body><p>End of {number}</p></body></html>"),
                   ("b/z.xhtml", f"<html><body><p>{body}</p></body></html>")]
        return _zip([(n, t.encode()) for n, t in members], stored=True)
    core = f'<cp:coreProperties xmlns:cp="c" xmlns:dc="d" xmlns:dcterms="t">{described}<dcterms:created>2020-01-01T00:00:00Z</dcterms:created></cp:coreProperties>'
    if kind == 0:
        paragraphs = "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in lines)
        own = [("word/document.xml", f'{head}<w:document xmlns:w="w"><w:body>{paragraphs}</w:body></w:document>')]
    elif kind == 1:
        rows = "".join(f'<row r="{i + 1}"><c r="A{i + 1}" t="s"><v>{len(lines) - 1 - i}</v></c></row>' for i in range(len(lines)))
        strings = "".join(f"<si><t>{x}</t></si>" for x in reversed(lines))
        own = [("xl/workbook.xml", f'{head}<workbook><sheets><sheet name="Lines" sheetId="1" r:id="r1"/></sheets></workbook>'),
               ("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet7.xml"/></Relationships>'),
               ("xl/sharedStrings.xml", f"{head}<sst>{strings}</sst>"),
               ("xl/worksheets/sheet7.xml", f"{head}<worksheet><sheetData>{rows}</sheetData></worksheet>")]
    else:
        slide = "".join(f"<a:p><a:r><a:t>{x}</a:t></a:r></a:p>" for x in lines)
        own = [("ppt/presentation.xml", "<p/>"), ("ppt/slides/slide2.xml", f"<p:sld><a:p><a:r><a:t>End of {number}</a:t></a:r></a:p></p:sld>"),
               ("ppt/slides/slide1.xml", f"<p:sld>{slide}</p:sld>")]
    members = [("[Content_Types].xml", '<?xml version="1.0"?><Types></Types>'), *own, ("docProps/core.xml", core), ("docProps/app.xml", app)]
    return _zip([(n, t.encode("utf-8", "replace")) for n, t in members])


def raw_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a raw metadata map that meets each rule of normalisation."""
    docs = table(spark, sf_dir, "documents")
    case = F.col("doc_id") % 6

    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    entries = F.array(
        entry("dc:title", F.when(case == 0, "").otherwise(F.concat(F.lit("Title "), F.col("doc_id").cast("string")))),
        entry("Title", F.lit("fallback title")),
        entry("meta:word-count", F.when(case == 1, "0").when(case == 2, "12.5").when(case == 3, "1_000")
              .when(case == 4, "many").otherwise(F.col("n_chars").cast("string"))),
        entry("xmpDM:duration", F.when(case == 1, "0.0").when(case == 2, "n/a").otherwise(
            F.concat(F.col("n_chars").cast("string"), F.lit(".5")))),
        entry("meta:keyword", F.concat(F.lit(" "), F.col("lang"), F.lit(" , "), F.col("source"), F.lit(",x"))),
        entry("pdf:encrypted", F.when(case == 3, "true").otherwise("false")),
        entry("X-Unknown", F.lit("ignored")),
        entry("meta:last-author", F.col("source")),
        entry("fs:created", F.lit("2020-01-01T00:00:00Z")),
        entry("Message:From-Email", F.concat(F.col("source"), F.lit("@example.com"))),
    )
    return docs.select("doc_id", F.map_from_entries(entries).alias("raw_metadata"))
