import io
import xml.etree.ElementTree as ET
import zipfile
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docspark.operators import parsing as P
from docspark.plans.documents import parse_documents

MAIL = b"""MIME-Version: 1.0
Date: Mon, 3 Jan 2022 10:00:00 +0000
Subject: =?UTF-8?B?R3LDvMOfZQ==?= =?ISO-8859-1?Q?_aus_K=F6ln?=
From: One <one@example.com>
To: Two <two@example.com>,
 Three <three@example.com>
Received: first
Received: second
Content-Type: multipart/mixed; boundary="out"

preamble
--out
Content-Type: multipart/alternative; boundary=in

--in
Content-Type: text/plain; charset="UTF-8"
Content-Transfer-Encoding: quoted-printable

gr=C3=BCn soft=
 end
--in
Content-Type: text/html

<p>gr&uuml;n</p>
--in--
--out
Content-Type: application/x-thing; name="a.bin"
Content-Transfer-Encoding: base64
Content-ID: <id@x>

AAEC
/w==
--out--
epilogue
"""


def one(df, *columns):
    return df.select(*columns).first()


def text_frame(spark, values, kind="binary", name="content"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def test_text_charsets(spark):
    values = ["Grüße\r\nx\ry".encode(), "\ufeffé".encode(), "\ufeffaé😀".encode("utf-16-le"),
              "\ufeffaé😀".encode("utf-16-be"), "é".encode("latin-1"), b"\xff\xfe\x00\xd8a\x00", b"\xff\xfea\x00b",
              b"", None]
    rows = [(r["encoding"], r["text"]) for r in P.parse_text(text_frame(spark, values)).orderBy("i").collect()]
    assert rows[:5] == [("UTF-8", "Grüße\nx\ny"), ("UTF-8", "é"), ("UTF-16LE", "aé😀"), ("UTF-16BE", "aé😀"),
                        ("ISO-8859-1", "é")]
    assert rows[5][1] == b"\xff\xfe\x00\xd8a\x00".decode("latin-1")
    assert rows[6:] == [("UTF-16LE", "a"), ("UTF-8", ""), (None, None)]


HTML = [
    ("<p>a</p><p>b&amp;lt;c&lt;d &#233;&#xE9;&#x1F600; &nosuch; &#0; a&b</p>", "a\nb&lt;c<d éé😀 &nosuch; &#0; a&b"),
    ("x<script>var t='</p>';</script>y<style>p{}</style><!-- c -->z", "xyz"),
    ("<html><head><title>T</title></head><body>text<script>cut off", "text"),
    ("a<br>b<br/>c  <b>d</b>\n\n\ne", "a\nb\nc d\ne"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("", ""),
    (None, None),
]


def test_html_text(spark):
    df = text_frame(spark, [h for h, _ in HTML], "string", "html")
    assert [r["text"] for r in P.parse_html_text(df).orderBy("i").collect()] == [t for _, t in HTML]


XML = [
    ("<a><b>x</b> y</a>", False), ("<a><b>x<b></a>", True), ("<a>x</a>junk", True), ("<a>x & y</a>", True),
    ("<a>x", True), ("", True), ("text", True), ("<?xml version='1.0'?><root></root>", False), ("<a/><b/>", True),
    ("<a></a><a></a>", True), ("<a x='1>2'>q</a> <!-- c -->\n", False), ("<a/>", False), ("<a b=1/>", True),
    ("<!DOCTYPE x [<!ENTITY e 'y'>]><a>&lt;</a>", False), ("<a><![CDATA[<x> & ]]></a>", False),
    ("<?xml version='1.0'?>\n<l>\n <i>a</i>\n <i>b<i>\n</l>", True), ("<a>" + " " * 50000 + "</a>", False),
]


def test_xml(spark):
    rows = P.parse_xml(text_frame(spark, [x for x, _ in XML], "string", "xml")).orderBy("i").collect()
    assert [(x, r["error"] is not None) for (x, _), r in zip(XML, rows)] == XML
    assert rows[0]["text"] == "x\ny"
    assert rows[14]["text"] == "<x> &"


def test_message(spark):
    row = P.parse_message(text_frame(spark, [MAIL], name="eml")).first()
    assert row["headers"]["Subject"] == "Grüße aus Köln"
    assert row["headers"]["To"] == "Two <two@example.com>, Three <three@example.com>"
    assert row["headers"]["Received"] == "first"
    assert [p["media_type"] for p in row["parts"]] == ["text/plain", "text/html", "application/x-thing"]
    assert row["parts"][2]["name"] == "a.bin" and row["parts"][2]["relationship_id"] == "id@x"
    assert bytes(row["parts"][2]["content"]) == b"\x00\x01\x02\xff"
    assert row["text"] == "grün soft end"


def test_message_without_parts_and_with_html_only(spark):
    plain = b"Subject: x\nFrom: a@example.com\n\nbody\n\nmore\n"
    html = b"From: a@example.com\r\nContent-Type: text/html\r\n\r\n<p>one</p><p>two</p>"
    rows = P.parse_message(text_frame(spark, [plain, html], name="eml")).orderBy("i").collect()
    assert [r["text"] for r in rows] == ["body\n\nmore", "one\ntwo"]


def package(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in members:
            z.writestr(name, text)
    return buffer.getvalue()


def test_packages(spark):
    types = ("[Content_Types].xml", "<Types/>")
    pptx = package([types, *[(f"ppt/slides/slide{i}.xml", f"<p:sld><a:p><a:t>s{i}</a:t></a:p></p:sld>")
                             for i in (10, 2, 1)]])
    xlsx = package([types, ("xl/sharedStrings.xml", "<sst><si><t>shared</t></si></sst>"),
                    ("xl/worksheets/sheet1.xml", '<row><c r="A1" t="s"><v>0</v></c><c r="B1"><v>4.5</v></c></row>')])
    docx = package([types, ("word/document.xml", "<w:p><w:r><w:t>a</w:t></w:r><w:r><w:t>b</w:t></w:r></w:p><w:p>c</w:p>"),
                    ("word/styles.xml", "<w:x>no</w:x>"), ("docProps/core.xml", "<dc:title>T &amp; U</dc:title>"),
                    ("docProps/app.xml", "<Words>7</Words><Pages>0</Pages>")])
    epub = package([("mimetype", "application/epub+zip"), ("c1.xhtml", "<html><body><p>one</p></body></html>"),
                    ("c2.xhtml", "<html><body><p>two</p></body></html>")])
    broken = b"PK\x03\x04[Content_Types].xml word/"
    rows = parse_documents(text_frame(spark, [pptx, xlsx, docx, epub, broken]), name=None, output_format="txt") \
        .orderBy("i").collect()
    assert [r["content"] for r in rows] == ["s1\ns2\ns10", "shared\n4.5", "ab\nc", "one\ntwo", None]
    assert rows[2]["metadata"]["title"] == "T & U"
    assert (rows[2]["metadata"]["word_count"], rows[2]["metadata"]["page_count"]) == (7, None)
    assert rows[4]["error"]["error_class"] == "PARSE_ERROR"


def test_rendering(spark):
    df = spark.createDataFrame([("a <b> & \"c\"\x01\nd", "T&", {"k<": "v", "a": None})],
                               "text string, title string, raw map<string,string>")
    xhtml = one(P.render_content(df, "xhtml", title="title", raw="raw"), "content")[0]
    root = ET.fromstring(xhtml.encode())
    ns = "{http://www.w3.org/1999/xhtml}"
    assert [p.text for p in root.iter(f"{ns}p")] == ['a <b> & "c"', "d"]
    assert root.find(f".//{ns}title").text == "T&"
    assert [m.attrib for m in root.iter(f"{ns}meta")] == [{"name": "k<", "content": "v"}]


@pytest.mark.parametrize("output_format", ["invalid", "pdf", "doc"])
def test_invalid_format_is_text_in_string_mode_and_an_error_elsewhere(spark, output_format):
    df = spark.createDataFrame([("a < b",)], "text string")
    assert one(P.render_content(df, output_format), "content")[0] == "a < b"
    for mode in ("file", "stream"):
        with pytest.raises(ValueError, match="INVALID_OUTPUT_FORMAT"):
            P.render_content(df, output_format, mode)
    with pytest.raises(ValueError, match="INVALID_ARGUMENT"):
        P.render_content(df, "txt", "other")


def test_custom_parsers_as_column_and_pandas_udf(spark):
    def shout(content):
        return F.upper(content.cast("string"))

    @F.pandas_udf("string")
    def reverse(content: pd.Series) -> pd.Series:
        return content.map(lambda b: None if b is None else bytes(b).decode()[::-1])

    df = spark.createDataFrame([("a.md", b"abc"), ("a.csv", b"x,y"), ("a.txt", b"t")], "path string, content binary")
    rows = parse_documents(df, output_format="txt", custom_parsers={"text/x-web-markdown": shout, "text/csv": reverse}) \
        .orderBy("path").collect()
    assert [r["content"] for r in rows] == ["y,x", "ABC", "t"]
    assert [r["raw_metadata"]["X-TIKA:Parsed-By"] for r in rows] == ["reverse", "shout", "DefaultParser"]


def test_parse_documents_of_all_kinds(spark):
    df = spark.createDataFrame([
        ("1.txt", b"Hello"), ("2.html", b"<html lang='de'><title>T</title><meta name='author' content='A'><p>x</p>"),
        ("3.xml", b"<?xml version='1.0'?><a><b>x<b></a>"), ("4.eml", MAIL), ("5.png", b"\x89PNG\r\n\x1a\n"), ("6", None),
        ("", b"x"),
    ], "path string, content binary")
    rows = {r["path"]: r for r in parse_documents(df).collect()}
    assert rows["1.txt"]["metadata"]["content_type"] == "text/plain"
    assert rows["2.html"]["metadata"]["title"] == "T" and rows["2.html"]["metadata"]["language"] == "de"
    assert rows["2.html"]["raw_metadata"]["author"] == "A"
    assert rows["3.xml"]["error"]["error_class"] == "PARSE_ERROR" and rows["3.xml"]["content"] is None
    mail = rows["4.eml"]["metadata"]
    assert (mail["from_"], mail["title"], mail["multipart_boundary"]) == ("One <one@example.com>", "Grüße aus Köln", "out")
    assert rows["5.png"]["error"] is None and rows["5.png"]["text"] == ""
    assert rows["6"]["error"]["error_class"] == "INVALID_INPUT"
    assert rows[""]["error"]["error_class"] == "INPUT_NOT_FOUND"
    for path in ("1.txt", "2.html", "4.eml", "5.png"):
        ET.fromstring(rows[path]["content"].encode())


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([("3.xml", b"<?xml version='1.0'?><a><b>x<b></a>")], "path string, content binary")
    with pytest.raises(Exception, match="PARSE_ERROR"):
        parse_documents(df, strict=True).collect()


def test_dispatch_is_one_narrow_stage(spark):
    df = spark.createDataFrame([("a", b"x")], "path string, content binary")
    plan = parse_documents(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_markdown_file_parses(spark):
    readme = Path(__file__).resolve().parent.parent / "README.md"
    df = spark.createDataFrame([("README.md", readme.read_bytes())], "path string, content binary")
    row = parse_documents(df, output_format="txt").first()
    assert row["media_type"] == "text/x-web-markdown" and row["content"] == readme.read_text()


def test_multiparts_open_to_any_depth(spark):
    mail = b"Content-Type: text/plain\n\ndeep text"
    for i in range(8):
        mail = b'Content-Type: multipart/mixed; boundary="b%d"\n\n--b%d\n' % (i, i) + mail + b"\n--b%d--\n" % i
    row = P.parse_message(spark.createDataFrame([(b"Subject: x\n" + mail,)], "eml binary")).first()
    assert row["text"] == "deep text" and len(row["parts"]) == 1


def test_types_without_a_parser_say_so(spark):
    df = spark.createDataFrame([("a.pdf", b"%PDF-1.4"), ("a.txt", b"x")], "path string, content binary")
    by = {r["path"]: r["raw_metadata"]["X-TIKA:Parsed-By"] for r in parse_documents(df).collect()}
    assert by == {"a.pdf": "EmptyParser", "a.txt": "DefaultParser"}


RUSSIAN, JAPANESE, CZECH = "Привет, мир", "日本語テキスト", "žluťoučký kůň"
CHARSETS = [
    (RUSSIAN, "windows-1251", "cp1251"), (RUSSIAN, "KOI8-R", "koi8_r"), (RUSSIAN, "iso-8859-5", "iso8859_5"), (RUSSIAN, "cp866", "cp866"),
    ("it’s 5€", "windows-1252", "cp1252"), (CZECH, "ISO-8859-2", "iso8859_2"), (CZECH, "latin2", "iso8859_2"), (CZECH, "cp1250", "cp1250"),
    (JAPANESE, "Shift_JIS", "shift_jis"), (JAPANESE, "euc-jp", "euc_jp"), (JAPANESE, "iso-2022-jp", "iso2022_jp"),
    ("中文文本", "GBK", "gbk"), ("中文", "big5", "big5"), ("한국어", "EUC-KR", "euc_kr"), ("plain é", "utf-8", "utf-8"), ("é", "nonsense", "latin-1"),
]


def test_declared_charsets_of_texts(spark):
    df = spark.createDataFrame([(i, t.encode(c), n) for i, (t, n, c) in enumerate(CHARSETS)], "i int, content binary, charset string")
    rows = P.parse_text(df, charset="charset").orderBy("i").collect()
    assert [r["text"] for r in rows] == [t for t, _, _ in CHARSETS]
    assert [r["encoding"] for r in rows][:6] == ["WINDOWS-1251", "KOI8-R", "ISO-8859-5", "IBM866", "WINDOWS-1252", "ISO-8859-2"]
    # A mark beats what is declared, and bytes that the charset does not have become a mark.
    marked = spark.createDataFrame([(b"\xef\xbb\xbf\xc3\xa9", "cp1251"), (b"a\xffb", "Shift_JIS")], "content binary, charset string")
    assert [r["text"][:1] for r in P.parse_text(marked, charset="charset").collect()] == ["é", "a"]


def test_declared_charsets_of_pages(spark):
    pages = [(i, f'<html><head><meta http-equiv="Content-Type" content="text/html; charset={n}"><title>{t}</title></head><p>{t}</p>'.encode(c), t)
             for i, (t, n, c) in enumerate(CHARSETS)]
    pages += [(100 + i, f"<?xml version='1.0' encoding='{n}'?><html xmlns='http://www.w3.org/1999/xhtml'><title>{t}</title><p>{t}</p></html>".encode(c), t)
              for i, (t, n, c) in enumerate(CHARSETS) if n != "nonsense"]
    df = spark.createDataFrame([(i, p) for i, p, _ in pages], "i int, content binary")
    rows = parse_documents(df, name=None, output_format="txt").orderBy("i").collect()
    assert [(r["content"], r["metadata"]["title"]) for r in rows] == [(t, t) for _, _, t in pages]
    texts = P.parse_html_text(df, "content").orderBy("i").collect()
    assert [r["text"] for r in texts] == [t for _, _, t in pages]


def test_declared_charsets_of_messages(spark):
    import base64

    mails = []
    for i, (text, name, codec) in enumerate(CHARSETS[:14]):
        word = f"=?{name}?B?{base64.b64encode(text.encode(codec)).decode()}?="
        head = f"From: a@example.com\nSubject: {word}\nContent-Type: text/{'html' if i % 2 else 'plain'}; charset=\"{name}\"\n"
        body = (f"<p>{text}</p>" if i % 2 else text).encode(codec)
        mails.append(head.encode() + (b"Content-Transfer-Encoding: base64\n\n" + base64.b64encode(body) if i % 3 else b"\n" + body))
    df = spark.createDataFrame(list(enumerate(mails)), "i int, content binary")
    rows = P.parse_message(df, "content").orderBy("i").collect()
    assert [(r["headers"]["Subject"], r["text"]) for r in rows] == [(t, t) for t, _, _ in CHARSETS[:14]]
    parsed = parse_documents(df, name=None, output_format="txt").orderBy("i").collect()
    assert [(r["metadata"]["title"], r["content"]) for r in parsed] == [(t, t) for t, _, _ in CHARSETS[:14]]


MARKUP = [
    ("<img alt='a > b'>x", "x"), ('<p title="<!-- no comment -->">a</p>b', "a\nb"), ("<a href=x?a=1&b='2'>t</a>", "t"),
    ("<p class=it's>kept</p>", "kept"), ('<p title="open>text</p>more', "text\nmore"), ("a<!-- <p>x</p> -->b", "ab"),
    ("<script>if (a<b) { '</p>' }</script>y", "y"), ("<a x=" + "=" * 5000 + ">z</a>", "z"), ("&#0000000065;&CounterClockwiseContourIntegral;&AMP;", "A∳&"),
    ("<div data-x='</div><script>'>in</div>out", "in\nout"), ("&ampere; &am", "&ampere; &am"),
]


def test_quoted_values_and_long_references(spark):
    rows = P.parse_html_text(text_frame(spark, [m for m, _ in MARKUP], "string", "html")).orderBy("i").collect()
    assert [r["text"] for r in rows] == [t for _, t in MARKUP]


def test_xml_text_of_sections_and_quoted_values(spark):
    cases = [("<a><![CDATA[keep <!-- this --> too]]></a>", "keep <!-- this --> too"), ("<a x='1>2'>q</a>", "q"),
             ("<!DOCTYPE x [<!ENTITY e 'y'>]><a>t</a>", "t"), ("<a><!-- <![CDATA[no]]> -->s</a>", "s"), ("<é>ü</é>", "ü")]
    rows = P.parse_xml(text_frame(spark, [x for x, _ in cases], "string", "xml")).orderBy("i").collect()
    assert [r["text"] for r in rows] == [t for _, t in cases]


def test_cells_come_row_by_row_with_sheet_names(spark):
    strings = "<sst><si><t>south</t></si><si><r><t>nor</t></r><r><t>th &amp; x</t></r><rPh><t>yomi</t></rPh></si><si/></sst>"
    book = ('<workbook xmlns:r="r"><sheets><sheet name="Second &lt;1&gt;" sheetId="2" r:id="rId2"/>'
            '<sheet name="First" sheetId="1" r:id="rId1"/></sheets></workbook>')
    relations = ('<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                 '<Relationship Target="/xl/worksheets/sheet2.xml" Id="rId2"/></Relationships>')
    rows = "".join(f'<row r="{i}"><c r="A{i}" t="s"><v>{s}</v></c><c r="B{i}" s="1"><v>{n}</v></c></row>' for i, (s, n) in enumerate(
        [(0, 4), (1, 5), (0, 6)], 1))
    other = ('<row><c t="inlineStr"><is><t>in line</t></is></c><c t="b"><v>1</v></c><c r="C1"/><c t="str"><f>A1</f><v>made</v></c>'
             '<c t="s"><v>99</v></c><c t="e"><v>#N/A</v></c></row>')
    blob = package([("[Content_Types].xml", "<Types/>"), ("xl/workbook.xml", book), ("xl/_rels/workbook.xml.rels", relations),
                    ("xl/sharedStrings.xml", strings), ("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{rows}</sheetData></worksheet>"),
                    ("xl/worksheets/sheet2.xml", f"<worksheet><sheetData>{other}</sheetData></worksheet>")])
    row = parse_documents(text_frame(spark, [blob]), name=None, output_format="txt").first()
    assert row["content"].split("\n") == ["Second <1>", "in line", "TRUE", "made", "#N/A", "First", "south", "4", "north & x", "5", "south", "6"]


def test_field_codes_deleted_and_doubled_text_is_left_out(spark):
    inner = "<mc:AlternateContent><mc:Choice>c</mc:Choice><mc:Fallback>f</mc:Fallback></mc:AlternateContent>"
    xml = ('<w:p><w:r><w:t>Page </w:t></w:r><w:r><w:instrText xml:space="preserve">HYPERLINK "http://x"</w:instrText></w:r><w:r><w:t>one</w:t></w:r>'
           "<w:del><w:r><w:delText>gone</w:delText></w:r></w:del></w:p><w:p><mc:AlternateContent><mc:Choice>chosen</mc:Choice>"
           f"<mc:Fallback>not {inner} this</mc:Fallback></mc:AlternateContent><mc:Fallback/> end</w:p>")
    blob = package([("[Content_Types].xml", "<Types/>"), ("word/document.xml", xml)])
    assert parse_documents(text_frame(spark, [blob]), name=None, output_format="txt").first()["content"] == "Page one\nchosen end"


def test_books_are_read_along_their_spine(spark):
    opf = ('<?xml version="1.0"?><package xmlns:dc="d" version="3.0"><metadata><dc:title>The &amp; Book</dc:title><dc:creator id="c">Ann</dc:creator>'
           '<dc:language>en</dc:language></metadata><manifest><item id="a" href="text/one%20a.xhtml"/><item href="../two.xhtml" id="b"/>'
           '<item id="n" href="nav.xhtml"/></manifest><spine><itemref idref="b"/><itemref idref="a" linear="yes"/><itemref idref="lost"/></spine></package>')
    page = "<html><head><title>no</title></head><body><p>{}</p></body></html>"
    blob = package([("mimetype", "application/epub+zip"), ("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OEBPS/c.opf"/></rootfiles></container>'),
                    ("other.opf", "<package/>"), ("OEBPS/c.opf", opf), ("OEBPS/text/one a.xhtml", page.format("first")), ("OEBPS/nav.xhtml", page.format("contents")),
                    ("two.xhtml", page.format("second"))])
    row = parse_documents(text_frame(spark, [blob]), name=None, output_format="txt").first()
    assert row["media_type"] == "application/epub+zip" and row["content"] == "second\nfirst"
    assert (row["metadata"]["title"], row["metadata"]["creator"], row["metadata"]["version"], row["metadata"]["language"]) == ("The & Book", "Ann", "3.0", "en")


def test_boundary_lines_are_read_in_one_pass(spark):
    def mail(body):
        return f"From: a@example.com\n{body}".encode()

    def multi(name, *parts, end=True):
        lines = "".join(f"--{name}\n{p}\n" for p in parts)
        return f'Content-Type: multipart/mixed;\n boundary="{name}"\n\nbefore\n{lines}' + (f"--{name}--\nafter" if end else "")

    text = "Content-Type: text/plain\n\n{}".format
    deep = text("leaf")
    for i in range(50):
        deep = multi(f"b{i}", deep)
    # A body may speak of boundaries and hold lines of dashes; only those of open multiparts cut it.
    speaking = text("Content-Type: multipart/mixed; boundary=x\n--x\n--\n---\n--b-\nkept")
    cases = [
        (mail(deep), ["leaf"]),
        (mail(multi("b", speaking, text("two"))), ["Content-Type: multipart/mixed; boundary=x\n--x\n--\n---\n--b-\nkept", "two"]),
        # The outer boundary closes an inner multipart that stays open; boundaries that begin alike are told apart.
        (mail(multi("b", multi("bb", text("in"), end=False), text("out"))), ["in\n", "out"]),
        (mail(multi("a--", multi("a", text("x")), text("y"))), ["x", "y"]),
        (mail(multi("b", text("cut"), end=False)), ["cut\n"]),
        (mail(multi("b")), []),
        (mail("Content-Type: multipart/mixed\n\nno boundary"), ["no boundary"]),
        (mail(multi("q+.*[", text("x"))), ["x"]),
        (mail(multi("b", *[text(str(i)) for i in range(300)])), [str(i) for i in range(300)]),
    ]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(cases)], "i int, eml binary")
    rows = P.parse_message(df).orderBy("i").collect()
    got = [[bytes(p["content"]).decode() for p in r["parts"]] for r in rows]
    assert got[6][0].endswith("no boundary")
    got[6] = ["no boundary"]
    assert got == [parts for _, parts in cases]


def test_base64_is_read_by_runs_and_codes_by_runs(spark):
    """No pattern that tries every character between the letters of base64, and one piece for neighbouring codes."""
    from docspark.functions.mail import base64_bytes, quoted_printable

    df = spark.createDataFrame([("YW\n Jj\n", "=41=42\n=4=\n3==zz=e9"), ("", ""), (None, None), ("YQ==\u00e4", "=")], "b string, q string")
    out = df.select(base64_bytes(F.col("b")).alias("b"), quoted_printable(F.col("q")).alias("q"))
    assert [(r.b and bytes(r.b), r.q and bytes(r.q)) for r in out.collect()] == [
        (b"abc", b"AB\nC==zz\xe9"), (bytearray(), bytearray()), (None, None), (b"a", b"=")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "[^A-Za-z0-9+/=]" not in plan and "split(" not in plan
