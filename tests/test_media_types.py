import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docspark.operators import media_types as M

CONTENTS = [
    ("plain.txt", b"Hello world", "text/plain"),
    ("page.html", b"<html><body>Hello</body></html>", "text/html"),
    ("config.xml", b"<?xml version='1.0'?><root></root>", "application/xml"),
]

CASES = [
    *CONTENTS,
    *[(None, content, kind) for _, content, kind in CONTENTS],
    ("notes.txt", b"%PDF-1.7 ...", "application/pdf"),
    ("page.html", b"no markup at all", "text/html"),
    ("report.docx", b"PK\x03\x04" + b"\0" * 30, "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    ("a.tar.gz", b"\x1f\x8b\x08\0", "application/gzip"),
    ("A.PDF", b"", "application/pdf"),
    (None, b"", "application/octet-stream"),
    ("x", b"RIFF\x10\0\0\0WEBPVP8 ", "image/webp"),
    ("x", b"RIFF\x10\0\0\0WAVEfmt ", "audio/vnd.wave"),
    ("x", b"\0\0\0\x14ftypqt  ", "video/quicktime"),
    ("clip.mov", b"\0\0\0\x14ftypmp42", "video/quicktime"),
    ("x", b"\0" * 257 + b"ustar", "application/x-tar"),
    ("x.doc", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "application/msword"),
    ("x", b"<?xml version='1.0'?><!DOCTYPE html><html xmlns='http://www.w3.org/1999/xhtml'/>", "application/xhtml+xml"),
    ("x.svg", b"<?xml version='1.0'?><svg/>", "image/svg+xml"),
    ("x", b"From: a@example.com\nTo: b@example.com\n\nhi", "message/rfc822"),
    ("x", b"From: here to there is text", "text/plain"),
    ("x", b"caf\xe9 au lait", "text/plain"),
    ("x", "\ufeffHello".encode("utf-16-le"), "text/plain"),
    ("x", b"\0\1\2\3", "application/octet-stream"),
    ("http://example.com/a/page.html?x=1.pdf#top", b"text", "text/html"),
    ("x", b"<!-- " + b"- " * 20000 + b"--><html>", "text/html"),
]


def test_detect_media_type(spark):
    df = spark.createDataFrame([(i, n, c) for i, (n, c, _) in enumerate(CASES)], "i int, path string, content binary")
    got = {r["i"]: r["media_type"] for r in M.detect_media_type(df, name="path").collect()}
    assert [(c[:2], got[i]) for i, c in enumerate(CASES)] == [(c[:2], c[2]) for c in CASES]


def test_custom_detector_comes_first_and_octet_stream_passes(spark):
    df = spark.createDataFrame([("a.md", b"# x"), ("a.txt", b"x")], "path string, content binary")

    def markdown(content, name):
        return F.when(name.endswith(".md"), "text/markdown").otherwise("application/octet-stream")

    rows = M.detect_media_type(df, name="path", custom_detectors=[markdown]).collect()
    assert [r["media_type"] for r in rows] == ["text/markdown", "text/plain"]


def test_hint_overrides_detection(spark):
    df = spark.createDataFrame([("a.txt", b"x", "application/x-mine"), ("a.txt", b"x", " ")],
                               "path string, content binary, hint string")
    rows = M.detect_media_type(df, name="path", hint="hint").collect()
    assert [r["media_type"] for r in rows] == ["application/x-mine", "text/plain"]


def test_long_rule_lists_give_the_same_answer_by_join(spark):
    rules = [(f"{i % 3}:{i:04X}", f"x/t{i}", i % 7) for i in range(1, 300)]
    rules += [("0:0102 4:03", "x/both", 9), ("0:0102", "x/later", 2)]
    contents = [bytes([a, b, c, d, 3]) for a in (0, 1) for b in range(0, 60, 3) for c in (0, 1) for d in (2, 44)]
    df = spark.createDataFrame([(bytes(c),) for c in contents], "content binary")
    joined = M.detect_magic(df, rules=rules)
    case = df.withColumn("magic_type", M.media.magic_type(F.col("content"), rules))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, case.collect()))
    assert joined.filter("magic_type IS NOT NULL").count() > 20


@pytest.mark.parametrize("name", ["markdown", "a/b/c", "/x", "x/"])
def test_registry_rejects_malformed_names(spark, name):
    with pytest.raises(ValueError, match="INVALID_MEDIA_TYPE"):
        M.media_type_registry(spark, custom=[name])
    lenient = M.media_type_registry(spark, custom=[name], strict=False).filter(F.col("media_type") == name)
    assert lenient.first()["error"]["error_class"] == "INVALID_MEDIA_TYPE"


def test_registry_supertypes(spark):
    rows = {r["media_type"]: r for r in M.media_type_registry(spark, custom=["text/markdown", "x/y+xml"]).collect()}
    assert rows["text/markdown"]["supertype"] == "text/plain"
    assert rows["x/y+xml"]["supertype"] == "application/xml"
    assert rows["application/epub+zip"]["supertype"] == "application/zip"
    assert rows["application/octet-stream"]["supertype"] is None
    assert (rows["video/mp4"]["top_type"], rows["video/mp4"]["sub_type"]) == ("video", "mp4")


def test_names_alone_keep_content_out_of_the_scan(spark, tmp_path):
    spark.createDataFrame([("a.pdf", b"x")], "path string, content binary").write.parquet(f"{tmp_path}/t")
    plan = M.detect_glob(spark.read.parquet(f"{tmp_path}/t")).select("path", "glob_type")
    assert "ReadSchema: struct<path:string>" in plan._jdf.queryExecution().executedPlan().toString()


def package(*members, stored=True):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
    return buffer.getvalue()


TYPES = ("[Content_Types].xml", b"<Types/>")
DOCX = package(TYPES, ("word/document.xml", b"<w:p/>"))
OOXML = "application/vnd.openxmlformats-officedocument."


@pytest.mark.parametrize("content,expected", [
    (DOCX, OOXML + "wordprocessingml.document"),
    (package(TYPES, ("xl/workbook.xml", b"<w/>"), stored=False), OOXML + "spreadsheetml.sheet"),
    (package(TYPES, ("ppt/embeddings/a.docx", DOCX), ("ppt/presentation.xml", b"")), OOXML + "presentationml.presentation"),
    (package(TYPES, ("customXml/keyword/item1.xml", b""), ("ppt/presentation.xml", b"")), OOXML + "presentationml.presentation"),
    (package(TYPES, ("ppt/media/v.bin", b"word/ xl/ PK\x01\x02" * 400_000), ("ppt/presentation.xml", b"")),
     OOXML + "presentationml.presentation"),
    (package(TYPES, ("word/other.xml", b"")), OOXML + "wordprocessingml.document"),
    (package(TYPES, ("else.xml", b"")), "application/x-tika-ooxml"),
    (package(("mimetype", b"application/epub+zip"), ("a.xhtml", b"")), "application/epub+zip"),
    (package(("a.txt", b"[Content_Types].xml word/document.xml")), None),
    (package(("inner.docx", DOCX)), None),
    (DOCX[:-30], OOXML + "wordprocessingml.document"), (b"PK\x03\x04", None), (b"", None), (None, None),
])
def test_container_type_comes_from_the_outer_directory(spark, content, expected):
    df = spark.createDataFrame([(content,)], "content binary")
    assert M.refine_container(df).first()["container_type"] == expected


def test_types_of_the_user_take_part_in_the_hierarchy(spark):
    from docspark import detect_media_type, media_type_registry, parse_documents, unpack

    supertypes = {"application/x-note": "application/x-memo", "application/x-memo": "text/plain", "image/x-tile": "image/png"}
    globs = [("application/x-note", ["note"]), ("application/x-memo", ["memo"]), ("image/x-tile", ["tile"]), ("application/pdf", ["pdf"])]
    rows = [("a.note", b"plain text"), ("b.tile", b"\x89PNG\r\n\x1a\n"), ("c.tile", b"plain text"), ("d.memo", b"\x89PNG\r\n\x1a\n"), ("e.txt", b"text")]
    df = spark.createDataFrame(rows, "path string, content binary")
    found = detect_media_type(df, name="path", globs=globs, supertypes=supertypes).orderBy("path").collect()
    wanted = ["application/x-note", "image/x-tile", "text/plain", "image/png", "text/plain"]
    assert [r["media_type"] for r in found] == wanted
    # A custom type wins over its ancestor from a detector, and not over a stranger.
    memo = lambda content, name: F.when(name.endswith("note"), "application/x-memo")
    assert detect_media_type(df, name="path", custom_detectors=[memo], globs=globs, supertypes=supertypes).orderBy("path").first()["media_type"] == wanted[0]
    assert [r["media_type"] for r in parse_documents(df, globs=globs, supertypes=supertypes).orderBy("path").collect()] == wanted
    registry = {r["media_type"]: r["supertype"] for r in media_type_registry(spark, supertypes=supertypes).collect()}
    assert {t: registry[t] for t in supertypes} == supertypes
    with pytest.raises(ValueError, match="INVALID_MEDIA_TYPE"):
        detect_media_type(df, supertypes={"a/x": "a/y", "a/y": "a/x"})
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in rows:
            z.writestr(name, content)
    packed = spark.createDataFrame([(1, buffer.getvalue())], "doc_id int, content binary")
    _, children = unpack(packed, 2, globs=globs, supertypes=supertypes)
    assert [r["media_type"] for r in children.orderBy("ord_path").collect()] == wanted


def test_thousands_of_rules_through_the_public_calls(spark):
    from docspark import fixed_values, parse_documents, unpack

    rules = [*fixed_values.MAGIC, *[("0:" + (b"RULE%05d" % i).hex(), f"application/x-rule-{i}", 60) for i in range(5000)]]
    rows = [(i, b"RULE%05d and more" % i) for i in (0, 17, 4999)] + [(5, b"%PDF-1.4"), (6, b"text")]
    df = spark.createDataFrame(rows, "doc_id int, content binary")
    wanted = ["application/x-rule-0", "application/pdf", "text/plain", "application/x-rule-17", "application/x-rule-4999"]
    assert [r["media_type"] for r in parse_documents(df, name=None, rules=rules).orderBy("doc_id").collect()] == wanted
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for i, content in sorted(rows):
            z.writestr(f"m{i}", content)
    packed = spark.createDataFrame([(1, buffer.getvalue())], "doc_id int, content binary")
    _, children = unpack(packed, 2, rules=rules)
    assert [r["media_type"] for r in children.orderBy("ord_path").collect()] == wanted
