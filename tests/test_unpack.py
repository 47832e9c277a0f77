import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docspark.operators import unpack as U
from tests.test_parsing import MAIL


def archive(*members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buffer.getvalue()


INNER = archive(("embed1/embed1a.txt", b"deep"), ("more.zip", archive(("last.txt", b"deepest"))))
OFFICE = archive(("[Content_Types].xml", b"<Types/>"), ("word/document.xml", b"<w:p/>"),
                 ("word/embeddings/embed1.zip", INNER), ("word/media/image1.emf", b"\1\0\0\0emf"))


def children(spark, content, depth=1, name="root"):
    df = spark.createDataFrame([(1, name, content)], "doc_id int, path string, content binary")
    rows = U.embedded_name(U.unpack_documents(df, depth, name="path")).orderBy("ord_path").collect()
    return rows


@pytest.mark.parametrize(("depth", "names"), [
    (1, {"embed1.zip", "image1.emf"}),
    (2, {"embed1.zip", "image1.emf", "embed1/embed1a.txt", "more.zip"}),
    (3, {"embed1.zip", "image1.emf", "embed1/embed1a.txt", "more.zip", "last.txt"}),
    (9, {"embed1.zip", "image1.emf", "embed1/embed1a.txt", "more.zip", "last.txt"}),
])
def test_depth(spark, depth, names):
    rows = children(spark, OFFICE, depth)
    assert {r["child_name"] for r in rows} == names
    assert all(len(r["content"]) for r in rows)


def test_leaf_files_have_no_children(spark):
    assert children(spark, b"Hello, world!", 2) == []
    assert children(spark, OFFICE, 0) == []


def test_broken_archives_give_error_rows(spark):
    whole = bytearray(archive(("a.txt", b"hello hello")))
    whole[40] ^= 0xFF
    rows = children(spark, bytes(whole))
    assert [r["error"]["error_class"] for r in rows] == ["PARSE_ERROR"]
    assert children(spark, b"PK\x03\x04nothing")[0]["error"]["message"].startswith("broken archive")


def test_message_children_and_names(spark):
    rows = children(spark, MAIL, 1)
    assert [r["child_name"] for r in rows] == ["embedded_0", "embedded_1", "a.bin"]
    df = spark.createDataFrame([(1, MAIL)], "doc_id int, content binary")
    flat = U.embedded_name(U.unpack_documents(df, 1), max_depth=1)
    assert [r["child_name"] for r in flat.orderBy("ord_path").collect()] == ["embedded_0", "embedded_1", "a.bin"]
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    assert [r["media_type"] for r in rows] == ["text/plain", "text/html", "application/x-thing"]


def test_relationship_id_is_the_second_choice(spark):
    part = b"From: a@example.com\nContent-Type: multipart/mixed; boundary=b\n\n--b\nContent-ID: <rel1>\n\nx\n--b--\n"
    assert [r["child_name"] for r in children(spark, part)] == ["rel1"]


def test_deeply_nested_multipart_opens_to_its_leaves(spark):
    body = "Content-Type: text/plain\n\nleaf"
    for i in range(5):
        body = f"Content-Type: multipart/mixed; boundary=b{i}\n\n--b{i}\n{body}\n--b{i}--\n"
    rows = children(spark, ("From: a@example.com\n" + body).encode(), 1, "x.eml")
    assert [(r["media_type"], bytes(r["content"])) for r in rows] == [("text/plain", b"leaf")]


@pytest.mark.parametrize(("name", "safe"), [("../../etc/passwd", "etc/passwd"), ("/abs/x", "abs/x"),
                                            ("C:\\a\\b.txt", "a/b.txt"), ("a/./b", "a/b"), ("..", None)])
def test_names_cannot_leave_the_folder(spark, name, safe):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(U.safe_name(F.col("n"))).first()[0] == safe


def test_numbers_over_blocks_equal_a_plain_count(spark, monkeypatch):
    monkeypatch.setattr(U, "BLOCK_SIZE", 4)
    rows = [(r, [i], None if i % 3 else f"n{i}") for r in (1, 2) for i in range(30)]
    rows += [(1, [7, j], None) for j in range(5)]
    df = spark.createDataFrame(rows, "root_id int, ord_path array<int>, name string").withColumn(
        "relationship_id", F.lit(None).cast("string"))
    got = {(r["root_id"], tuple(r["ord_path"])): r["child_name"] for r in U.embedded_name(df).collect()}
    for root in (1, 2):
        ordered = sorted((tuple(p), n) for r, p, n in rows if r == root)
        for n, (path, name) in enumerate(ordered):
            assert got[(root, path)] == (name or f"embedded_{n}")


def test_result_lists_come_in_blocks_and_leaves_are_kept(spark, monkeypatch):
    monkeypatch.setattr(U, "BLOCK_SIZE", 4)
    df = spark.createDataFrame([(1, [i], f"n{i}") for i in range(10)], "root_id int, ord_path array<int>, child_name string")
    df = df.withColumn("safe_name", F.col("child_name")).withColumn("depth", F.lit(1)).withColumn("media_type", F.lit("x/y"))
    roots = spark.createDataFrame([(1, "m1"), (2, "m2")], "doc_id int, metadata string")
    rows = U.unpack_result(roots, df).orderBy("root_id", "block_no").collect()
    assert [(r["root_id"], r["block_no"], len(r["embedded_documents"])) for r in rows] == [
        (1, 0, 4), (1, 1, 4), (1, 2, 2), (2, 0, 0)]


def test_inline_resources(spark):
    page = b"<html><style>p{}</style><img src='data:image/gif;base64,R0lGODlh'><SCRIPT src=x>run()</SCRIPT><script>cut"
    rows = children(spark, page)
    assert [(r["media_type"], bytes(r["content"])) for r in rows] == [
        ("text/css", b"p{}"), ("image/gif", b"GIF89a"), ("application/javascript", b"run()"),
        ("application/javascript", b"cut")]


def test_unpack_in_one_call(spark, tmp_path):
    from docspark import unpack, write_embedded

    df = spark.createDataFrame([(1, "a.docx", OFFICE), (2, "b.txt", b"Hello")], "doc_id int, path string, content binary")
    result, embedded = unpack(df, max_depth=2, name="path")
    rows = {r["root_id"]: r for r in result.collect()}
    assert rows[1]["root_metadata"]["content_type"].endswith("wordprocessingml.document")
    assert [d["metadata"]["resource_name"] for d in rows[1]["embedded_documents"]] == [
        "embed1.zip", "embed1/embed1a.txt", "more.zip", "image1.emf"]
    assert [d["metadata"]["embedded_depth"] for d in rows[1]["embedded_documents"]] == [1, 2, 2, 1]
    assert rows[2]["root_metadata"]["resource_name"] == "b.txt" and rows[2]["embedded_documents"] == []
    assert write_embedded(embedded, f"{tmp_path}/out").count() == 4


def test_data_uris_with_parameters_and_without_base64(spark):
    page = (b"<html><img src='data:image/svg+xml;charset=utf-8,%3Csvg%20a=1+2%3E%ff'><img src=\"data:text/plain;charset=x;base64,aGk=\">"
            b"<a href='data:text/html,a%zz'>z</a> see data:text/plain,not</html>")
    assert [(r["media_type"], bytes(r["content"])) for r in children(spark, page)] == [
        ("image/svg+xml", b"<svg a=1+2>\xff"), ("text/plain", b"hi"), ("text/html", b"a%zz")]


def test_roots_of_equal_or_no_id_keep_their_own_children(spark):
    from docspark import unpack

    rows = [(1, "a.zip", archive(("a.txt", b"a"), ("b.txt", b"b"))), (1, "c.zip", archive(("c.txt", b"c"))), (None, "d.zip", archive(("d.txt", b"d"))),
            (None, "e.txt", b"leaf"), (2, "n.zip", None), (3, "x.zip", b"PK\x03\x04broken")]
    df = spark.createDataFrame(rows, "doc_id int, path string, content binary")
    result, _ = unpack(df, max_depth=2, name="path")
    found = {r["root_metadata"]["resource_name"]: (r["root_id"], [d["child_name"] for d in r["embedded_documents"]], len(r["embedded_errors"]),
                                                   r["root_error"] and r["root_error"]["error_class"]) for r in result.collect()}
    assert found == {"a.zip": (1, ["a.txt", "b.txt"], 0, None), "c.zip": (1, ["c.txt"], 0, None), "d.zip": (None, ["d.txt"], 0, None),
                     "e.txt": (None, [], 0, None), "n.zip": (2, [], 0, "INVALID_INPUT"), "x.zip": (3, [], 1, None)}


def test_package_metadata_of_roots(spark):
    from docspark import unpack

    blob = archive(("[Content_Types].xml", b"<Types/>"), ("word/document.xml", b"<w:p/>"), ("docProps/core.xml", b"<dc:title>T</dc:title>"),
                   ("word/vbaProject.bin", b"\x00"), ("word/theme/theme1.xml", b"<a/>"))
    result, embedded = unpack(spark.createDataFrame([(1, blob)], "doc_id int, content binary"))
    assert result.first()["root_metadata"]["title"] == "T"
    assert [r["child_name"] for r in embedded.collect()] == ["vbaProject.bin"]


def test_many_children_deep_in_one_root_are_listed_over_tasks(spark):
    from docspark import unpack

    inner = archive(*[(f"m{i}.txt", b"%d" % i) for i in range(5000)])
    df = spark.createDataFrame([(1, archive(("first.txt", b"1"), ("in.zip", inner), ("last.txt", b"2")))], "doc_id int, content binary")
    result, children_ = unpack(df, max_depth=2)
    rows = result.orderBy("block_no").collect()
    assert [len(r["embedded_documents"]) for r in rows] == [1000] * 5 + [3]
    names = [d["child_name"] for r in rows for d in r["embedded_documents"]]
    assert names == ["first.txt", "in.zip", *[f"m{i}.txt" for i in range(5000)], "last.txt"]
    ranks = U.ordinals(children_.select("root_no", "ord_path"))
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    # The only window over a root alone counts its ranges.
    assert "range" in plan and {r["n"] for r in ranks.collect()} == set(range(5003))


def test_text_of_embedded_documents(spark):
    from docspark import parse_documents

    mail = (b"From: a@example.com\nSubject: s\nContent-Type: multipart/mixed; boundary=b\n\n--b\nContent-Type: text/plain\n\nbody\n--b\n"
            b"Content-Type: text/plain; charset=windows-1251; name=n.txt\nContent-Transfer-Encoding: base64\n\nz/Do4uXy\n--b\n"
            b"Content-Type: application/zip; name=z.zip\nContent-Transfer-Encoding: base64\n\n" +
            __import__("base64").b64encode(archive(("deep.txt", b"deep"))) + b"\n--b--\n")
    docx = archive(("[Content_Types].xml", b"<Types/>"), ("word/document.xml", b"<w:p>own</w:p>"), ("word/embeddings/e.zip", archive(("x.txt", b"inside"))),
                   ("word/media/i.png", b"\x89PNG\r\n\x1a\n"))
    rows = [("a.zip", archive(("a.txt", b"one\r\ntwo"), ("dir/", b""), ("p.html", b"<html><script>no()</script><p>page</p></html>"), ("m.eml", mail), ("bad.xml", b"<?xml version='1.0'?><a>"))),
            ("m.eml", mail), ("d.docx", docx), ("t.txt", b"plain"), ("n", None), ("broken.zip", b"PK\x03\x04x")]
    df = spark.createDataFrame(rows, "path string, content binary")

    def texts(depth):
        parsed = parse_documents(df, output_format="txt", embedded_depth=depth)
        return {r["path"]: r["content"] for r in parsed.collect()}

    wanted = {"a.zip": "one\ntwo\npage\nbody\nПривет\ndeep", "m.eml": "body\nПривет\ndeep", "d.docx": "own\ninside", "t.txt": "plain", "n": None, "broken.zip": ""}
    assert texts(9) == wanted
    assert texts(1) == wanted | {"a.zip": "one\ntwo\npage\nbody", "m.eml": "body\nПривет", "d.docx": "own"}
    assert texts(0)["a.zip"] == ""


def test_rolled_up_texts_come_in_order_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(U, "BLOCK_SIZE", 3)
    rows = [(1, [i], f"t{i}") for i in range(20)] + [(1, [4, j], f"u{j}") for j in range(11)] + [(1, [4, 2, 0], "v"), (2, [0, 0], "w"), (2, [0], None), (3, [1], "")]
    df = spark.createDataFrame(rows, "root_no long, ord_path array<int>, text string").repartition(5)
    got = {r["root_no"]: r["text"] for r in U.rolled_up_text(df).collect()}
    under = [f"u{j}" for j in range(11)]
    under.insert(3, "v")
    wanted = [f"t{i}" for i in range(20)]
    wanted[5:5] = under
    assert got == {1: "\n".join(wanted), 2: "w"}
