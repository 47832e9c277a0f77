import pytest
from pyspark.sql import functions as F

from docspark.operators import errors as E
from docspark.sources.files import documents_from_table, read_files
from docspark.sources.sinks import chunk_content, output_path, write_embedded, write_extracted
from docspark.streaming.ingest import parse_stream, read_files_stream, write_stream


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_bytes(b"Hello")
    (tmp_path / "in" / "sub" / "b.html").write_bytes(b"<html><title>T</title><p>x</p></html>")
    return tmp_path


def test_read_files(spark, folder):
    rows = read_files(spark, str(folder / "in")).orderBy("name").collect()
    assert [(r["name"], r["length"]) for r in rows] == [("a.txt", 5), ("b.html", 37)]
    assert read_files(spark, str(folder / "in"), glob="*.html").count() == 1
    assert read_files(spark, str(folder / "in"), recursive=False).count() == 1


def test_file_listing_prunes_content_and_pushes_filters(spark, folder):
    df = read_files(spark, str(folder / "in")).filter("length > 10").select("name", "length")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content:binary" not in plan and "GreaterThan(length,10)" in plan


def test_missing_path(spark, folder):
    with pytest.raises(FileNotFoundError, match="INPUT_NOT_FOUND"):
        read_files(spark, str(folder / "nothing"))


def test_tables_as_documents(spark):
    df = spark.createDataFrame([(1, "é", "n.txt", "text/x")], "id int, body string, n string, t string")
    row = documents_from_table(df, "body", "n", "t").first()
    assert (bytes(row["content"]), row["path"], row["content_type_hint"], row["length"]) == ("é".encode(), "n.txt", "text/x", 2)
    with pytest.raises(TypeError, match="INVALID_INPUT"):
        documents_from_table(df, "id")


@pytest.mark.parametrize(("path", "expected"), [
    ("d/a.pdf", "d/a.txt"), ("a.tar.gz", "a.tar.txt"), ("d/noext", "d/noext"), (".bashrc", ".bashrc"),
    ("d.x/noext", "d.x/noext"), ("d/.hidden.md", "d/.hidden.txt"), ("d/a.", "d/a."),
])
def test_output_path(spark, path, expected):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(output_path(F.col("p"), "txt")).first()[0] == expected


def test_invalid_file_format(spark):
    with pytest.raises(ValueError, match="INVALID_OUTPUT_FORMAT"):
        output_path(F.lit("x"), "pdf")


def test_write_extracted(spark, tmp_path):
    df = spark.createDataFrame([("d/a.pdf", "té")], "path string, content string")
    row = write_extracted(df, f"{tmp_path}/out", "xhtml").first()
    assert (row["output_path"], row["content"], row["content_length"]) == ("d/a.xhtml", "té", 3)


def test_chunks_join_to_the_original(spark):
    text = "aé😀" * 5000
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "i int, content string")
    rows = chunk_content(df, 1000).orderBy("i", "chunk_no").collect()
    chunks = [bytes(r["chunk"]) for r in rows if r["i"] == 1]
    assert b"".join(chunks).decode() == text and max(map(len, chunks)) == 1000
    assert [(r["i"], r["chunk_no"], r["chunk"]) for r in rows if r["i"] != 1] == [(2, 0, b""), (3, 0, None)]
    with pytest.raises(ValueError, match="INVALID_ARGUMENT"):
        chunk_content(df, 0)


def test_write_embedded_keeps_equal_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "x.txt", "text/plain", b"a"), (1, 1, "x.txt", "text/plain", b"bc")],
                               "root_id int, depth int, safe_name string, media_type string, content binary")
    assert sorted(r["content_length"] for r in write_embedded(df, f"{tmp_path}/out").collect()) == [1, 2]


def test_stream_of_files_equals_batch(spark, folder):
    stream = parse_stream(read_files_stream(spark, str(folder / "in"))).select("name", "media_type", "text")
    out = str(folder / "out")
    write_stream(stream, out, str(folder / "cp")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("a.txt", "text/plain", "Hello"), ("b.html", "text/html", "x")]
    (folder / "in" / "c.txt").write_bytes(b"late")
    write_stream(stream, out, str(folder / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_errors_are_routed(spark):
    df = spark.createDataFrame([(1, None, "a", "txt"), (2, b"x", "", "txt"), (3, b"x", "a", "pdf"), (4, b"x", "a", "txt")],
                               "i int, content binary, path string, fmt string")
    good, bad = E.split_errors(E.validate_input(df, "content", "path", "fmt"))
    assert [r["i"] for r in good.collect()] == [4]
    classes = {r["i"]: r["error"]["error_class"] for r in bad.collect()}
    assert classes == {1: "INVALID_INPUT", 2: "INPUT_NOT_FOUND", 3: "INVALID_OUTPUT_FORMAT"}
    with pytest.raises(TypeError):
        E.validate_input(df, "i")


def test_file_stream_keeps_bad_rows_apart_and_restarts(spark, tmp_path):
    from docspark import parse_stream, read_files_stream, read_split, write_stream_split

    folder = tmp_path / "in"
    folder.mkdir()
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def run():
        parsed = parse_stream(read_files_stream(spark, str(folder), max_files_per_trigger=2), output_format="txt")
        write_stream_split(parsed, out, checkpoint).awaitTermination()
        good, bad = read_split(spark, out, parsed.schema)
        return sorted(r["content"] for r in good.collect()), [r["error"]["error_class"] for r in bad.collect()]

    for i in range(3):
        (folder / f"{i}.txt").write_text(f"text {i}")
    (folder / "bad.xml").write_text("<?xml version='1.0'?><a>")
    assert run() == (["text 0", "text 1", "text 2"], ["PARSE_ERROR"])
    (folder / "late.txt").write_text("late")
    assert run() == (["late", "text 0", "text 1", "text 2"], ["PARSE_ERROR"])
    assert run() == (["late", "text 0", "text 1", "text 2"], ["PARSE_ERROR"])
