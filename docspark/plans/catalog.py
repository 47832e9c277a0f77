"""One query per operator, over whole tables. Binary, map and struct columns are flattened."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions.html import escape_markup, html_title
from docspark.functions.text import decode_text
from docspark.operators import errors, language, media_types, metadata, parsing, unpack
from docspark.plans import inputs
from docspark.plans.documents import analyze_documents, parse_documents, parse_to_string
from docspark.session import configure, fresh_path, materialize
from docspark.sources.files import documents_from_table, read_files
from docspark.sources.sinks import chunk_content, write_embedded, write_extracted
from docspark.streaming.ingest import parse_stream, read_split, read_table_stream, write_stream, write_stream_split

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _sha(content: str) -> Column:
    return F.sha2(F.col(content), 256)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "pages")


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_from_table(_pages(spark, sf_dir), "html", name="url")


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = language.train_language_profiles(_documents(spark, sf_dir))
    return materialize(trained, "language-profiles")


# Sources and sinks


@query
def read_files_query(spark, sf_dir):
    return read_files(spark, sf_dir, glob="*.parquet").select("name", (F.col("length") > 0).alias("has_content"))


@query
def documents_from_table_query(spark, sf_dir):
    docs = _documents(spark, sf_dir).withColumn("name", F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    files = documents_from_table(docs.withColumn("hint", F.lit(V.TEXT_PLAIN)), "text", "name", "hint")
    return files.select("doc_id", "path", "content_type_hint", "length", _sha("content").alias("content_sha256"))


@query
def parse_to_string_query(spark, sf_dir):
    files = documents_from_table(_documents(spark, sf_dir), "text")
    return parse_to_string(files).select("doc_id", "media_type", "content")


@query
def write_extracted_query(spark, sf_dir):
    texts = inputs.files(spark, sf_dir).select("doc_id", "path", F.col("text").alias("content"))
    written = write_extracted(texts, fresh_path(spark, "extracted"), "txt")
    return written.select("doc_id", "output_path", "content_length")


@query
def chunk_content_query(spark, sf_dir):
    chunks = chunk_content(_documents(spark, sf_dir).select("doc_id", "text"), 8192, "text")
    return chunks.select("doc_id", "chunk_no", F.octet_length("chunk").cast("bigint").alias("chunk_length"),
                         _sha("chunk").alias("chunk_sha256"))


def _parsed_pages(pages: DataFrame) -> DataFrame:
    return parse_documents(pages)


def _page_columns(parsed: DataFrame) -> DataFrame:
    return parsed.select("page_id", "media_type", "text", F.col("metadata.title").alias("title"),
                         F.col("metadata.language").alias("language"),
                         F.col("metadata.content_length").alias("content_length"))


@query
def parse_stream_query(spark, sf_dir):
    schema = _pages(spark, sf_dir).schema
    pages = documents_from_table(read_table_stream(spark, sf_dir, schema, glob="pages.parquet"), "html", "url")
    stream = _page_columns(parse_stream(pages))
    out = fresh_path(spark, "parsed-stream")
    write_stream(stream, out, fresh_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query
def parse_stream_split(spark, sf_dir):
    """Files of documents in two deliveries, read by one stream that is started twice from its checkpoint."""
    files = inputs.files(spark, sf_dir).select("doc_id", "path", "content")
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("delivered", "split-stream", "split-checkpoint"))
    for turn in (0, 1):
        files.where(F.col("doc_id") % 2 == turn).write.mode("append").parquet(folder)
        parsed = parse_stream(read_table_stream(spark, folder, files.schema, max_files_per_trigger=5), output_format="txt")
        stream = parsed.select("doc_id", "media_type", "error")
        write_stream_split(stream, out, checkpoint).awaitTermination()
    good, bad = read_split(spark, out, stream.schema)
    return good.select("doc_id", "media_type", F.lit("good").alias("state"), F.lit(None).cast("string").alias("error_class")) \
        .unionByName(bad.select("doc_id", "media_type", F.lit("bad").alias("state"), "error.error_class"))


# Media types


@query
def detect_magic(spark, sf_dir):
    return media_types.detect_magic(inputs.files(spark, sf_dir)).select("doc_id", "magic_type")


@query
def detect_glob(spark, sf_dir):
    names = inputs.files(spark, sf_dir).select("doc_id", "path").unionByName(
        _pages(spark, sf_dir).select(F.col("page_id").alias("doc_id"), F.col("url").alias("path")))
    return media_types.detect_glob(names).select("doc_id", "path", "glob_type")


@query
def sniff_text(spark, sf_dir):
    return media_types.sniff_text(inputs.files(spark, sf_dir)).select("doc_id", "sniff_type")


@query
def refine_container(spark, sf_dir):
    return media_types.refine_container(inputs.files(spark, sf_dir)).select("doc_id", "container_type")


@query
def resolve_media_type(spark, sf_dir):
    candidates = media_types.detect_glob(media_types.detect_magic(inputs.files(spark, sf_dir)))
    resolved = media_types.resolve_media_type(candidates, ["magic_type", "glob_type"])
    return resolved.select("doc_id", "magic_type", "glob_type", "media_type")


def _markdown_detector(content: Column, name: Column) -> Column:
    return F.when(name.rlike(r"\.mdx?$"), "text/markdown").otherwise(V.OCTET_STREAM)


@query
def detect_custom(spark, sf_dir):
    files = inputs.files(spark, sf_dir)
    return media_types.detect_media_type(files, name="path", custom_detectors=[_markdown_detector]).select(
        "doc_id", "media_type")


@query
def media_type_registry(spark, sf_dir):
    found = media_types.detect_media_type(inputs.files(spark, sf_dir), name="path",
                                          custom_detectors=[_markdown_detector])
    counts = found.groupBy("media_type").agg(F.count("*").alias("documents"))
    registry = media_types.media_type_registry(spark, custom=["text/markdown"])
    return counts.join(registry, "media_type", "left").select(
        "media_type", "documents", "top_type", "sub_type", "supertype")


@query
def override_media_type(spark, sf_dir):
    files = inputs.files(spark, sf_dir).withColumn("hint", F.when(F.col("doc_id") % 3 == 0, "application/x-given"))
    detected = media_types.detect_media_type(files, name="path", output="detected")
    return media_types.override_media_type(detected, "hint", "detected").select(
        "doc_id", "detected", "media_type", "media_type_override")


@query
def detect_media_type(spark, sf_dir):
    files = inputs.files(spark, sf_dir)
    pages = _page_files(spark, sf_dir).select(F.col("page_id").alias("doc_id"), "path", "content")
    both = files.select("doc_id", "path", "content").unionByName(pages)
    return media_types.detect_media_type(both, name="path").select("doc_id", "path", "media_type")


# Parsing


@query
def parse_text(spark, sf_dir):
    """Each document in one of eight charsets, by ``doc_id % 8``: detected ones, then declared ones."""
    text, kind = F.col("text"), F.col("doc_id") % 8
    latin = text.rlike(r"^[\x00-\xFF]*$")
    name, _, own = inputs.foreign(text, kind - 4)
    content = (
        F.when(kind == 1, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode(text, "UTF-8")))
        .when(kind == 2, F.concat(F.lit(b"\xff\xfe"), F.encode(text, "UTF-16LE")))
        .when((kind == 3) & latin, F.encode(F.when(latin, text), "ISO-8859-1"))
        .when(kind >= 4, own)
        .otherwise(F.encode(text, "UTF-8"))
    )
    docs = _documents(spark, sf_dir).select("doc_id", content.alias("content"), name.alias("charset"))
    return parsing.parse_text(docs, charset="charset").select("doc_id", "encoding", "text")


@query
def parse_html_text(spark, sf_dir):
    pages = inputs.page_files(spark, sf_dir).withColumn("html", parsing.markup_text(F.col("content")))
    return parsing.parse_html_text(pages, "content").select("page_id", html_title(F.col("html")).alias("title"), "text")


@query
def parse_xml(spark, sf_dir):
    """Each document as XML; for odd ids the root is not closed."""
    clean = escape_markup(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", ""))
    xml = F.concat(F.lit('<?xml version="1.0"?>\n<doc><lang>'), F.col("lang"), F.lit("</lang><body>"), clean,
                   F.when(F.col("doc_id") % 2 == 0, "</body></doc>").otherwise("</body>"))
    docs = _documents(spark, sf_dir).select("doc_id", xml.alias("xml"))
    return parsing.parse_xml(docs).select("doc_id", "text", F.col("error.error_class").alias("error_class"))


@query
def parse_message(spark, sf_dir):
    parsed = parsing.parse_message(inputs.messages(spark, sf_dir, charsets=True))
    headers = {"subject": "Subject", "sender": "From", "recipient": "To", "copy": "Cc"}
    return parsed.select(
        "msg_id", *[F.try_element_at("headers", F.lit(name)).alias(alias) for alias, name in headers.items()],
        F.size("parts").alias("parts"), "text",
    )


@query
def parse_package(spark, sf_dir):
    packages = media_types.detect_media_type(inputs.packages(spark, sf_dir))
    return parsing.parse_package(packages).select("doc_id", "media_type", "text")


@query
def render_content(spark, sf_dir):
    pages = parsing.parse_html_text(_pages(spark, sf_dir))
    described = pages.withColumn("title", html_title(F.col("html"))).withColumn(
        "raw", F.create_map(F.lit("resourceName"), F.col("url"), F.lit("Content-Type"), F.lit(V.TEXT_HTML)))
    return parsing.render_content(described, "xhtml", title="title", raw="raw").select("page_id", "content")


def _bracket(content: Column) -> Column:
    return F.concat(F.lit("["), decode_text(content), F.lit("]"))


@query
def custom_parsers(spark, sf_dir):
    """A parser for the type that odd documents are declared to have."""
    odd = F.when(F.col("doc_id") % 2 == 1, "text/x-bracket").otherwise(V.TEXT_PLAIN)
    files = documents_from_table(_documents(spark, sf_dir).withColumn("hint", odd), "text", None, "hint")
    parsed = parse_documents(files, hint="content_type_hint", output_format="txt",
                             custom_parsers={"text/x-bracket": _bracket})
    by = F.try_element_at("raw_metadata", F.lit(V.PARSED_BY))
    return parsed.select("doc_id", "media_type", "content", by.alias("parsed_by"))


@query
def parse_documents_query(spark, sf_dir):
    return _page_columns(_parsed_pages(_page_files(spark, sf_dir)))


@query
def parse_strict(spark, sf_dir):
    """Pages again, where the first bad document would end the job."""
    return _page_columns(parse_documents(_page_files(spark, sf_dir), strict=True))


@query
def parse_embedded(spark, sf_dir):
    """Archives of pages and messages with attachments, with the text of what is embedded in them."""
    archives = inputs.archives(spark, sf_dir).select(F.col("page_id").cast("string").alias("doc_id"), "content")
    mails = inputs.messages(spark, sf_dir).select(F.col("msg_id").alias("doc_id"), F.encode("eml", "UTF-8").alias("content"))
    parsed = parse_documents(archives.unionByName(mails), name=None, output_format="txt", embedded_depth=3)
    return parsed.select("doc_id", "media_type", "text")


# Metadata


@query
def raw_metadata(spark, sf_dir):
    typed = media_types.detect_media_type(inputs.page_files(spark, sf_dir), name="path")
    raw = metadata.raw_metadata(typed, name="path")

    def value(key: str) -> Column:
        return F.try_element_at("raw_metadata", F.lit(key))

    return raw.select(
        "page_id", value("resourceName").alias("resource_name"), value("Content-Length").alias("content_length"),
        value("Content-Type").alias("content_type"), value("Content-Encoding").alias("content_encoding"),
        value("dc:title").alias("title"), value("dc:language").alias("language"),
    )


def _typed_fields(fields: list[str]) -> list[Column]:
    return [F.col(f"metadata.{f}").alias(f) for f in fields]


@query
def normalize_metadata(spark, sf_dir):
    typed = metadata.normalize_metadata(inputs.raw_maps(spark, sf_dir))
    fields = ["title", "word_count", "is_encrypted", "creator", "created", "modified", "from_", "company"]
    return typed.select("doc_id", *_typed_fields(fields))


@query
def coerce_metadata(spark, sf_dir):
    typed = metadata.coerce_metadata(inputs.raw_maps(spark, sf_dir))
    return typed.select(
        "doc_id", *_typed_fields(["word_count", "duration"]),
        F.array_join("metadata.keywords", "|").alias("keywords"),
        F.try_element_at("metadata_unparsed", F.lit("word_count")).alias("unparsed_word_count"),
        F.try_element_at("metadata_unparsed", F.lit("duration")).alias("unparsed_duration"),
    )


@query
def metadata_entries(spark, sf_dir):
    return metadata.metadata_entries(inputs.raw_maps(spark, sf_dir))


@query
def metadata_diff(spark, sf_dir):
    """Against a copy with a changed title, a dropped key and an added key, by id."""
    left = inputs.raw_maps(spark, sf_dir)
    changed = F.transform_values("raw_metadata", lambda k, v: F.when(
        (k == "dc:title") & (F.col("doc_id") % 3 == 0), F.concat(v, F.lit("!"))).otherwise(v))
    dropped = F.map_filter(changed, lambda k, v: (k != "X-Unknown") | (F.col("doc_id") % 5 != 0))
    added = F.when(F.col("doc_id") % 4 == 0, F.map_concat(dropped, F.create_map(F.lit("X-New"), F.lit("new"))))
    right = left.select("doc_id", F.coalesce(added, dropped).alias("raw_metadata"))
    return metadata.metadata_diff(metadata.metadata_entries(left), metadata.metadata_entries(right),
                                  ignore=["pdf:encrypted"])


# Language


@query
def train_language_profiles(spark, sf_dir):
    return language.train_language_profiles(_documents(spark, sf_dir)).select("lang", "gram", "weight")


@query
def detect_language(spark, sf_dir):
    found = language.detect_language(_documents(spark, sf_dir), _profiles(spark, sf_dir))
    return found.select("doc_id", "language", "log_weight")


@query
def language_confidence(spark, sf_dir):
    found = language.detect_language(_documents(spark, sf_dir), _profiles(spark, sf_dir))
    return language.language_confidence(found).select("doc_id", "language", "raw_score", "confidence")


# Unpacking


@query
def unpack_message(spark, sf_dir):
    mails = inputs.messages(spark, sf_dir).select("msg_id", F.encode("eml", "UTF-8").alias("content"))
    return unpack.unpack_message(mails).select(
        "msg_id", "ord", "name", "media_type", _sha("content").alias("content_sha256"))


def _sha_of_leaf(name: str = "name") -> Column:
    """Hash of a child that is no archive; the bytes of a nested archive depend on its writer."""
    is_archive = F.coalesce(F.endswith(F.col(name), F.lit(".zip")), F.lit(False))
    return F.when(~is_archive, _sha("content")).alias("content_sha256")


@query
def unpack_archive(spark, sf_dir):
    return unpack.unpack_archive(inputs.archives(spark, sf_dir)).select("page_id", "ord", "name", _sha_of_leaf())


@query
def unpack_html(spark, sf_dir):
    return unpack.unpack_html(_pages(spark, sf_dir).select("page_id", "html"), "html").select(
        "page_id", "ord", "media_type", _sha("content").alias("content_sha256"))


def _children(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The archives are written first: building them is no part of unpacking them.
    archives = materialize(inputs.archives(spark, sf_dir), "archives")
    return unpack.unpack_documents(archives, max_depth=3, id_col="page_id")


@query
def unpack_documents(spark, sf_dir):
    children = _children(spark, sf_dir)
    return children.select(
        "root_id", "depth", F.array_join(F.col("ord_path").cast("array<string>"), "/").alias("ord_path"),
        "parent_name", "name", "media_type", _sha_of_leaf())


@query
def embedded_name(spark, sf_dir):
    named = unpack.embedded_name(_children(spark, sf_dir))
    return named.select("root_id", "depth", "child_name", "safe_name")


@query
def unpack_result(spark, sf_dir):
    roots = metadata.normalize_metadata(
        inputs.table(spark, sf_dir, "pages").select(
            "page_id", F.create_map(F.lit("resourceName"), F.col("url")).alias("raw_metadata")))
    children = unpack.describe_embedded(unpack.embedded_name(_children(spark, sf_dir)))
    result = unpack.unpack_result(roots, children, "page_id")
    names = F.transform("embedded_documents", lambda d: d["metadata"]["resource_name"])
    depths = F.transform("embedded_documents", lambda d: d["metadata"]["embedded_depth"].cast("string"))
    return result.select("root_id", "block_no", F.col("root_metadata.resource_name").alias("resource_name"),
                         F.size("embedded_documents").alias("children"), F.array_join(names, ",").alias("names"),
                         F.array_join(depths, ",").alias("depths"))


@query
def write_embedded_query(spark, sf_dir):
    children = unpack.embedded_name(_children(spark, sf_dir))
    written = write_embedded(children, fresh_path(spark, "embedded"))
    is_archive = F.coalesce(F.endswith("rel_path", F.lit(".zip")), F.lit(False))
    return written.select("root_id", "depth", "rel_path",
                          F.when(~is_archive, F.col("content_length")).alias("content_length"))


# Errors


@query
def split_errors(spark, sf_dir):
    parsed = parse_documents(inputs.files(spark, sf_dir), output_format="txt")
    good, bad = errors.split_errors(parsed.select("doc_id", "media_type", "error"))
    return good.select("doc_id", "media_type", F.lit("good").alias("state"), F.lit(None).cast("string").alias("error_class")) \
        .unionByName(bad.select("doc_id", "media_type", F.lit("bad").alias("state"), "error.error_class"))


@query
def validate_input(spark, sf_dir):
    docs = _documents(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("content"),
        F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("source")).alias("path"),
        F.when(F.col("doc_id") % 11 == 0, "pdf").otherwise("xhtml").alias("output_format"),
    )
    checked = errors.validate_input(docs, "content", "path", "output_format")
    return checked.select("doc_id", F.col("error.error_class").alias("error_class"))


# End to end


@query
def analyze_documents_query(spark, sf_dir):
    analysed = analyze_documents(_page_files(spark, sf_dir), _profiles(spark, sf_dir), ["page_id"])
    return analysed.select("page_id", "media_type", F.col("metadata.title").alias("title"), "content",
                           "language", "raw_score", "confidence")


for _name in [n for n in QUERIES if n.endswith("_query")]:
    QUERIES[_name.removesuffix("_query")] = QUERIES.pop(_name)
