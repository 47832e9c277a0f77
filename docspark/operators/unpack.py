"""Containers to child rows.

Children carry ``root_id, root_no, depth, ord_path, parent_name, parent_type, name, relationship_id,
media_type, charset, content, error``. ``ord_path`` holds the position at every level, so sorting
by it visits a root's children in document order. ``charset`` is what a message declares for the part.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions import metadata as M
from docspark.functions.html import html_embedded
from docspark.functions.mail import mime_parts
from docspark.functions.media import MagicRule
from docspark.functions.text import decode_text, lookup
from docspark.operators.errors import ERROR_TYPE
from docspark.operators.media_types import Detector, media_type_column, with_magic
from docspark.session import materialize

# A BINARY cell must stay below 2 GiB; a member past this size becomes an error row.
MAX_MEMBER_BYTES = 1 << 30

# Output batches of the archive reader close at either bound.
BATCH_BYTES = 16 << 20
BATCH_ROWS = 1000

ARCHIVE_TYPES = (V.ZIP, V.OOXML, V.DOCX, V.XLSX, V.PPTX, V.EPUB)
OOXML_TYPES = (V.OOXML, V.DOCX, V.XLSX, V.PPTX)
MARKUP_TYPES = (V.TEXT_HTML, V.XHTML)

# Children of one root are listed by this many at a time.
BLOCK_SIZE = 1000

LEVEL_COLUMNS = ["root_id", "root_no", "depth", "ord_path", "parent_name", "parent_type", "name", "relationship_id", "media_type",
                 "charset", "content", "error"]
GIVEN = {"name", "relationship_id", "media_type", "charset", "error", "ord"}


def _explode_parts(df: DataFrame, parts: Column, keep: list[str]) -> DataFrame:
    exploded = df.select(*keep, F.posexplode(parts).alias("ord", "part"))
    return exploded.select(*keep, "ord", "part.name", "part.relationship_id", "part.media_type", "part.charset", "part.content",
                           F.lit(None).cast(ERROR_TYPE).alias("error"))


def unpack_message(df: DataFrame, content: str = "content") -> DataFrame:
    """MIME parts as child rows, decoded and numbered from 0."""
    keep = [c for c in df.columns if c not in GIVEN | {content}]
    return _explode_parts(df, mime_parts(F.col(content)), keep)


def unpack_html(df: DataFrame, content: str = "content") -> DataFrame:
    """Inline scripts, style sheets and data URIs as child rows."""
    html = F.col(content) if dict(df.dtypes)[content] == "string" else decode_text(F.col(content))
    keep = [c for c in df.columns if c not in GIVEN | {content}]
    return _explode_parts(df, html_embedded(html), keep)


def _zip_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of each archive in output batches of bounded rows and bytes."""
    for batch in batches:
        fixed = [c for c in batch.columns if c != "content"]
        columns = [*fixed, "ord", "name", "content", "error"]
        rows, size = [], 0
        for *base, blob in batch[[*fixed, "content"]].itertuples(index=False, name=None):
            for ord_, name, data, message in _members_of(blob):
                error = None if message is None else {"error_class": V.PARSE_ERROR, "message": message}
                rows.append((*base, ord_, name, data, error))
                size += len(data or b"")
                if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)


def _members_of(blob: bytes) -> Iterator[tuple[int, str | None, bytes | None, str | None]]:
    broken = (zipfile.BadZipFile, NotImplementedError, RuntimeError, OSError, EOFError, ValueError, zlib.error)
    try:
        archive = zipfile.ZipFile(io.BytesIO(blob))
    except broken as e:
        yield 0, None, None, f"broken archive: {e}"
        return
    with archive:
        for i, info in enumerate(m for m in archive.infolist() if not m.is_dir()):
            try:
                with archive.open(info) as member:
                    data = member.read(MAX_MEMBER_BYTES + 1)
            except broken as e:
                yield i, info.filename, None, f"broken member: {e}"
                continue
            if len(data) > MAX_MEMBER_BYTES:
                yield i, info.filename, None, f"member over {MAX_MEMBER_BYTES} bytes"
            else:
                yield i, info.filename, data, None


def unpack_archive(df: DataFrame, content: str = "content") -> DataFrame:
    """ZIP members as child rows; a broken archive or member gives a row with an ``error``."""
    keep = [c for c in df.columns if c not in GIVEN | {content, "content"}]
    source = df.select(*keep, F.col(content).alias("content")).filter(F.col("content").isNotNull())
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema]
    schema = ", ".join([*fields, "ord int", "name string", "content binary", f"error {ERROR_TYPE}"])
    members = source.mapInPandas(_zip_members, schema)
    missing = F.lit(None).cast("string")
    return members.select(*keep, "ord", "name", missing.alias("relationship_id"), missing.alias("media_type"),
                          missing.alias("charset"), "content", "error")


def _is_package_part(name: Column) -> Column:
    """Members that make up an Office package itself: its XML parts, outside the folders for embedded files."""
    return name.rlike(r"(?i)\.(?:xml|rels|vml)$") & ~name.rlike(r"(?i)/(?:media|embeddings)/[^/]+$")


def _container_kind(media_type: Column) -> Column:
    """How a document is opened, NULL for one without children."""
    kinds = {t: "archive" for t in ARCHIVE_TYPES} | {t: "office" for t in OOXML_TYPES}
    kinds |= {t: "markup" for t in MARKUP_TYPES} | {V.MESSAGE: "mail"}
    multipart = F.regexp_replace(media_type, "^multipart/.*$", V.MESSAGE)
    return lookup(kinds, multipart)


def is_container(media_type: Column) -> Column:
    """Whether documents of this type may have embedded ones."""
    return _container_kind(media_type).isNotNull()


def _level_columns(custom_detectors: Sequence[Detector] = (), rules: Sequence[MagicRule] | None = None,
                   globs: Sequence[tuple[str, Sequence[str]]] | None = None, supertypes: Mapping[str, str] | None = None,
                   magic: Column | None = None) -> tuple[Column, Column]:
    """(parts of a message or page, media type of a child): the same for every level."""
    is_mail = F.col("_kind") == "mail"
    # One explode serves both kinds that are opened by expressions.
    parts = F.when(is_mail, mime_parts(F.col("content"))).otherwise(html_embedded(decode_text(F.col("content"))))
    # A declared multipart type must survive: its own lines do not look like a message.
    declared = F.when(F.col("media_type").rlike("^multipart/|^text/html$|^message/rfc822$"), F.col("media_type"))
    return parts, media_type_column(F.col("content"), F.col("name"), declared, custom_detectors, rules, globs, supertypes, magic)


def _next_level(frontier: DataFrame, parts: Column, detected: Column, rules: Sequence[MagicRule] | None = None) -> DataFrame:
    """Children of one level. Each branch filters on the type before it opens the content."""
    # One column tells how to open a row. Catalyst copies it into each filter, so the
    # filters read it once instead of naming the detected type several times.
    base = frontier.select(
        "root_id", "root_no", F.col("depth").alias("_depth"), F.col("ord_path").alias("_path"),
        F.col("name").alias("parent_name"), F.col("media_type").alias("parent_type"), "content",
        _container_kind(F.col("media_type")).alias("_kind"),
    )
    keep = ["root_id", "root_no", "_depth", "_path", "parent_name", "parent_type", "_kind"]
    marked_up = _explode_parts(base.filter(F.col("_kind").isin("mail", "markup")), parts, keep)
    in_office = F.col("_kind") == "office"
    archived = unpack_archive(base.filter(F.col("_kind").isin("archive", "office"))).filter(
        ~(in_office & _is_package_part(F.col("name"))) | F.col("name").isNull()
    )
    members = archived.withColumn(
        "name", F.when(in_office, F.regexp_extract("name", r"([^/]+)$", 1)).otherwise(F.col("name"))
    )
    children = with_magic(marked_up.unionByName(members), "content", rules)[0].select(
        "root_id", "root_no",
        (F.col("_depth") + 1).alias("depth"),
        F.concat("_path", F.array("ord")).alias("ord_path"),
        "parent_name", "parent_type", "name", "relationship_id",
        detected.alias("detected"),
        F.col("media_type").alias("declared"), "charset", "content", "error",
    )
    generic = F.col("detected").isin(V.OCTET_STREAM, V.TEXT_PLAIN)
    return children.withColumn(
        "media_type", F.when(generic, F.coalesce("declared", "detected")).otherwise(F.col("detected"))
    ).select(*LEVEL_COLUMNS)


def unpack_documents(df: DataFrame, max_depth: int = 1, id_col: str = "doc_id", content: str = "content",
                     name: str | None = None, hint: str | None = None, root_no: str | None = None, custom_detectors: Sequence[Detector] = (),
                     rules: Sequence[MagicRule] | None = None, globs: Sequence[tuple[str, Sequence[str]]] | None = None,
                     supertypes: Mapping[str, str] | None = None) -> DataFrame:
    """All embedded documents down to ``max_depth``; depth 1 is the top-level children.

    Level by level: each level is written once and read back with its columns pruned, so a
    deep archive never opens its roots again and a lost executor costs one level at most.
    ``root_no`` tells roots apart whose ids are equal or NULL: a given column of written numbers, or one made here.
    """
    if max_depth < 0:
        raise ValueError(f"{V.INVALID_ARGUMENT}: max_depth must not be negative")
    missing = F.lit(None).cast("string")
    df, magic = with_magic(df, content, rules)
    detection = (custom_detectors, rules, globs, supertypes)
    media_type = media_type_column(F.col(content), F.col(name) if name else None, F.col(hint) if hint else None, *detection, magic)
    frontier = df.filter(F.col(content).isNotNull()).select(
        F.col(id_col).alias("root_id"),
        (F.col(root_no) if root_no else F.monotonically_increasing_id()).alias("root_no"),
        F.lit(0).alias("depth"),
        F.array().cast("array<int>").alias("ord_path"),
        missing.alias("parent_name"),
        missing.alias("parent_type"),
        (F.col(name) if name else missing).alias("name"),
        missing.alias("relationship_id"),
        media_type.alias("media_type"),
        missing.alias("charset"),
        F.col(content).alias("content"),
        F.lit(None).cast(ERROR_TYPE).alias("error"),
    )
    if max_depth == 0:
        return frontier.limit(0)
    # Children get the column of long rule lists level by level.
    parts, detected = _level_columns(*detection, None if magic is None else F.col("_magic"))
    levels: list[DataFrame] = []
    for depth in range(1, max_depth + 1):
        level = _next_level(frontier, parts, detected, rules)
        if max_depth > 1:
            level = materialize(level, f"unpack-level-{depth}")
            if depth > 1 and level.isEmpty():
                break
        levels.append(level)
        frontier = level.filter(F.col("content").isNotNull())
    result = levels[0]
    for level in levels[1:]:
        result = result.unionByName(level)
    return result


def safe_name(name: Column) -> Column:
    """Relative path that cannot leave the output folder."""
    slashes = F.regexp_replace(F.translate(name, "\\", "/"), r"^(?:[A-Za-z]:)?/+", "")
    segments = F.filter(F.split(slashes, "/"), lambda s: ~s.isin("", ".", ".."))
    return F.nullif(F.array_join(segments, "/"), F.lit(""))


def _error_of(children: DataFrame) -> Column:
    """The error column, or NULL for children that have none."""
    return F.col("error") if "error" in children.columns else F.lit(None).cast(ERROR_TYPE)


def embedded_name(children: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Add ``child_name`` and ``safe_name``: resource name, else relationship id, else ``embedded_<n>``.

    ``n`` counts the children of the root that come before in document order. At
    ``max_depth=1`` that is the child's own position and no row moves. Otherwise only roots
    with an unnamed child are numbered, by :func:`ordinals`, and of the content only that of unnamed
    children takes part. Rows with an ``error`` are no children: they keep the name they
    have, if any, and do not count.
    """
    given = F.coalesce(F.nullif("name", F.lit("")), F.nullif("relationship_id", F.lit("")))
    if "root_no" not in children.columns:
        # Children from elsewhere are told apart by the id alone.
        return embedded_name(children.withColumn("root_no", F.xxhash64("root_id")), max_depth).drop("root_no")
    named = children.withColumn("child_name", given)
    if max_depth == 1:
        # Parts without a name come from messages and pages, whose positions have no gaps.
        position = F.concat(F.lit("embedded_"), F.element_at("ord_path", 1).cast("string"))
        return _with_safe_name(named.withColumn(
            "child_name", F.when(_error_of(named).isNull(), F.coalesce("child_name", position)).otherwise(given)))
    return _with_safe_name(_number_unnamed(named))


def ordinals(keys: DataFrame) -> DataFrame:
    """(root_no, ord_path, n): the place of every row among its root's in document order, from 0.

    The rows are dealt by ranges of (root, place), counted per range and root, and ranked inside a range; the counts of
    the ranges before are added. So no task sorts a root, however many children it has and wherever they hang.
    """
    ranged = keys.select("root_no", "ord_path").repartitionByRange("root_no", "ord_path")
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("root_no", "range").agg(F.count("*").alias("size"))
    # One row per range that a root reaches into.
    before = Window.partitionBy("root_no").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("root_no", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("root_no", "range").orderBy("ord_path")) - 1
    return ranged.join(offsets, ["root_no", "range"]).select("root_no", "ord_path", (F.col("offset") + rank).alias("n"))


def _number_unnamed(named: DataFrame) -> DataFrame:
    error = _error_of(named)
    sound = named.filter(error.isNull())
    # Only roots with an unnamed child are numbered.
    wanted = sound.filter(F.col("child_name").isNull()).select("root_no").distinct()
    numbers = ordinals(sound.select("root_no", "ord_path").join(wanted, "root_no", "left_semi"))
    fallback = (
        sound.filter(F.col("child_name").isNull()).join(numbers, ["root_no", "ord_path"])
        .withColumn("child_name", F.concat(F.lit("embedded_"), F.col("n").cast("string"))).drop("n")
    )
    return named.filter(F.col("child_name").isNotNull() | error.isNotNull()).unionByName(fallback)


def _with_safe_name(named: DataFrame) -> DataFrame:
    return named.withColumn("safe_name", F.coalesce(
        safe_name(F.col("child_name")),
        F.concat(F.lit("embedded_"), F.array_join(F.col("ord_path").cast("array<string>"), "_")),
    ))


def describe_embedded(named: DataFrame) -> DataFrame:
    """Add the raw and the normalised metadata of each child."""
    raw = M.merge_entries(
        M.file_fields(F.col("child_name"), F.octet_length("content"), F.col("media_type"),
                      F.lit(None).cast("string"), F.lit(None).cast("string")),
        M.entries_of([(V.EMBEDDED_DEPTH, F.col("depth")), (V.EMBEDDED_RELATIONSHIP_ID, F.col("relationship_id"))]),
    )
    return named.withColumn("raw_metadata", raw).withColumn("metadata", M.normalized("raw_metadata"))


def unpack_result(roots: DataFrame, children: DataFrame, id_col: str = "doc_id",
                  metadata: str = "metadata") -> DataFrame:
    """Root metadata with the list of its embedded documents; a leaf file has an empty list.

    Items carry the metadata of :func:`describe_embedded` where the children have it. The list
    is cut into blocks of ``BLOCK_SIZE`` items in document order, ``block_no`` 0, 1, …, so no cell
    holds more than a block, however deep the items are nested; the blocks come from :func:`ordinals`, so no
    task holds a root. Rows with an ``error`` stand apart in ``embedded_errors`` of their block. Content stays in the
    children table. Where both tables have ``root_no``, roots are told apart by it, whatever their ids.
    """
    described = [c for c in ("raw_metadata", "metadata") if c in children.columns]
    numbered = "root_no" in children.columns and "root_no" in roots.columns
    number = F.col("root_no") if "root_no" in children.columns else F.xxhash64("root_id")
    rows = children.select(
        "root_id", number.alias("root_no"), "ord_path", _error_of(children).alias("_error"),
        F.struct("ord_path", "child_name", "safe_name", "depth", "media_type", *described).alias("_item"))
    ranked = rows.join(ordinals(rows), ["root_no", "ord_path"]).withColumn("block_no", F.floor(F.col("n") / BLOCK_SIZE).cast("int"))
    sound = F.when(F.col("_error").isNull(), F.struct(F.col("ord_path").alias("at"), F.col("_item").alias("item")))
    bad = F.when(F.col("_error").isNotNull(), F.struct("ord_path", F.col("_item.child_name"), F.col("_error").alias("error")))

    def first(left: Column, right: Column) -> Column:
        before, after = left["at"] < right["at"], left["at"] > right["at"]
        return F.when(before, -1).when(after, 1).otherwise(0)

    lists = ranked.groupBy("root_id", "root_no", "block_no").agg(
        F.transform(F.array_sort(F.collect_list(sound), first), lambda x: x["item"]).alias("embedded_documents"),
        F.array_sort(F.collect_list(bad)).alias("embedded_errors"),
    )

    def or_empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast(lists.schema[name].dataType)).alias(name)

    extra = [c for c in ("root_error",) if c in roots.columns]
    key, of_list = ("root_no", "root_no") if numbered else (id_col, "root_id")
    given = roots.select(F.col(id_col).alias("_id"), F.col(key).alias("_key"), F.col(metadata).alias("root_metadata"), *extra)
    return (
        given.join(lists, F.col("_key").eqNullSafe(F.col(of_list)), "left")
        .select(F.col("_id").alias("root_id"), "root_metadata", *extra, F.coalesce("block_no", F.lit(0)).alias("block_no"),
                or_empty("embedded_documents"), or_empty("embedded_errors"))
    )


def rolled_up_text(children: DataFrame, text: str = "text") -> DataFrame:
    """(root_no, text): the texts of a root's embedded documents, one after the other in document order.

    From the deepest level up, a document's text is its own and then those of the documents in it. Siblings are joined
    in blocks of ``BLOCK_SIZE`` first, so that a document with very many is spread over tasks; empty texts are left out.
    """
    rows = materialize(children.select(
        "root_no", "ord_path", F.size("ord_path").alias("depth"), F.nullif(F.col(text), F.lit("")).alias("text")), "texts")
    deepest = rows.agg(F.max("depth")).first()[0] or 1

    def joined(pairs: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(pairs)), lambda x: x["text"]), "\n").alias("text")

    below = None
    for depth in range(deepest, 0, -1):
        level = rows.where(F.col("depth") == depth)
        if below is not None:
            under = below.select("root_no", F.col("parent").alias("ord_path"), F.col("text").alias("under"))
            level = level.join(under, ["root_no", "ord_path"], "left").withColumn("text", F.nullif(F.concat_ws("\n", "text", "under"), F.lit("")))
        place = F.element_at("ord_path", -1)
        placed = level.where("text IS NOT NULL").select(
            "root_no", F.slice("ord_path", 1, depth - 1).alias("parent"), F.floor(place / BLOCK_SIZE).alias("block"),
            F.struct(place.alias("at"), "text").alias("item"))
        blocks = placed.groupBy("root_no", "parent", "block").agg(joined("item"))
        below = materialize(
            blocks.groupBy("root_no", "parent").agg(F.collect_list(F.struct(F.col("block").alias("at"), "text")).alias("items")).select(
                "root_no", "parent", F.array_join(F.transform(F.array_sort("items"), lambda x: x["text"]), "\n").alias("text")), "rolled")
    return below.select("root_no", "text")
