"""Media-type detection over a DataFrame of documents. Every operator here is narrow."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions import media
from docspark.operators.errors import make_error

# A detector maps (content, name) to a media type; NULL or octet-stream means no opinion.
Detector = Callable[[Column, Column], Column]

# Longer rule lists become broadcast joins instead of one CASE.
CASE_RULE_LIMIT = 200


def detect_magic(df: DataFrame, content: str = "content", rules: Sequence[media.MagicRule] | None = None,
                 output: str = "magic_type") -> DataFrame:
    """Media type by signature at fixed offsets of the content."""
    rules = V.MAGIC if rules is None else list(rules)
    if len(rules) <= CASE_RULE_LIMIT:
        return df.withColumn(output, media.magic_type(F.col(content), rules))
    return _detect_magic_by_join(df, content, rules, output)


def _detect_magic_by_join(df: DataFrame, content: str, rules: Sequence[media.MagicRule],
                          output: str) -> DataFrame:
    """One hash join per signature shape (offset, length), then the best priority per row.

    The rules come from the driver as a Python list, so the broadcast sides are bounded.
    """
    shapes: dict[tuple[int, int], list[tuple[bytes, int, str, int]]] = {}
    composed = []
    for order, (signature, media_type, priority) in enumerate(rules):
        tests = media.parse_signature(signature)
        if len(tests) > 1:
            composed.append((signature, media_type, priority))
            continue
        offset, magic = tests[0]
        shapes.setdefault((offset, len(magic)), []).append((magic, priority, media_type, -order))
    hits = []
    for i, ((offset, length), rows) in enumerate(sorted(shapes.items())):
        best: dict[bytes, tuple[int, int, str]] = {}
        for magic, priority, media_type, order in rows:
            best[magic] = max(best.get(magic, (priority, order, media_type)), (priority, order, media_type))
        table = df.sparkSession.createDataFrame(
            [(m, p, o, t) for m, (p, o, t) in best.items()],
            f"_magic{i} binary, _p{i} int, _o{i} int, _t{i} string",
        )
        key = F.substring(F.col(content), offset + 1, length)
        df = df.join(F.broadcast(table), key == F.col(f"_magic{i}"), "left")
        hits.append(F.when(F.col(f"_p{i}").isNotNull(),
                           F.struct(F.col(f"_p{i}").alias("p"), F.col(f"_o{i}").alias("o"),
                                    F.col(f"_t{i}").alias("t"))))
    for signature, media_type, priority in composed:
        order = -list(rules).index((signature, media_type, priority))
        test = media.magic_type(F.col(content), [(signature, media_type, priority)])
        hits.append(F.when(test.isNotNull(), F.struct(F.lit(priority).alias("p"), F.lit(order).alias("o"),
                                                      test.alias("t"))))
    best_hit = F.array_max(F.filter(F.array(*hits), lambda h: h.isNotNull()))["t"]
    drop = [f"{c}{i}" for i in range(len(shapes)) for c in ("_magic", "_p", "_o", "_t")]
    return df.withColumn(output, best_hit).drop(*drop)


def detect_glob(df: DataFrame, name: str = "path", globs: Sequence[tuple[str, Sequence[str]]] | None = None,
                output: str = "glob_type") -> DataFrame:
    """Media type by file extension. Reads the name alone, so content stays out of the scan."""
    return df.withColumn(output, media.glob_type(F.col(name), V.GLOBS if globs is None else globs))


def sniff_text(df: DataFrame, content: str = "content", output: str = "sniff_type") -> DataFrame:
    return df.withColumn(output, media.sniff_type(F.col(content)))


def refine_container(df: DataFrame, content: str = "content", output: str = "container_type") -> DataFrame:
    return df.withColumn(output, media.container_type(F.col(content)))


def resolve_media_type(df: DataFrame, candidates: Sequence[str], output: str = "media_type",
                       supertypes: Mapping[str, str] | None = None) -> DataFrame:
    return df.withColumn(output, media.fold_types(*[F.col(c) for c in candidates], supertypes=supertypes))


def with_magic(df: DataFrame, content: str, rules: Sequence[media.MagicRule] | None) -> tuple[DataFrame, Column | None]:
    """``df`` with the column ``_magic`` where the rules are too many for one CASE, and that column."""
    if rules is None or len(rules) <= CASE_RULE_LIMIT:
        return df, None
    return detect_magic(df, content, rules, "_magic"), F.col("_magic")


def override_media_type(df: DataFrame, hint: str, detected: str = "media_type",
                        output: str = "media_type") -> DataFrame:
    """A caller-given type replaces the detected one and is kept as ``media_type_override``."""
    given = F.nullif(F.trim(F.col(hint)), F.lit(""))
    return df.withColumn("media_type_override", given).withColumn(output, F.coalesce(given, F.col(detected)))


def media_type_column(content: Column, name: Column | None = None, hint: Column | None = None,
                      custom_detectors: Sequence[Detector] = (),
                      rules: Sequence[media.MagicRule] | None = None,
                      globs: Sequence[tuple[str, Sequence[str]]] | None = None,
                      supertypes: Mapping[str, str] | None = None, magic: Column | None = None) -> Column:
    """Detected media type as one column: hint, else the fold of all detectors in order.

    Custom detectors come first. Content is sniffed where no signature matched, and the
    name comes last, so that it can specialise what the content says but not contradict it.
    ``supertypes`` places types of the user in the hierarchy; ``magic`` is the column of :func:`with_magic`.
    """
    no_name = F.lit(None).cast("string")
    name = no_name if name is None else name
    if magic is None:
        magic = media.magic_type(content, V.MAGIC if rules is None else rules)
    content_types = F.coalesce(magic, media.sniff_type(content))
    custom = [detector(content, name) for detector in custom_detectors]
    # ZIP members are searched only behind a ZIP signature.
    container = F.when(magic == V.ZIP, media.container_type(content))
    by_name = media.glob_type(name, V.GLOBS if globs is None else globs)
    detected = media.fold_types(*custom, content_types, container, by_name, supertypes=supertypes)
    return detected if hint is None else F.coalesce(F.nullif(F.trim(hint), F.lit("")), detected)


def detect_media_type(df: DataFrame, content: str = "content", name: str | None = None,
                      hint: str | None = None, custom_detectors: Sequence[Detector] = (),
                      rules: Sequence[media.MagicRule] | None = None,
                      output: str = "media_type", globs: Sequence[tuple[str, Sequence[str]]] | None = None,
                      supertypes: Mapping[str, str] | None = None) -> DataFrame:
    """Media type from custom detectors, content and name; a hint overrides them all."""
    df, magic = with_magic(df, content, rules)
    return df.withColumn(output, media_type_column(
        F.col(content), F.col(name) if name else None, F.col(hint) if hint else None,
        custom_detectors, rules, globs, supertypes, magic,
    )).drop("_magic")


def describe_media_types(df: DataFrame, media_type: str = "media_type", supertypes: Mapping[str, str] | None = None) -> DataFrame:
    """Split each type and add its supertype; a name without exactly one ``/`` is an error."""
    value = F.col(media_type)
    parts = F.split(value, "/")
    valid = (F.size(parts) == 2) & (F.element_at(parts, 1) != "") & (F.element_at(parts, -1) != "")
    message = F.concat(F.lit("Invalid media type, expected type/subtype: "), value)
    return df.select(
        "*",
        F.when(valid, parts[0]).alias("top_type"),
        F.when(valid, F.element_at(parts, -1)).alias("sub_type"),
        F.when(valid, media.supertype(value, supertypes)).alias("supertype"),
        F.when(~valid, make_error(V.INVALID_MEDIA_TYPE, message)).alias("error"),
    )


def media_type_registry(spark: SparkSession, custom: Sequence[str] = (), strict: bool = True,
                        supertypes: Mapping[str, str] | None = None) -> DataFrame:
    """Dimension of the known and custom types with their split names and supertype.

    ``supertypes`` is the hierarchy of custom types that detection takes too; its types belong to the custom ones.
    """
    custom = [*custom, *(supertypes or {})]
    names = [V.OCTET_STREAM, *[child for child, _ in V.SUPERTYPES]]
    invalid = [c for c in custom if len(c.split("/")) != 2 or not all(c.split("/"))]
    if strict and invalid:
        raise ValueError(f"{V.INVALID_MEDIA_TYPE}: expected type/subtype, got {invalid}")
    names += [c for c in dict.fromkeys(custom) if c not in names]
    return describe_media_types(spark.createDataFrame([(n,) for n in names], "media_type string"), supertypes=supertypes)
