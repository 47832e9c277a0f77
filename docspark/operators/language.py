"""Language identification with trigram profiles learned from a labelled table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark import fixed_values as V
from docspark.functions.language import fold_letters, ngrams
from docspark.session import BROADCAST_ROW_LIMIT, broadcast_if_small, materialize

# Log probabilities are kept as whole millionths: their sums are exact in any order.
WEIGHT_SCALE = 1_000_000

# Language codes are a small closed set; the wide profile has one column for each.
MAX_LANGUAGES = 1000


# A task counts the grams of so many characters at once, and passes on its counts when it holds so many.
COUNTED_CHARS, HELD_GRAMS = 4_000_000, 1_000_000

# Gram of the row that carries a language's weight for grams it was never seen with.
UNSEEN = ""


def train_language_profiles(df: DataFrame, text: str = "text", lang: str = "lang", n: int = 3) -> DataFrame:
    """(lang, gram, weight): add-one smoothed log probabilities of the grams of each language.

    A language has a row per gram it was seen with, and one row with an empty gram for all
    others, so the table does not grow with languages times vocabulary. Grams are counted
    before the shuffle, so it carries one row per (gram, lang) and task whatever the share
    of one language. The counts are written once, because three aggregates read them.
    """
    labelled = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = materialize(
        _partial_counts(labelled.select(F.col(lang).alias("lang"), fold_letters(F.col(text)).alias("text")), n)
        .groupBy("gram", "lang").agg(F.sum("n").alias("n")),
        "gram-counts",
    )
    vocabulary = counts.groupBy("gram").agg(F.lit(1)).agg(F.count("*").alias("vocabulary"))
    totals = counts.groupBy("lang").agg((F.sum("n") + vocabulary.scalar()).alias("total"))
    unseen = totals.select("lang", F.lit(UNSEEN).alias("gram"), F.lit(0).cast("bigint").alias("n"))
    # One row per language: a broadcast, or all grams would meet on a handful of keys.
    weight = F.round(F.log((F.col("n") + 1) / F.col("total")) * WEIGHT_SCALE).cast("bigint")
    return (
        counts.select("lang", "gram", "n").unionByName(unseen).join(F.broadcast(totals), "lang")
        .select("lang", "gram", weight.alias("weight"))
    )


def _partial_counts(folded: DataFrame, n: int) -> DataFrame:
    """(lang, gram, n) of folded texts (lang, text): grams of many texts are counted at once, in each task for itself."""
    kind = folded.schema["lang"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[object, list[str]] = {}
        found: dict[object, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = size = 0

        def count() -> int:
            for lang, own in texts.items():
                found[lang] = [_summed([*found.get(lang, []), _gram_counts(own, n)])]
            texts.clear()
            return sum(len(keys) for [(keys, _)] in found.values())

        def counted(schema: pa.Schema) -> Iterator[pa.RecordBatch]:
            for lang, [(keys, counts)] in found.items():
                grams = pa.array(_gram_texts(keys, n), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), schema.field(0).type), grams, pa.array(counts)], names=["lang", "gram", "n"])
            found.clear()

        schema = None
        for batch in batches:
            schema = batch.schema
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
                held += len(text)
                if held >= COUNTED_CHARS:
                    held, size = 0, count()
                if size >= HELD_GRAMS:
                    yield from counted(schema)
                    size = 0
        if schema is not None:
            count()
            yield from counted(schema)

    return folded.mapInArrow(run, f"lang {kind}, gram string, n bigint")


def _gram_counts(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the texts, as numbers or, beyond 3 code points, as texts, and their counts."""
    # Folded texts hold letters and ``_`` alone, so a zero parts them.
    chars = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(chars) < n:
        return np.zeros(0, np.uint64 if n <= 3 else f"<U{n}"), np.zeros(0, np.int64)
    letter = chars != 0
    whole = np.logical_and.reduce([letter[i:len(chars) - n + 1 + i] for i in range(n)])
    if n <= 3:
        keys = _codes(chars.astype(np.uint64), n)[whole]
    else:
        keys = np.lib.stride_tricks.sliding_window_view(chars, n)[whole].view(f"<U{n}").ravel()
    return np.unique(keys, return_counts=True)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal grams added up."""
    if len(parts) == 1:
        return parts[0]
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    keys, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, counts)
    return keys, sums


def _gram_texts(keys: np.ndarray, n: int) -> list[str]:
    """The grams that :func:`_gram_counts` numbered."""
    if n > 3:
        return keys.tolist()
    chars = np.stack([(keys >> np.uint64(21 * i)) & np.uint64(0x1FFFFF) for i in range(n - 1, -1, -1)], axis=1)
    text = chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [text[i:i + n] for i in range(0, len(text), n)]


def _unseen_weights(profiles: DataFrame) -> dict[str, int]:
    """Languages of the profiles in code order, with their weight for unseen grams."""
    rows = profiles.filter(F.col("gram") == UNSEEN).select("lang", "weight").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language codes: these are no language profiles")
    return dict(sorted((r["lang"], r["weight"]) for r in rows))


def _wide(profiles: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row per gram with a weight column ``_w<i>`` per language in the order of the codes."""
    unseen = _unseen_weights(profiles)
    weights = [
        F.coalesce(F.max(F.when(F.col("lang") == code, F.col("weight"))), F.lit(floor).cast("bigint")).alias(f"_w{i}")
        for i, (code, floor) in enumerate(unseen.items())
    ]
    return profiles.filter(F.col("gram") != UNSEEN).groupBy("gram").agg(*weights), list(unseen)


def gram_length(profiles: DataFrame) -> int:
    """Length of the profiles' grams: profiles say by themselves how they were trained."""
    row = profiles.filter(F.col("gram") != UNSEEN).select(F.length("gram").alias("n")).first()
    return row["n"] if row else 3


def _codes(chars: np.ndarray, n: int) -> np.ndarray:
    """One number for each run of ``n`` code points. Up to 3 they are packed, beyond that mixed to 64 bits."""
    codes = np.zeros(len(chars) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            part = chars[i:len(chars) - n + 1 + i]
            codes = (codes << np.uint64(21)) | part if n <= 3 else (codes ^ part) * np.uint64(0x9E3779B97F4A7C15)
    return codes


def _batch_scores(texts: list[str], keys: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Summed weights of each text per language. The grams of all texts are looked up at once."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sums = np.zeros((len(texts), weights.shape[1]), np.int64)
    lengths = np.array([len(p) for p in parts])
    chars = np.concatenate(parts).astype(np.uint64) if parts else np.zeros(0, np.uint64)
    if len(chars) < n or not len(keys):
        return sums
    grams = _codes(chars, n)
    doc = np.repeat(np.arange(len(texts)), lengths)
    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
    # A gram counts when all its characters are of one text and it is in the profile.
    hit = np.flatnonzero((doc[:len(grams)] == doc[n - 1:]) & (keys[at] == grams))
    if len(hit):
        starts = np.flatnonzero(np.append(True, np.diff(doc[hit]) > 0))
        owner = doc[hit][starts]
        for i in range(weights.shape[1]):
            sums[owner, i] = np.add.reduceat(weights[at[hit], i], starts)
    return sums


def _dense_model(profiles: DataFrame, limit: int) -> tuple[list[str], np.ndarray, np.ndarray, int] | None:
    """Languages, sorted gram codes, weights and gram length; NULL for large profiles.

    The profile is counted first and read only when it has at most ``limit`` rows and at most as
    many weights (grams times languages).
    """
    unseen = _unseen_weights(profiles)
    n = gram_length(profiles)
    rows = profiles.filter(F.col("gram") != UNSEEN).select("lang", "gram", "weight").limit(limit + 1).toPandas()
    if len(rows) > limit or rows["gram"].nunique() * len(unseen) > limit:
        return None
    languages = list(unseen)
    table = rows.pivot(index="gram", columns="lang", values="weight").reindex(columns=languages).fillna(unseen)
    codes = np.array([_codes(np.array([ord(c) for c in g], np.uint64), n)[0] for g in table.index], np.uint64)
    order = np.argsort(codes)
    return languages, codes[order], table.to_numpy(dtype=np.int64)[order], n


def _sums_column(model: Broadcast, folded: Column) -> Column:
    """Summed weights per language of a folded text, NULL for a NULL text."""
    @F.pandas_udf("array<bigint>")
    def sums(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, keys, weights, n = model.value
        for batch in batches:
            known = batch.notna().to_numpy()
            out = pd.Series([None] * len(batch), dtype=object)
            found = iter(_batch_scores(batch[known].tolist(), keys, weights, n))
            yield pd.Series([next(found) if k else None for k in known], dtype=object) if known.any() else out

    return sums(folded)


def score_languages(df: DataFrame, profiles: DataFrame, id_cols: list[str], text: str = "text",
                    limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Id columns, ``blank``, the ``languages`` of the profiles and the summed ``weights`` of each, per row.

    Up to ``limit`` weights the profile is a broadcast and each row is scored where it is, a batch at
    a time. Beyond it, each gram meets one profile row that carries all languages; the sums are partial
    before the shuffle, which moves about one row per document, and never the text. There every row
    has a generated key, so that rows with equal or NULL ids stay apart as well.
    """
    blank = F.coalesce(~F.col(text).rlike(r"\S"), F.lit(True)).alias("blank")
    model = _dense_model(profiles, limit)
    if model:
        names = F.array(*[F.lit(code) for code in model[0]]).cast("array<string>")
        shared = profiles.sparkSession.sparkContext.broadcast(model)
        # Everything later reads the sums alone: naming the text again would repeat what makes it.
        sums = _sums_column(shared, F.when(~F.coalesce(~F.col(text).rlike(r"\S"), F.lit(True)), fold_letters(F.col(text))))
        scored = df.select(*id_cols, names.alias("languages"), sums.alias("weights"))
        return scored.withColumn("blank", F.col("weights").isNull())
    wide, languages = _wide(profiles)
    wide = broadcast_if_small(materialize(wide, "wide-profiles"))
    keyed = materialize(df.select(F.monotonically_increasing_id().alias("_row"), *dict.fromkeys([*id_cols, text])), "keyed")
    # The flag is computed before the explode: beside it, it would run once for every gram.
    exploded = keyed.select("_row", blank, ngrams(F.col(text), gram_length(profiles)).alias("grams")).select(
        "_row", "blank", F.explode_outer("grams").alias("gram")
    )
    sums = [F.coalesce(F.sum(f"_w{i}"), F.lit(0)).alias(f"_w{i}") for i in range(len(languages))]
    scored = exploded.join(wide, "gram", "left").groupBy("_row", "blank").agg(*sums).select(
        "_row", "blank", F.array(*[F.lit(code) for code in languages]).alias("languages"),
        F.array(*[f"_w{i}" for i in range(len(languages))]).alias("weights"))
    return keyed.select("_row", *id_cols).join(scored, "_row").drop("_row")


def detect_language(df: DataFrame, profiles: DataFrame, id_cols: list[str] | str = "doc_id",
                    text: str = "text", limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Best language per row and its margin to each language. ``profiles`` should be a written table."""
    id_cols = [id_cols] if isinstance(id_cols, str) else id_cols
    scored = score_languages(df, profiles, id_cols, text, limit)
    best = F.array_max("weights")
    # Equal weights go to the first language code.
    first = F.element_at("languages", F.array_position("weights", F.col("best")).cast("int"))
    scored = scored.withColumn("best", best)
    return scored.select(
        *id_cols,
        F.when(~F.col("blank"), first).alias("language"),
        F.when(~F.col("blank"), F.col("best")).alias("log_weight"),
        F.transform("weights", lambda w: w - F.col("best")).alias("margins"),
    )


def confidence_level(score: Column) -> Column:
    return (
        F.when(score.isNull(), "NONE")
        .when(score >= V.CONFIDENCE_HIGH, "HIGH")
        .when(score >= V.CONFIDENCE_MEDIUM, "MEDIUM")
        .otherwise("LOW")
    )


def language_confidence(df: DataFrame) -> DataFrame:
    """Turn the margins of :func:`detect_language` into ``raw_score`` and ``confidence``."""
    total = F.aggregate(
        "margins", F.lit(0.0),
        lambda acc, m: acc + F.exp(m.cast("double") / F.lit(float(WEIGHT_SCALE))),
    )
    score = F.when(F.col("language").isNotNull(), F.round(F.lit(1.0) / total, 6))
    return (
        df.withColumn("raw_score", score)
        .withColumn("confidence", confidence_level(F.col("raw_score")))
        .drop("margins")
    )


def with_language(df: DataFrame, profiles: DataFrame, id_cols: list[str], text: str = "text",
                  limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Add ``language, raw_score, confidence`` to every row, in the plan that :func:`score_languages` picks.

    ``id_cols`` only name the rows and decide nothing.
    """
    named = [c for c in df.columns if c not in ("language", "raw_score", "confidence")]
    # The text is scored beside the other columns, which pass through.
    found = detect_language(df, profiles, named, text, limit)
    return language_confidence(found).drop("log_weight")
