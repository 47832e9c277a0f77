"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts the n-grams of each language over all training texts. A language's filter holds
all of them, and a second one those whose share of the language is at least ``DOMINANCE`` of their largest
share in any. The filters are stored by slices: one word of language bits per position, so that the AND of
``HASHES`` positions returns every language that contains the n-gram. Spark ORs the bits of each position;
the filters grow with the n-grams of the largest language. A document's popcounts per language in both
filters, less what false positives alone would give, decide.

Cases: null texts and texts without a letter are ``und`` with score 0; texts in which no filter finds
anything get the language with the most training n-grams and score 0; ties go to the smaller name;
without training rows everything is ``und``; texts of any length are read whole; other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docspark.llm.batches import put, steps

GRAM = 4
DOMINANCE = 0.5
HASHES = 3
#: Filter positions per n-gram of the largest filter.
ROOM = 12
#: Languages per slice word.
WORD = 64
UNDETERMINED = "und"
#: Filter positions, as a power of two, that one task fills.
_CHUNK_BITS = 16

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter; built once per worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts in a row, and how many each text has (0 when it has no letter)."""
    is_letter = letters()
    words, lengths = [], []
    for text in texts:
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
        kept = is_letter[points]
        if not kept.any():
            lengths.append(0)
            continue
        points = np.where(kept, points, 32)
        start = np.ones(len(points), bool)
        start[1:] = kept[1:] | kept[:-1]  # one blank for each run of other characters
        points = np.concatenate(([32], points[start], [32] * (GRAM - 1)))
        words.append(points)
        lengths.append(len(points) - GRAM + 1)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    flat = np.concatenate(words).astype(np.uint64)
    codes = np.zeros(len(flat) - GRAM + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(GRAM):
            codes = (codes ^ flat[i:len(flat) - GRAM + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
            codes ^= codes >> np.uint64(29)
    inside = np.ones(len(flat), bool)
    ends = np.cumsum([len(w) for w in words])
    for back in range(1, GRAM):
        inside[ends - back] = False  # n-grams that would run into the next text
    return codes[inside[:len(codes)]], np.array(lengths, np.int64)


def positions(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [(codes * m) >> np.uint64(64 - bits) for m in _MULTIPLIERS[:HASHES]]


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Bit-sliced filters of every language in ``docs`` (rows without ``lang`` are left out)."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

        def rows(name: str) -> pa.RecordBatch:
            codes, counts = merged(held.pop(name))
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(codes), pa.string()), "gram": pa.array(codes.view(np.int64)),
                "n": pa.array(counts)})

        for batch, texts in steps(batches, text, 1_000_000):
            names = batch.column(1).to_pylist()
            for name in sorted(set(names)):
                codes, _ = grams([t for t, n in zip(texts, names) if n == name])
                parts = held.setdefault(name, [])
                parts.append(np.unique(codes, return_counts=True))
                if len(parts) >= 16:
                    parts[:] = [merged(parts)]
                    if len(parts[0][0]) > 1_000_000:  # bounded memory: the rest is summed by the shuffle
                        yield rows(name)
            if len(held) > 64:
                for name in list(held):
                    yield rows(name)
        for name in list(held):
            yield rows(name)

    counted = (docs.where(F.col(lang).isNotNull()).select(text, lang)
               .mapInArrow(count, "lang string, gram bigint, n bigint")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    from docspark.session import materialize

    counted = materialize(counted, "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    names = [r.lang for r in totals.where("total > 0").orderBy("lang").collect()]
    if not names:
        return {"names": []}
    numbers = spark.createDataFrame(list(enumerate(names)), "no int, lang string")
    shares = counted.join(F.broadcast(totals), "lang").join(F.broadcast(numbers), "lang").select(
        "gram", "lang", "no", (F.col("n") / F.col("total")).alias("share"))
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    bit = F.expr(f"shiftleft(1L, no % {WORD})")
    masks = (shares.join(top, "gram").groupBy("gram", F.expr(f"no div {WORD}").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("mask"),
        F.bit_or(F.when(F.col("share") >= DOMINANCE * F.col("top"), bit).otherwise(F.lit(0).cast("bigint"))).alias("strong")))
    largest = {r.lang: (r.total, r.grams) for r in counted.groupBy("lang").agg(
        F.sum("n").alias("total"), F.count("*").alias("grams")).collect()}
    bits = max(10, int(np.ceil(np.log2(max(n for _, n in largest.values()) * ROOM))))
    low = min(bits, _CHUNK_BITS)
    kind = np.uint8 if len(names) <= 8 else np.uint64

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in positions(batch.column(0).to_numpy().view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), pa.array((at >> np.uint64(low)).astype(np.int32)),
                     pa.array((at & np.uint64((1 << low) - 1)).astype(np.int32)), batch.column(2), batch.column(3)],
                    names=["word", "chunk", "at", "mask", "strong"])

    def fill(group: pa.Table) -> pa.Table:
        parts = []
        for name in ("mask", "strong"):
            slots = np.zeros(1 << low, np.uint64)
            np.bitwise_or.at(slots, group["at"].to_numpy(), group[name].to_numpy().view(np.uint64))
            parts.append(pa.array([slots.astype(kind).tobytes()]))
        return pa.table({"word": group["word"][:1], "chunk": group["chunk"][:1], "mask": parts[0], "strong": parts[1]})

    placed = masks.select("gram", "word", "mask", "strong").mapInArrow(
        place, "word int, chunk int, at int, mask bigint, strong bigint")
    filled = placed.groupBy("word", "chunk").applyInArrow(fill, "word int, chunk int, mask binary, strong binary")
    slices = np.zeros((2, -(-len(names) // WORD), 1 << bits), kind)
    for r in filled.toLocalIterator():
        for i, part in enumerate((r["mask"], r["strong"])):
            slices[i, r.word, r.chunk << low:(r.chunk + 1) << low] = np.frombuffer(part, kind)
    share = np.array([[np.count_nonzero(kept[i // WORD] & kind(1 << i % WORD)) / (1 << bits) for i in range(len(names))]
                      for kept in slices])
    return {"names": names, "bits": bits, "slices": slices[0], "dominant": slices[1], "false": share ** HASHES,
            "most": max(names, key=lambda n: largest[n][0])}


def decide(model: dict, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    names = model["names"]
    codes, lengths = grams(texts)
    scores = np.zeros(len(texts))
    if not names or not len(codes):
        return [UNDETERMINED if not n or not names else model["most"] for n in lengths], scores
    full = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[full]
    at = [p.astype(np.int64) for p in positions(codes, model["bits"])]
    shares = np.zeros((len(names), len(starts)))
    for slices, false in zip((model["slices"], model["dominant"]), model["false"]):
        for word, slice_ in enumerate(slices):
            masks = slice_[at[0]]
            for p in at[1:]:
                masks = masks & slice_[p]
            for i in range(word * WORD, min(len(names), (word + 1) * WORD)):
                hits = (masks >> masks.dtype.type(i % WORD)) & masks.dtype.type(1)
                popcount = np.add.reduceat(hits, starts, dtype=np.int64) / lengths[full]
                # What false positives alone would give is taken off.
                shares[i] += np.clip((popcount - false[i]) / (1 - false[i]), 0, None) / 2
    best = shares.argmax(axis=0)
    total = shares.sum(axis=0)
    top = shares.max(axis=0)
    scores[full] = np.divide(top, total, out=np.zeros_like(top), where=total > 0)
    out = [UNDETERMINED] * len(texts)
    for doc, i, sure in zip(np.flatnonzero(full).tolist(), best.tolist(), (total > 0).tolist()):
        out[doc] = names[i] if sure else model["most"]
    return out, scores


def identify(df: DataFrame, model: dict, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Append the language and its share among all languages' corrected shares; one narrow pass."""
    if {lang.lower(), score.lower()} & {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {lang} or {score} already: name others for the output")
    schema = T.StructType([*df.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    arrow = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, text, 1_000_000):
            found, scores = decide(shared.value, texts)
            yield put(batch, arrow, **{lang: pa.array(found, pa.string()), score: pa.array(scores)})

    return df.mapInArrow(run, schema)
