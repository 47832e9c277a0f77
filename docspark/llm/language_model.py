"""Language-model scores from a log-frequency Bloom filter.

Counts of all n-grams of the training texts are quantised by powers of two. An n-gram of level q (its count has q
bits) is put into a Bloom filter q times, as (n-gram, 1) to (n-gram, q); a reader probes level after level until one
is missing, which gives the level and so the count's middle. The filter lies in blocks of ``BLOCK`` bytes, and all
levels of an n-gram in one block, so blocks are built apart from each other, and probed so where needed.

A word's probability mixes its n-gram's share of the context with the probability by one word less, down to single words
with add-one counts: ``(c(h w) + PRIOR * p(w | shorter h)) / (c(h) + PRIOR)``. An n-gram never counts more than its context
or its own ending, which undoes most false positives.

The filter grows with the n-grams of the corpus. Up to ``FILTER_BYTES`` it is broadcast. Beyond, the distinct n-grams of
each portion of texts are sent, packed, to the blocks that hold them and their levels back to the portion; the score
is the same. Exact counts of single words, which the base score needs, come from the same counting: the ``FREQUENT``
most frequent at most are broadcast, and what is rarer is joined by its hash, so no frequent word meets a shuffle.

N-grams are 64-bit hashes. Cases: null and empty texts are the end mark alone; texts of any length are read whole;
without training texts every word is unknown; rows that share an id, have none, or repeat are rows of their own;
other columns pass, and where one has the name of an output, the output's name ends in an underscore.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docspark.llm.batches import free_name, list_array, put, steps
from docspark.session import materialize

#: Words of the longest n-gram.
ORDER = 2
#: Weight of the shorter context, in words.
PRIOR = 20.0
#: Probes per level, and the bits of a level that make half of the filter's bits set.
PROBES = 4
BITS = PROBES / log(2)
BLOCK = 1 << 19
FILTER_BYTES = 64 << 20
FREQUENT = 1 << 20
#: Bytes of text that are counted or scored at once.
STEP_BYTES = 4 << 20

_U = np.uint64
_START, _END = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_MIX, _TURN, _LEVEL = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(32))) * _MIX
        return x ^ (x >> _U(29))


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, a start before and an end after each text, and where each text's part begins."""
    parts, sizes = [], [0]
    for text in texts:
        # bytes.lower touches A-Z alone, and bytes.split knows exactly the blanks that are meant.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        sizes.append(len(words) + 2)
        parts += (_START_LIST, np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words)), _END_LIST)
    return np.concatenate(parts) if parts else np.zeros(0, _U), np.cumsum(sizes)


_START_LIST, _END_LIST = np.array([_START]), np.array([_END])


def ngrams(words: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each size up to ``order``: at each word, the hash of the n-gram that ends there.

    Near the start of a text, where no n-gram of a size fits, the largest that fits stands in its place.
    """
    grams = [words]
    since = np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts))
    for size in range(2, order + 1):
        shorter = np.r_[np.zeros(1, _U), grams[-1][:-1]]
        with np.errstate(over="ignore"):
            longer = _mixed(shorter * _TURN + words + _U(size))
        grams.append(np.where(since >= size - 1, longer, grams[-1]))
    return grams


def _counted(df: DataFrame, order: int) -> DataFrame:
    """(size, h, n): how often each n-gram stands in the texts (text)."""
    kinds = pa.schema([("size", pa.int8()), ("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in steps(batches, "text", STEP_BYTES):
            words, starts = tokens(texts)
            for size, grams in enumerate(ngrams(words, starts, order), 1):
                since = np.arange(len(words)) - np.repeat(starts[:-1], np.diff(starts))
                found, n = np.unique(grams[since >= size - 1], return_counts=True)
                for at in range(0, len(found), 100_000):
                    part = found[at:at + 100_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), size, np.int8)), pa.array(part),
                                                      pa.array(n[at:at + 100_000])], schema=kinds)

    parts = df.select("text").mapInArrow(run, "size tinyint, h bigint, n bigint")
    return parts.groupBy("size", "h").agg(F.sum("n").alias("n"))


def _places(h: np.ndarray, level: int) -> Iterator[np.ndarray]:
    """The bits, inside its block, of a level of each n-gram."""
    with np.errstate(over="ignore"):
        x = _mixed(h ^ (_U(level) * _LEVEL))
        step = _mixed(x + _TURN) | _U(1)
        for _ in range(PROBES):
            yield x & _U(BLOCK * 8 - 1)
            x = x + step


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return h.view(np.int64) % blocks


def fill_block(h: np.ndarray, n: np.ndarray) -> bytes:
    """A block with the levels of its n-grams."""
    levels = np.frexp(n.astype(np.float64))[1]
    bits = np.zeros(BLOCK * 8, np.bool_)
    for level in range(1, int(levels.max()) + 1 if len(levels) else 1):
        for at in _places(h[levels >= level], level):
            bits[at] = True
    return np.packbits(bits, bitorder="little").tobytes()


def levels_in(cells: np.ndarray, h: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Level of each n-gram, 0 for none, by repeated probes of the blocks that begin at ``base``."""
    found = np.zeros(len(h), np.uint8)
    # Portions small enough to stay in the processor's cache.
    for start in range(0, len(h), _PORTION):
        part, own = h[start:start + _PORTION], base[start:start + _PORTION]
        left, level = np.arange(len(part)), 0
        while len(left):
            level += 1
            with np.errstate(over="ignore"):
                at = _mixed(part[left] ^ (_U(level) * _LEVEL))
                step = _mixed(at + _TURN) | _U(1)
                for probe in range(PROBES):
                    bit = at & _U(BLOCK * 8 - 1)
                    held = (cells[own[left] + (bit >> _U(3)).view(np.int64)] >> (bit & _U(7)).astype(np.uint8) & 1).view(np.bool_)
                    # Who misses one probe is out of the further ones.
                    left = left[held]
                    if probe + 1 < PROBES:
                        step = step[held]
                        at = at[held] + step
            found[start + left] = level
    return found


def middle(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level: 0, 1, 2.5, 5.5, …"""
    return _MIDDLES[levels]


_PORTION = 1 << 15
_MIDDLES = np.r_[0.0, (1.5 * np.exp2(np.arange(1, 65)) - 1) / 2]


def probabilities(levels: list[np.ndarray], starts: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 probability of each word after those before it; 0 at the starts of texts."""
    counts = [middle(x) for x in levels]
    for size in range(1, len(counts)):
        # No more than the ending; the context is the n-gram of one word less that ends a word earlier.
        counts[size] = np.minimum(counts[size], counts[size - 1])
    since = np.arange(len(counts[0])) - np.repeat(starts[:-1], np.diff(starts))
    p = (counts[0] + 1) / (total + distinct + 1)
    for size in range(2, len(counts) + 1):
        context = np.r_[0.0, counts[size - 2][:-1]]
        longer = (np.minimum(counts[size - 1], context) + PRIOR * p) / (context + PRIOR)
        p = np.where(since >= size - 1, longer, p)
    return np.where(since > 0, np.log10(p), 0.0)


def train(df: DataFrame, text: str = "text", order: int = ORDER) -> dict:
    """The counted n-grams as written tables, their totals, the filter and the frequent words."""
    counts = materialize(_counted(df.select(F.col(text).alias("text")), order), "ngrams")
    level = F.length(F.bin("n"))
    own = (F.col("size") == 1) & (F.col("h") != int(_START.view(np.int64)))
    row = counts.agg(F.sum(level).alias("items"), F.sum(F.when(own, F.col("n"))).alias("total"),
                     F.count(F.when(own, True)).alias("distinct")).first()
    blocks = max(1, ceil((row.items or 0) * BITS / (8 * BLOCK)))

    def build(key: tuple, group: pa.Table) -> pa.Table:
        h, n = (group.column(c).to_numpy() for c in ("h", "n"))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([fill_block(h.view(_U), n)], pa.binary())})

    table = materialize(counts.select(F.pmod("h", F.lit(blocks)).cast("bigint").alias("block"), "h", "n")
                        .groupBy("block").applyInArrow(build, "block bigint, bits binary"), "filter")
    words = counts.where(own).select("h", "n")
    # The count from which words are frequent: the lowest power of two that few enough reach.
    least, reached = 1, 0
    for r in sorted(words.groupBy(level.alias("q")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r.q):
        reached += r.words
        if reached > FREQUENT:
            least = 1 << r.q
            break
    few = words.where(F.col("n") >= least).toArrow()
    known, n = (few.column(c).to_numpy() for c in ("h", "n"))
    sort = np.argsort(known.view(_U))
    return {"order": order, "blocks": blocks, "filter": table, "total": row.total or 0, "distinct": row.distinct,
            "rare": words.where(F.col("n") < least), "any_rare": row.distinct > len(known),
            "known": known.view(_U)[sort], "n": n[sort]}


def _facts(model: dict, words: np.ndarray, starts: np.ndarray, distinct: np.ndarray, where: np.ndarray) -> tuple[
        np.ndarray, np.ndarray, list[np.ndarray]]:
    """Per text: known frequent words, their sum of log10(c + 1), and the hashes of its other words."""
    at = np.searchsorted(model["known"], distinct).clip(0, max(0, len(model["known"]) - 1))
    hit = model["known"][at] == distinct if len(model["known"]) else np.zeros(len(distinct), np.bool_)
    # The start of a text is no word.
    hit &= distinct != _START
    logs = np.where(hit, np.log10(np.where(hit, model["n"][at] if len(model["n"]) else 0, 0) + 1.0), 0.0)
    known = np.add.reduceat(hit[where].astype(np.int64), starts[:-1])
    base = np.add.reduceat(logs[where], starts[:-1])
    if not model["any_rare"]:
        return known, base, [words[:0]] * (len(starts) - 1)
    other = (~hit & (distinct != _START))[where]
    cuts = np.cumsum(other)[starts[1:-1] - 1]
    return known, base, np.split(words[other], cuts)


_OUT = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]


def score_texts(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None,
                filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Columns ``keep`` (all by default) of the rows of ``df``, and ``n_tokens, n_known, base_score, score, train_tokens``."""
    kept = df.select(*(df.columns if keep is None else keep))
    out = {n: free_name(kept, n) for n in (*[n for n, _ in _OUT], "train_tokens")}
    rest = free_name(df, "rare_words")
    schema = T.StructType([*kept.schema.fields, *[T.StructField(out[n], kind) for n, kind in _OUT], T.StructField(rest, T.ArrayType(T.LongType()))])
    df = df.select(*kept.columns, *([] if text in kept.columns else [text]))
    small = model["blocks"] * BLOCK <= filter_bytes
    scored = (_score_by_broadcast if small else _score_by_shuffle)(df, model, text, schema, rest, out)
    trained = F.lit(model["total"]).cast("bigint").alias(out["train_tokens"])
    if not model["any_rare"]:
        return scored.drop(rest).select("*", trained)
    # Rare words are joined by hash; the written rows keep their numbers.
    number, extra = free_name(df, "row_no"), free_name(df, "rare_sum")
    scored = materialize(scored.withColumn(number, F.monotonically_increasing_id()), "scored")
    rare = scored.select(number, F.explode(rest).alias("h")).join(model["rare"], "h")
    sums = rare.groupBy(number).agg(F.struct(F.count("*").alias("words"), F.sum(F.log10(F.col("n") + 1.0)).alias("logs")).alias(extra))
    joined = scored.drop(rest).join(sums, number, "left").withColumn(
        out["n_known"], F.col(out["n_known"]) + F.coalesce(F.col(extra)["words"], F.lit(0))).withColumn(
        out["base_score"], F.col(out["base_score"]) + F.coalesce(F.col(extra)["logs"], F.lit(0.0)))
    return joined.drop(number, extra).select("*", trained)


def _rows(batch: pa.RecordBatch, model: dict, arrow: pa.Schema, rest: str, out: dict[str, str], words: np.ndarray, starts: np.ndarray,
          levels: list[np.ndarray], distinct: np.ndarray, where: np.ndarray) -> pa.RecordBatch:
    logs = probabilities(levels, starts, model["total"], model["distinct"])
    known, base, others = _facts(model, words, starts, distinct, where)
    size = np.diff(starts) - 1
    base = base - size * np.log10(model["total"] + model["distinct"] + 1.0)
    rare = np.concatenate(others).view(np.int64) if others else np.zeros(0, np.int64)
    return put(batch, arrow, **{
        out["n_tokens"]: pa.array(size, pa.int64()), out["n_known"]: pa.array(known), out["base_score"]: pa.array(base),
        out["score"]: pa.array(np.add.reduceat(logs, starts[:-1])), rest: list_array(rare, [len(x) for x in others], pa.int64())})


def _light(model: dict) -> dict:
    return {k: model[k] for k in ("order", "blocks", "total", "distinct", "any_rare", "known", "n")}


def _score_by_broadcast(df: DataFrame, model: dict, text: str, schema: T.StructType, rest: str,
                        out: dict[str, str]) -> DataFrame:
    spark = df.sparkSession
    cells = np.zeros(model["blocks"] * BLOCK, np.uint8)
    for row in model["filter"].toLocalIterator():
        cells[row.block * BLOCK:(row.block + 1) * BLOCK] = np.frombuffer(row.bits, np.uint8)
    shared = spark.sparkContext.broadcast(_light(model) | {"cells": cells})
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in steps(batches, text, STEP_BYTES):
            words, starts = tokens(texts)
            distinct, where = np.unique(words, return_inverse=True)
            levels = []
            for grams in (distinct, *ngrams(words, starts, model["order"])[1:]):
                levels.append(levels_in(model["cells"], grams, block_of(grams, model["blocks"]) * BLOCK))
            levels[0] = levels[0][where]
            yield _rows(batch, model, arrow, rest, out, words, starts, levels, distinct, where)

    return df.mapInArrow(run, schema)


def _score_by_shuffle(df: DataFrame, model: dict, text: str, schema: T.StructType, rest: str,
                      out: dict[str, str]) -> DataFrame:
    """The same scores without the filter in one place: each portion asks the blocks for its distinct n-grams."""
    spark = df.sparkSession
    portion = free_name(df, "portion")
    order, blocks = model["order"], model["blocks"]
    held = T.StructType([*df.schema.fields, T.StructField(portion, T.LongType())])
    held_arrow = to_arrow_schema(held)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in steps(batches, text, STEP_BYTES):
            own = xxhash.xxh64_intdigest(uuid.uuid4().bytes) >> 1
            yield put(batch, held_arrow, **{portion: pa.array(np.full(batch.num_rows, own), pa.int64())})

    # Written once, so that a portion keeps its number whatever is computed again.
    cut = materialize(df.mapInArrow(number, held), "portions")

    def hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        words, starts = tokens(texts)
        return words, starts, ngrams(words, starts, order)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, text, STEP_BYTES):
            numbers = batch.column(0).to_numpy()
            for own in np.unique(numbers):
                wanted = np.unique(np.concatenate(hashes([texts[i] for i in np.flatnonzero(numbers == own)])[2]))
                at = block_of(wanted, blocks)
                sort = np.argsort(at, kind="stable")
                parts = np.split(sort, np.flatnonzero(np.diff(at[sort])) + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(parts), own), pa.int64()), pa.array([int(at[p[0]]) for p in parts], pa.int64()),
                    pa.array([wanted[p].tobytes() for p in parts], pa.binary())], names=["portion", "block", "asked"])

    asked = cut.select(portion, text).mapInArrow(ask, "portion bigint, block bigint, asked binary")

    def answer(asks: pa.Table, filled: pa.Table) -> pa.Table:
        cells = np.frombuffer(filled.column("bits")[0].as_py(), np.uint8) if filled.num_rows else np.zeros(BLOCK, np.uint8)
        found = []
        for one in asks.column("asked").to_pylist():
            h = np.frombuffer(one, _U)
            found.append(levels_in(cells, h, np.zeros(len(h), np.int64)).tobytes())
        return pa.table({"portion": asks.column("portion"), "asked": asks.column("asked"), "found": pa.array(found, pa.binary())})

    # A block's n-grams are asked for once per portion, so a frequent one fills no task.
    answered = asked.groupBy("block").cogroup(model["filter"].groupBy("block")).applyInArrow(
        answer, "portion bigint, asked binary, found binary")
    light = spark.sparkContext.broadcast(_light(model))
    arrow = to_arrow_schema(schema)

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return arrow.empty_table()
        words, starts, grams = hashes(rows.column(text).to_pylist())
        h = np.frombuffer(b"".join(answers.column("asked").to_pylist()), _U)
        found = np.frombuffer(b"".join(answers.column("found").to_pylist()), np.uint8)
        sort = np.argsort(h)
        h, found = h[sort], found[sort]
        levels = [found[np.searchsorted(h, g)] for g in grams]
        batch = rows.drop_columns([portion]).combine_chunks().to_batches()[0]
        return pa.Table.from_batches([
            _rows(batch, light.value, arrow, rest, out, words, starts, levels, *np.unique(words, return_inverse=True))])

    return cut.groupBy(portion).cogroup(answered.groupBy("portion")).applyInArrow(finish, schema)
