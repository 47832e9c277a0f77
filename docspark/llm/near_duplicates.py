"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function ranks the shingles of a text; its ``SKETCH`` smallest values are kept. Inverted
lists of retained values generate the overlaps: a list's key is a run of three neighbouring retained
values, which texts with unlike content hardly share even when they contain the same passage. Of two
linked texts whose union holds at most ``SKETCH`` shingles, the d that are not common leave at least 3 d
others in d + 1 gaps, so a run of three is common to both when the union has 12 or more, and a run of two
in any case: sets of at most ``SMALL`` shingles have keys of two as well. For larger unions at the
threshold the chance that all runs are broken is about 0.75 ** 64, 1e-8, and falls quickly above it.

A pair is dropped when its union sketch (the ``SKETCH`` smallest values of both) has so few common
values that a similarity at the threshold would give them with a chance below ``MISS``. All
others are confirmed on the full sets of both texts.

Texts with one set of shingles form one vertex, so copies are never paired. Cases: null and empty
texts have an empty set and are linked with nothing; fewer words than a shingle are one shingle;
texts of any length are taken whole; rows that share a ``doc_id`` stay rows of their own, linked by
their texts; rows without ``doc_id`` are linked too, but never give a group its id (it is null when no
row of the group has one) and are never kept when another row is; extra columns pass.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.batches import list_array, steps
from docspark.llm.linking import link_lists, shared_lists
from docspark.session import materialize

WORDS = 5
#: A link needs SHARE / 100 of the union in common.
SHARE = 75
SKETCH = 64
#: Largest set with keys of two values.
SMALL = 11
#: Chance of dropping a pair at the threshold by its union sketch.
MISS = 1e-7
#: Sets that a worker remembers while it confirms pairs.
KNOWN_SETS = 256

_POWERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F], np.uint64)


def least_common() -> int:
    """Common values of a full union sketch below which a pair cannot be a link."""
    p, chance, count = SHARE / 100, 0.0, 0
    while True:
        chance += comb(SKETCH, count) * p**count * (1 - p) ** (SKETCH - count)
        if chance > MISS:
            return count
        count += 1


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    # bytes.lower touches A-Z alone, and bytes.split knows exactly the blanks that are meant.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    with np.errstate(over="ignore"):
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            part = hashes[i:len(hashes) - width + 1 + i] * _POWERS[i]
            mixed = (mixed ^ (part ^ (part >> np.uint64(31)))) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, n, set_key, sketch) of documents (doc_id, text)."""
    kinds = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()),
                       ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            sets = [shingles(t) for t in texts]
            kept = [s[:SKETCH] for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                list_array(np.concatenate(kept) if kept else np.zeros(0, np.int64), [len(k) for k in kept], pa.int64()),
            ], schema=kinds)

    return docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text").mapInArrow(
        run, "doc_id bigint, row_hash bigint, n bigint, set_key binary, sketch array<bigint>")


def may_link(x: str, y: str) -> Column:
    """Sizes and union sketch of two vertices allow a link."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    a, b = F.col(f"{x}sketch"), F.col(f"{y}sketch")
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect(a, b), union))
    sizes = 100 * F.least(n, m) >= SHARE * F.greatest(n, m)
    return sizes & ((F.size(union) < SKETCH) | (common >= least_common()))


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``texts`` holds (v, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def set_of(key: bytes, text: str) -> np.ndarray:
            if key in known:
                known.move_to_end(key)
            else:
                known[key] = shingles(text)
                if len(known) > KNOWN_SETS:
                    known.popitem(last=False)
            return known[key]

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                left, right, first, second = (part.column(i).to_pylist() for i in range(4))
                keep = []
                for a, b, x, y in zip(left, right, first, second):
                    one, two = set_of(a, x), set_of(b, y)
                    common = np.intersect1d(one, two, assume_unique=True).size
                    keep.append(100 * common >= SHARE * (one.size + two.size - common))
                yield part.select(["a", "b"]).filter(pa.array(keep))

    both = (pairs.join(texts.select(F.col("v").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("v").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y"))
    return both.mapInArrow(run, "a binary, b binary")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """(v, size, value): every shingle of the texts (v, text) and the size of the set."""
    kinds = pa.schema([("v", pa.binary()), ("size", pa.int64()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, given in steps(batches, "text"):
            for v, text in zip(batch.column(0).to_pylist(), given):
                found = shingles(text)
                for at in range(0, len(found), 100_000):
                    part = found[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([v] * len(part), pa.binary()), pa.array(np.full(len(part), len(found))), pa.array(part)], schema=kinds)

    return texts.select("v", "text").mapInArrow(run, "v binary, size bigint, value bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_hash, n_shingles, component_id, group_key, kept) of every row of ``docs``.

    ``row_hash`` is ``xxhash64`` of the text; with ``doc_id`` it finds the row again. ``group_key`` tells groups
    apart that share an id or have none; it is null for texts without words.
    """
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(sketches(plain), "sketches")
    # One vertex per set, found again in the documents by its smallest row.
    vertices = materialize(
        rows.where("n > 0").groupBy(F.col("set_key").alias("v")).agg(
            F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "row_hash")).alias("place")), "vertices")
    def runs(length: int) -> Column:
        at = F.when(F.size("sketch") >= length, F.sequence(F.lit(1), F.size("sketch") - length + 1))
        keys = F.transform(at, lambda i: F.xxhash64(*[F.element_at("sketch", i + j) for j in range(length)]))
        return F.coalesce(keys, F.array().cast("array<bigint>"))

    small = F.when(F.col("n") <= SMALL, runs(2)).otherwise(F.array().cast("array<bigint>"))
    postings = vertices.select(F.explode(F.array_distinct(F.concat(runs(3), small))).alias("key"), "v")
    lists = shared_lists(postings)
    listed = vertices.join(lists.select("v").distinct(), "v", "left_semi").select("v", "place.*")
    texts = materialize(
        plain.withColumn("row_hash", F.xxhash64("text")).alias("d")
        .join(listed.alias("l"), F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.row_hash") == F.col("l.row_hash")))
        .select("v", "text").dropDuplicates(["v"]), "texts")
    groups = link_lists(lists, vertices.select("v", "n", "sketch"), may_link, lambda pairs: confirm(pairs, texts),
                        parts=lambda opened: shingle_rows(texts.join(opened, "v", "left_semi")), share=SHARE)
    # The group's id is its smallest doc_id; vertices outside every group are groups by themselves.
    rooted = vertices.join(groups, "v", "left").select("v", "least_id", F.coalesce("root", "v").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("v").alias("set_key"), "component_id", F.col("root").alias("group_key"))
    found = rows.join(named, "set_key", "left").select(
        "doc_id", "row_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "group_key")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
