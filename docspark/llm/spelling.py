"""Spelling variants: k-d trees over letter-count vectors find words one edit apart.

A word becomes the vector of how often each letter occurs in it. One replaced letter takes one count down
and one up (L1 distance two, same length); one inserted letter takes one count up (L1 distance one, next
length). So a word's neighbours of its own length lie in a tree of that length, those with a letter more in
the tree of the next length, and the shorter ones find the word by their own search.

The words of a length that has more than ``LEAF`` are split by the top levels of a k-d tree, fitted on a bounded
sample of the words (``SAMPLE``). Every word goes to the one leaf that holds it, and as a query to each leaf whose
box it can reach; only counts that go up or down by one can cross a split, so these are few. In a leaf a k-d tree
with tight boxes is built over all its words, boxes that are out of reach are pruned, and what is left is verified
letter by letter. Each leaf returns one row per word with a neighbour (their number and the best), never pairs. Leaves
that hold too many words all the same (words of equal counts cannot be split) are cut into pieces by hash, and their
queries too, and every piece meets every other.

A word's form is its most frequent neighbour, if that is ``TIMES`` as frequent; a form's n is at least ``TIMES`` as large each
step, so a chain to the root is no longer than the logarithm of the largest count, and pointer doubling follows it.

Cases: null and empty texts have no words; texts and words of any length are taken whole; rows without doc_id count
under an empty id; repeated rows count again; an empty table gives an empty result; other columns, whatever
their names, do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.batches import steps
from docspark.session import materialize

#: Shortest word, fewest occurrences, and how much more frequent a form is.
LETTERS, OCCURRENCES, TIMES = 7, 2, 10
#: One run in so many loses a letter.
DAMAGE = 31
#: Words and bytes that a leaf of the top levels should hold.
LEAF, LEAF_BYTES = 8192, 4_000_000
#: Words that the top levels are fitted on.
SAMPLE = 100_000
#: Words of a bucket that are compared without a further split.
BUCKET = 32
#: Entries that a worker counts before it hands them on.
COUNTED = 300_000
#: Numbers that one array operation of the search makes.
CELLS = 4_000_000

# Every letter is one byte in Latin-1, so bytes stand for code points; bytes.lower touches A-Z alone.
_RUNS = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LETTERS)
_DIMS = 26 + 64
_DIM = np.zeros(256, np.int64)
_DIM[ord("a"):ord("z") + 1] = np.arange(26)
_DIM[0xC0:] = np.arange(26, _DIMS)

Leaf = int
#: (letter, count, words with at most that count, the others), or the number of a leaf.
Split = tuple[int, int, "Split | Leaf", "Split | Leaf"]


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """How often each word stands in a text, after the damage that its id and the run decide."""
    found: Counter = Counter()
    start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    start = zlib.crc32(b":", start)
    for run, n in Counter(_RUNS.findall((text or "").encode("latin-1", "replace").lower())).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LETTERS:
                continue
        found[run] += n
    return found


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words that occur often enough, over all texts."""
    kinds = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], schema=kinds)
            held.clear()
            return rows

        for batch, texts in steps(batches, "text"):
            for key, value in zip(batch.column(0).to_pylist(), texts):
                held.update(words_of(key, value))
                if len(held) > COUNTED:
                    yield counted()
        yield counted()

    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = plain.mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def letters(words: list[bytes]) -> np.ndarray:
    """Letter counts, one row per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = _DIM[np.frombuffer(b"".join(words), np.uint8)]
    rows = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(rows * _DIMS + codes, minlength=len(words) * _DIMS).reshape(-1, _DIMS)
    return counts.astype(np.int16 if len(words) and lengths.max() < 30_000 else np.int32)


def _cut(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter whose counts differ most, and the count that halves them; None when all rows are equal."""
    spread = counts.std(axis=0)
    at = int(spread.argmax())
    if spread[at] == 0:
        return None
    column = np.sort(counts[:, at])
    middle = int(column[(len(column) - 1) // 2])
    return at, middle if middle < column[-1] else int(column[column < column[-1]][-1])


def top_levels(counts: np.ndarray, leaves: int) -> tuple[Split | Leaf, int]:
    """Splits of a length's sample into about ``leaves`` leaves, and how many there are."""
    made = 0

    def build(rows: np.ndarray, wanted: int) -> Split | Leaf:
        nonlocal made
        cut = _cut(rows) if wanted > 1 and len(rows) > 1 else None
        if cut is None:
            made += 1
            return made - 1
        below = rows[:, cut[0]] <= cut[1]
        half = max(1, round(wanted * below.mean()))
        return (*cut, build(rows[below], half), build(rows[~below], max(1, wanted - half)))

    return build(counts, leaves), made


def home(tree: Split | Leaf, counts: np.ndarray) -> np.ndarray:
    """The leaf that holds each row."""
    found = np.zeros(len(counts), np.int64)

    def visit(node: Split | Leaf, rows: np.ndarray) -> None:
        if isinstance(node, int):
            found[rows] = node
            return
        below = counts[rows, node[0]] <= node[1]
        visit(node[2], rows[below])
        visit(node[3], rows[~below])

    visit(tree, np.arange(len(counts)))
    return found


def reached(tree: Split | Leaf, counts: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf whose box a row meets by raising ``up`` counts and lowering ``down`` by one."""
    found: list[tuple[np.ndarray, int]] = []

    def visit(node: Split | Leaf, rows: np.ndarray, more: np.ndarray, less: np.ndarray, box: dict) -> None:
        if not len(rows):
            return
        if isinstance(node, int):
            found.append((rows, node))
            return
        dim, cut = node[:2]
        low, high = box.get(dim, (-1, 1 << 30))
        x = counts[rows, dim].astype(np.int64)
        # What the new side of the box asks for, in place of what the old one did.
        lower = less + np.maximum(x - cut, 0) - np.maximum(x - high, 0)
        raised = more + np.maximum(cut + 1 - x, 0) - np.maximum(low - x, 0)
        left, right = lower <= down, raised <= up
        visit(node[2], rows[left], more[left], lower[left], box | {dim: (low, cut)})
        visit(node[3], rows[right], raised[right], less[right], box | {dim: (cut + 1, high)})

    none = np.zeros(len(counts), np.int64)
    visit(tree, np.arange(len(counts)), none, none, {})
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([r for r, _ in found]), np.concatenate([np.full(len(r), leaf) for r, leaf in found])


def _grid(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def one_edit(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether each pair of rows is one replaced letter, or one letter more in ``data``, apart."""
    if queries.shape[1] == data.shape[1]:
        return (queries != data).sum(axis=1) == 1
    size = queries.shape[1]
    before = np.logical_and.accumulate(queries == data[:, :size], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((queries == data[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= size


def unary(counts: np.ndarray, most: np.ndarray) -> list[np.ndarray]:
    """Counts as rows of bits, ``most`` bits a letter, the lowest ``count`` of them set; a list of 64-bit columns.

    Differences are counted bits: of two rows ``x ^ y`` holds the L1 distance, ``x & ~y`` what y lacks of x; and the
    smallest and largest counts of a group, its box, are the AND and the OR of its rows.
    """
    letter = np.repeat(np.arange(len(most)), most)
    step = np.arange(len(letter)) - np.repeat(np.cumsum(most) - most, most)
    out = np.zeros((len(counts), -(-max(1, len(letter)) // 64) * 8), np.uint8)
    size = max(1, CELLS // max(1, len(letter)))
    for at in range(0, len(counts), size):
        bits = np.packbits(counts[at:at + size][:, letter] > step, axis=1)
        out[at:at + size, :bits.shape[1]] = bits
    return list(np.ascontiguousarray(out.view(np.uint64).T))


def _bits(columns: Iterator[np.ndarray]) -> np.ndarray:
    return sum(np.bitwise_count(c).astype(np.int32) for c in columns)


def neighbours(queries: list[bytes], data: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, word) one edit apart; all queries have one length, all words that or the next."""
    if not queries or not data:
        return
    q_counts, d_counts = letters(queries), letters(data)
    most = np.maximum(q_counts.max(axis=0), d_counts.max(axis=0)).astype(np.int64)
    q, d = unary(q_counts, most), unary(d_counts, most)
    q_grid, d_grid = _grid(queries), _grid(data)
    # Same length: one count up, one down. Next length: one count up.
    down = int(q_grid.shape[1] == d_grid.shape[1])

    def verified(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = max(1, CELLS // d_grid.shape[1])
        for at in range(0, len(left), size):
            a, b = left[at:at + size], right[at:at + size]
            ok = one_edit(q_grid[a], d_grid[b])
            if ok.any():
                yield a[ok], b[ok]

    def search(rows: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low = [np.bitwise_and.reduce(c[rows]) for c in d]
        high = [np.bitwise_or.reduce(c[rows]) for c in d]
        asking = asking[_bits(x & ~c[asking] for x, c in zip(low, q)) <= 1]
        asking = asking[_bits(c[asking] & ~x for x, c in zip(high, q)) <= down]
        if not len(asking):
            return
        cut = _cut(d_counts[rows]) if len(rows) > BUCKET else None
        if cut is not None:
            below = d_counts[rows, cut[0]] <= cut[1]
            yield from search(rows[below], asking)
            yield from search(rows[~below], asking)
            return
        size = max(1, CELLS // (8 * len(rows)))
        for at in range(0, len(asking), size):
            part = asking[at:at + size]
            far = _bits(c[part][:, None] ^ x[rows][None] for c, x in zip(q, d))
            i, j = np.nonzero(far == 1 + down)
            yield from verified(part[i], rows[j])

    yield from search(np.arange(len(data)), np.arange(len(queries)))


def _best(keys: np.ndarray, others: np.ndarray, n: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, number of its pairs, best other): the most frequent, of these the first in ``order``."""
    sort = np.lexsort((order[others], -n[others], keys))
    keys, others = keys[sort], others[sort]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)]), others[first]


def _top_trees(words: DataFrame) -> dict[int, tuple[Split | Leaf, int]]:
    """Top levels for each length that has more than a leaf's words; their number follows the words / ``LEAF``."""
    room = F.greatest(F.least(F.lit(LEAF), F.floor(F.lit(LEAF_BYTES) / F.col("length"))), F.lit(1)).alias("room")
    large = (words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
             .select("length", "n", room).where("n > room"))
    sizes = {r.length: ceil(r.n / r.room) for r in large.collect()}
    if not sizes:
        return {}
    sample = words.where(F.length("word").isin(list(sizes))).orderBy(F.xxhash64("word")).limit(SAMPLE).select("word").collect()
    by_length: dict[int, list[bytes]] = {}
    for r in sample:
        by_length.setdefault(len(r.word), []).append(r.word.encode("latin-1"))
    return {size: top_levels(letters(given), sizes[size]) for size, given in by_length.items()}


def _routed(words: DataFrame) -> DataFrame:
    """(length, leaf, side, word, n): each word in its leaf (side 0) and as a query to every leaf in reach (side 1)."""
    trees = words.sparkSession.sparkContext.broadcast(_top_trees(words))
    kinds = pa.schema([("length", pa.int64()), ("leaf", pa.int64()), ("side", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = np.array([w.encode("latin-1") for w in batch.column(0).to_pylist()], object)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            lengths = np.fromiter(map(len, given), np.int64, len(given))
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                counts = letters(list(given[own]))
                none = np.zeros(len(own), np.int64)
                parts = []
                for side, target, up, down in ((0, size, 0, 0), (1, size, 1, 1), (1, size + 1, 1, 0)):
                    tree = trees.value.get(int(target), (0, 1))[0]
                    rows, leaf = (np.arange(len(own)), home(tree, counts)) if side == 0 else reached(tree, counts, up, down)
                    parts.append((rows, np.full(len(rows), target), leaf, np.full(len(rows), side)))
                rows, target, leaf, side = (np.concatenate(x) for x in zip(*parts))
                at = pa.array(own[rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(target, pa.int64()), pa.array(leaf, pa.int64()), pa.array(side, pa.int32()),
                     batch.column(0).take(at), batch.column(1).take(at)], schema=kinds)

    return words.select("word", "n").mapInArrow(run, "length bigint, leaf bigint, side int, word string, n bigint")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): number of the words one edit apart and the most frequent of them."""
    routed = materialize(_routed(words), "routed")
    room = F.greatest(F.least(F.lit(LEAF), F.floor(F.lit(LEAF_BYTES) / F.col("length"))), F.lit(1))
    # Only leaves beyond four times the room are cut; all others are one piece.
    pieces = routed.groupBy("length", "leaf", "side").agg(F.count("*").alias("n"), F.max(room).alias("room")).where("n > 4 * room")
    pieces = materialize(pieces.groupBy("length", "leaf").agg(
        F.max(F.when(F.col("side") == 0, F.ceil(F.col("n") / F.col("room")))).cast("int").alias("d"),
        F.max(F.when(F.col("side") == 1, F.ceil(F.col("n") / F.col("room")))).cast("int").alias("q")), "pieces")
    placed = routed.join(pieces, ["length", "leaf"], "left").select(
        "length", "leaf", "side", "word", "n", F.coalesce("d", F.lit(1)).alias("d"), F.coalesce("q", F.lit(1)).alias("q"))
    keys = ["length", "leaf", "i", "j"]

    def dealt(side: int, own: str, other: str) -> DataFrame:
        mine, all_of = ("i", "j") if side == 0 else ("j", "i")
        # Aliased, so that the columns of the two sides are apart.
        return placed.where(F.col("side") == side).select(
            F.col("length").alias("length"), F.col("leaf").alias("leaf"), F.pmod(F.xxhash64("word"), F.col(own)).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(all_of),
            F.col("word").alias("word"), F.col("n").alias("n"))

    kinds = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def meet(data: pa.Table, queries: pa.Table) -> pa.Table:
        given = [w.encode("latin-1") for w in data.column("word").to_pylist()]
        asked = [w.encode("latin-1") for w in queries.column("word").to_pylist()]
        n_data, n_asked = (t.column("n").to_numpy() for t in (data, queries))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        names_d, names_q = np.array(given, object), np.array(asked, object)
        order_d, order_q = (np.argsort(np.argsort(np.array(x, "S"), kind="stable")) if len(x) else np.zeros(0, int) for x in (given, asked))
        sizes = np.fromiter(map(len, asked), np.int64, len(asked))
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            pairs = list(neighbours([asked[i] for i in own], given))
            if not pairs:
                continue
            left = own[np.concatenate([a for a, _ in pairs])]
            right = np.concatenate([b for _, b in pairs])
            key, count, best = _best(left, right, n_data, order_d)
            out.append((names_q[key], count, n_data[best], names_d[best]))
            if len(given[0]) != size:
                # A word of the own length finds back by its own search, a longer one does not.
                key, count, best = _best(right, left, n_asked, order_q)
                out.append((names_d[key], count, n_asked[best], names_q[best]))
        if not out:
            return kinds.empty_table()
        word, count, n, best = (np.concatenate(x) for x in zip(*out))
        return pa.Table.from_arrays([pa.array([w.decode("latin-1") for w in word]), pa.array(count, pa.int64()),
                                     pa.array(n, pa.int64()), pa.array([w.decode("latin-1") for w in best])], schema=kinds)

    met = dealt(0, "d", "q").groupBy(*keys).cogroup(dealt(1, "q", "d").groupBy(*keys)).applyInArrow(
        meet, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(links: DataFrame, steps_at_most: int) -> DataFrame:
    """(word, root) of every word of ``links`` (word, form), whose chains have at most so many steps."""
    found = links.select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps_at_most:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = materialize(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return found


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` that is frequent enough."""
    words = materialize(count_words(docs, doc_id, text), "words")
    largest = words.agg(F.max("n")).first()[0] or 1
    near = near_words(words)
    has_form = F.col("best_n") >= TIMES * F.col("n")
    named = materialize(words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "variants")
    ends = roots(named.where("form IS NOT NULL"), ceil(log(largest, TIMES)) + 1)
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
