"""Exact top-k search by inner product with two cover trees.

Data and queries are dealt to blocks by hash, and every block of queries meets every block of data. In
a meeting, a cover tree is built over each side: a node's children are centres more than half its radius
apart, which together cover its points within that half, and every node knows the largest distance from
its centre to anything below it. Pairs of nodes are opened from the roots on. The inner product of any
query below one node with any vector below the other is at most

    <q, x> + |q| r_x + |x| r_q + r_q r_x

of their centres and covering radii; a pair below the worst k-th score of the query node's group is
pruned. Scores are integers, so they are exact in doubles, and pairs that only tie are never pruned.
Queries start with the k-th best of a bounded sample (``SAMPLE`` rows, by the hash of their id) as their bound.

Cases: as in the approximate search, but zero vectors take part: vectors that are null, empty, or
hold null or non-finite components do not, nor rows without vec_id, nor vectors of another length than
most have; where components are so large that a score could pass 2 ** 53, beyond which doubles are not exact, a ValueError says so before
the search; a query's own row is the one that shares its vec_id; ties go to the smaller vec_id; repeated
candidates count one by one, repeated query rows are one query; with fewer candidates all of them come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.vectors import best, common_length, matrix, merged_ranks, valid
from docspark.session import materialize

#: Fixed value: components are multiplied by it and rounded down.
SCALE = 1024
SAMPLE = 2048
BLOCK_ROWS = 2048
QUERY_ROWS = 2048
LEAF = 4
#: Pairs of nodes that are looked at together.
PAIRS = 50_000


class CoverTree:
    """Nodes in arrays: centre (a row), covering radius, children, and the rows of leaves."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.centre: list[int] = []
        self.radius: list[float] = []
        children: list[list[int]] = []
        members: list[np.ndarray] = []
        work = [(np.arange(len(rows)), 0, -1)]
        while work:
            points, centre, parent = work.pop()
            node = len(self.centre)
            if parent >= 0:
                children[parent].append(node)
            away = np.sqrt(((rows[points] - rows[centre]) ** 2).sum(axis=1))
            radius = float(away.max())
            self.centre.append(centre)
            self.radius.append(radius)
            children.append([])
            if len(points) <= LEAF or radius == 0:
                members.append(points)
                continue
            members.append(points[:0])
            # Centres more than half the radius apart, until each point is within it of one.
            nearest, owner, owners = away, np.zeros(len(points), np.int64), [centre]
            while nearest.max() > radius / 2:
                new = points[nearest.argmax()]
                distance = np.sqrt(((rows[points] - rows[new]) ** 2).sum(axis=1))
                closer = distance < nearest
                nearest = np.where(closer, distance, nearest)
                owner[closer] = len(owners)
                owners.append(new)
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(owners) + 1))
            work += [(points[order[a:b]], c, node) for c, a, b in zip(owners, cuts, cuts[1:]) if b > a]
        self.centres = rows[self.centre]
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.radii = np.array(self.radius)
        self.child_count = np.array([len(c) for c in children])
        self.child_start = np.cumsum(self.child_count) - self.child_count
        self.children = np.array([c for cs in children for c in cs], np.int64)
        self.member_count = np.array([len(m) for m in members])
        self.member_start = np.cumsum(self.member_count) - self.member_count
        self.members = np.concatenate(members)
        self.parent = np.zeros(len(self.centre), np.int64)
        self.parent[self.children] = np.repeat(np.arange(len(self.centre)), self.child_count)

    def worst(self, bounds: np.ndarray) -> np.ndarray:
        """The smallest bound among the rows below each node."""
        low = np.full(len(self.centre), np.inf)
        leaves = np.flatnonzero(self.member_count)
        low[leaves] = np.minimum.reduceat(bounds[self.members], self.member_start[leaves])
        for node in range(len(low) - 1, 0, -1):  # a node comes after its parent
            low[self.parent[node]] = min(low[self.parent[node]], low[node])
        return low


def _spread(start: np.ndarray, count: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, its items one after another: (which place, item)."""
    which = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, items[start[which] + inside]


def dual_search(
    queries: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's k best in a block, as far as they reach its bound."""
    q, x = CoverTree(queries), CoverTree(vectors)
    bounds = bounds.copy()
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    work = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    low = q.worst(bounds)
    while work:
        a, b = work.pop()
        if len(a) > PAIRS:
            work += [(a[i:i + PAIRS], b[i:i + PAIRS]) for i in range(0, len(a), PAIRS)][::-1]
            continue
        centre = (q.centres[a] * x.centres[b]).sum(axis=1)
        most = centre + q.norms[a] * x.radii[b] + x.norms[b] * q.radii[a] + q.radii[a] * x.radii[b]
        keep = most * (1 + 1e-12) + 1e-3 >= low[a]
        a, b = a[keep], b[keep]
        leaf_a, leaf_b = q.member_count[a] > 0, x.member_count[b] > 0
        both = leaf_a & leaf_b
        if both.any():
            pair, left = _spread(q.member_start[a[both]], q.member_count[a[both]], q.members)
            nodes = b[both][pair]
            pair, right = _spread(x.member_start[nodes], x.member_count[nodes], x.members)
            left = left[pair]
            score = np.concatenate([np.zeros(0)] + [
                (queries[left[i:i + PAIRS]] * vectors[right[i:i + PAIRS]]).sum(axis=1) for i in range(0, len(left), PAIRS)])
            good = (score >= bounds[left]) & (query_ids[left] != ids[right])
            held = tuple(np.concatenate(c) for c in zip(held, (left[good], right[good], score[good])))
            top = best(held[0], ids[held[1]], held[2], k)
            held = tuple(c[top] for c in held)
            full = np.flatnonzero(np.bincount(held[0], minlength=len(queries)) == k)
            kth = np.full(len(queries), np.inf)
            np.minimum.at(kth, held[0], held[2])
            bounds[full] = np.maximum(bounds[full], kth[full])
            low = q.worst(bounds)
        # The wider side is opened, or the one that can be.
        open_x = ~both & ~leaf_b & (leaf_a | (x.radii[b] >= q.radii[a]))
        open_q = ~both & ~open_x
        which, below = _spread(x.child_start[b[open_x]], x.child_count[b[open_x]], x.children)
        new = [(a[open_x][which], below)]
        which, below = _spread(q.child_start[a[open_q]], q.child_count[a[open_q]], q.children)
        new.append((below, b[open_q][which]))
        a, b = (np.concatenate(c) for c in zip(*new))
        if len(a):
            work.append((a, b))
    return held


def search(df: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query row of ``df``."""
    spark = df.sparkSession
    whole = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
    rows = df.where(F.col(vec_id).isNotNull() & valid(F.col(vector), allow_zero=True)).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("vector"), is_query.alias("is_query"))
    rows = materialize(rows, "vectors")
    width = common_length(rows, "vector")
    schema = "query_id bigint, query_no bigint, vec_id bigint, vec_no bigint, score bigint"
    if not width:
        return merged_ranks(spark.createDataFrame([], schema), k)
    rows = rows.where(F.size("vector") == width)
    largest = rows.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0.0
    if width * largest * largest >= 2.0 ** 53:
        raise ValueError(f"components up to {largest / SCALE:g} make scores beyond 2**53, which are not exact")
    data_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    asked = rows.where("is_query").select("vec_id", "vector").dropDuplicates()
    query_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "vector").collect()
    shared = spark.sparkContext.broadcast((
        np.array([r.vec_id for r in picked], np.int64), np.array([r.vector for r in picked]).reshape(len(picked), width)))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sample = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                scores = matrix(part.column(1), width) @ sample.T
                scores[part.column(0).to_numpy()[:, None] == ids[None, :]] = -np.inf
                low = np.partition(scores, -k, axis=1)[:, -k] if len(ids) >= k else np.full(part.num_rows, -np.inf)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(low)], names=["query_id", "query", "bound"])

    queries = asked.mapInArrow(bound, "query_id bigint, query array<double>, bound double")
    wanted = queries.select(
        "query_id", F.xxhash64("query").alias("query_no"), "query", "bound",
        F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1))).alias("block"))
    data = rows.select(
        "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(data_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema([("query_id", pa.int64()), ("query_no", pa.int64()), ("vec_id", pa.int64()),
                           ("vec_no", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        names, ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
        at_q, at_x, score = dual_search(
            matrix(left["query"], width), names, left["bound"].to_numpy(), matrix(right["vector"], width), ids, k)
        return pa.table([names[at_q], left["query_no"].to_numpy()[at_q], ids[at_x], at_x, score.astype(np.int64)], schema=kinds)

    keys = ["block", "part"]
    found = wanted.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(meet, schema)
    return merged_ranks(found, k)
