"""Approximate nearest neighbours: probed lists with an adaptive scan of dimensions.

Every vector belongs to the list of its nearest centroid. Inside a list, vectors and queries are rotated
by one random orthogonal matrix and stored in blocks of columns. After each block, a hypothesis test
compares the distance estimated from the dimensions seen with the distance that a place among the
query's best needs, and abandons the candidate when it is too far with high confidence. What survives
all blocks is scored on the original vectors in double precision.

The centroids are fitted on a bounded sample (``SAMPLE`` vectors, chosen by the hash of their id), which
also gives each query a first bound: the k-th best of the sample's rows in the lists that it visits. All rows
are in the lists, and results come from the visited lists alone; a query visits further lists while the sample has
fewer than k rows in them, and all lists without a bound when fewer than k rows came back. Lists are cut into blocks of ``BLOCK_ROWS`` rows
and queries into blocks of ``QUERY_ROWS``, by hash, so a full list never meets in one task. ``PROBED`` is the
share of lists that a query visits: without structure in the data, 0.7 finds about 0.95 of the true
neighbours, and clustered data far more.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows without vec_id, nor vectors of another length than most have; ties go to the smaller vec_id; a
query's own row is the one that shares its vec_id; rows that repeat both vec_id and vector count once,
as candidates and as queries, and are one before the sample and the lists are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.vectors import best, common_length, matrix, merged_ranks, valid
from docspark.session import materialize

SAMPLE = 8192
LISTS = 128
PROBED = 0.7
COLUMNS = 16
#: Width of the test in deviations of the estimate. Of a rotated difference, the share in ``seen`` of
#: ``width`` dimensions has a relative variance of 2 (1 / seen - 1 / width).
CONFIDENCE = 2.5
#: Share of pairs below which they are followed one by one.
SPARSE = 0.2
BLOCK_ROWS = 4096
QUERY_ROWS = 4096


def nearest_lists(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x @ centroids.T - 0.5 * (centroids**2).sum(axis=1)).argmax(axis=1)


def fit(vectors: DataFrame, width: int) -> dict[str, np.ndarray]:
    """Centroids, rotation and the sample they come from."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "vector").collect()
    sample = np.array([r.vector for r in rows], np.float64).reshape(len(rows), width)
    random = np.random.default_rng(7)
    count = max(1, min(LISTS, len(sample) // 4))
    centroids = sample[random.choice(len(sample), count, replace=False)]
    for _ in range(10):
        nearest = nearest_lists(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=count)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    rotation = np.linalg.qr(random.standard_normal((width, width)))[0]
    return {"centroids": centroids, "rotation": rotation, "sample": sample,
            "sample_ids": np.array([r.vec_id for r in rows], np.int64),
            "sample_lists": nearest_lists(sample, centroids)}


def _slack(seen: int, width: int) -> float:
    """How far an estimate from ``seen`` of ``width`` rotated dimensions may lie above the bound."""
    return 1 + CONFIDENCE * np.sqrt(2 * (1 / seen - 1 / width)) + 1e-6


def scan(queries: np.ndarray, bounds: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) of rotated rows that no test abandons."""
    width = vectors.shape[1]
    q, x = queries.astype(np.float32), vectors.astype(np.float32)
    # A score above the bound means a squared distance below this one.
    far = ((q**2).sum(axis=1) - 2 * bounds.astype(np.float32))[:, None] + (x**2).sum(axis=1)[None, :]
    far = np.maximum(far, 0) + np.float32(1e-5)
    partial = np.zeros_like(far)
    seen = 0
    while True:  # whole columns, until few pairs are left
        block = slice(seen, min(width, seen + COLUMNS))
        partial += (q[:, block] ** 2).sum(axis=1)[:, None] + (x[:, block] ** 2).sum(axis=1)[None, :]
        partial -= (2 * q[:, block]) @ x[:, block].T
        seen = block.stop
        keep = partial * np.float32(width / seen) <= far * np.float32(_slack(seen, width))
        if seen == width or np.count_nonzero(keep) < SPARSE * keep.size:
            break
    at_q, at_x = np.nonzero(keep)
    partial, far = partial[at_q, at_x], far[at_q, at_x]
    while seen < width and len(at_q):
        block = slice(seen, min(width, seen + COLUMNS))
        partial = partial + ((x[at_x, block] - q[at_q, block]) ** 2).sum(axis=1)
        seen = block.stop
        keep = partial * np.float32(width / seen) <= far * np.float32(_slack(seen, width))
        at_q, at_x, partial, far = at_q[keep], at_x[keep], partial[keep], far[keep]
    return at_q, at_x


def search(df: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query row of ``df``."""
    spark = df.sparkSession
    rows = df.where(F.col(vec_id).isNotNull() & valid(F.col(vector))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"), is_query.alias("is_query"))
    rows = materialize(rows.groupBy("vec_id", "vector").agg(F.max("is_query").alias("is_query")), "vectors")
    width = common_length(rows, "vector")
    rows = rows.where(F.size("vector") == width)
    schema = "query_id bigint, query_no bigint, vec_id bigint, vec_no bigint, score double"
    if not width:
        return merged_ranks(spark.createDataFrame([], schema), k)
    model = fit(rows, width)
    lists = len(model["centroids"])
    probes = max(1, int(np.ceil(PROBED * lists)))
    shared = spark.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value["centroids"]
        for batch in batches:
            x = matrix(batch.column(1), width)
            nearest = nearest_lists(x, centroids)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest, pa.int32())], names=["vec_id", "vector", "is_query", "list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        held = np.bincount(m["sample_lists"], minlength=lists)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                q, ids = matrix(part.column(1), width), part.column(0).to_numpy()
                order = np.argsort(-(q @ m["centroids"].T), axis=1, kind="stable")
                own = ids[:, None] == m["sample_ids"][None, :]
                # Further lists, until k others of the sample are in them.
                short = held[order].cumsum(axis=1) < k + own.sum(axis=1)[:, None]
                visits = np.clip(short.sum(axis=1) + 1, probes, lists)
                visited = np.zeros((len(q), lists), bool)
                np.put_along_axis(visited, order, np.arange(lists) < visits[:, None], axis=1)
                # The k-th best of the sample's rows there is a bound that the k-th best of all there cannot fall below.
                scores = q @ m["sample"].T
                scores[own | ~visited[:, m["sample_lists"]]] = -np.inf
                bound = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), -np.inf)
                bound = bound - 1e-9 * (1 + np.abs(np.where(np.isfinite(bound), bound, 0)))
                near = [x[:n] for x, n in zip(order.astype(np.int32).tolist(), visits.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(bound), pa.array(near, pa.list_(pa.int32()))],
                    names=["query_id", "query", "bound", "near"])

    placed = materialize(rows.mapInArrow(assign, "vec_id bigint, vector array<float>, is_query boolean, list int"
                                         if dict(rows.dtypes)["vector"] == "array<float>" else
                                         "vec_id bigint, vector array<double>, is_query boolean, list int"), "placed")
    kind = dict(placed.dtypes)["vector"]
    asked = placed.where("is_query").select("vec_id", "vector").dropDuplicates()
    queries = materialize(asked.mapInArrow(
        probe, f"query_id bigint, query {kind}, bound double, near array<int>"), "queries")
    query_blocks = max(1, -(-queries.count() // QUERY_ROWS))
    # Blocks of each list: one row per list, at most LISTS of them.
    sizes = F.broadcast(placed.groupBy("list").agg(F.count("*").alias("rows")).select(
        "list", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks")))
    all_queries = F.sequence(F.lit(0), F.lit(query_blocks - 1))
    data = (placed.join(sizes, "list")
            .select("vec_id", "vector", F.xxhash64("vector").alias("vec_no"), "list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"),
                    F.explode(all_queries).alias("part")))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            x, ids, marks = matrix(right["vector"], width), right["vec_id"].to_numpy(), right["vec_no"].to_numpy()
            turned = x @ shared.value["rotation"]
            for start in range(0, left.num_rows, 256):
                part = left.slice(start, 256)
                q, names = matrix(part["query"], width), part["query_id"].to_numpy()
                at_q, at_x = scan(q @ shared.value["rotation"], part["bound"].to_numpy(), turned)
                other = names[at_q] != ids[at_x]
                at_q, at_x = at_q[other], at_x[other]
                # Row by row, so that equal vectors get equal sums.
                score = np.concatenate([np.zeros(0)] + [
                    (q[at_q[i:i + 65536]] * x[at_x[i:i + 65536]]).sum(axis=1) for i in range(0, len(at_q), 65536)])
                top = best(at_q, ids[at_x], score, k)
                numbers = part["query_no"].to_numpy()
                parts.append((names[at_q[top]], numbers[at_q[top]], ids[at_x[top]], marks[at_x[top]], score[top]))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * 5
        return pa.table({n: pa.array(c, t) for n, c, t in zip(
            ("query_id", "query_no", "vec_id", "vec_no", "score"), columns,
            (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))})

    keys = ["list", "block", "part"]

    def met(asking: DataFrame) -> DataFrame:
        wanted = (asking.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
                  .withColumn("list", F.explode("near")).join(sizes, "list")
                  .select("query_id", F.xxhash64("query").alias("query_no"), "query", "bound", "list", "part",
                          F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
        return materialize(wanted.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(meet, schema), "met")

    found = met(queries)
    # A test can abandon one of the k: queries with fewer rows visit all lists, without a bound.
    enough = found.groupBy("query_id", "query_no").count().where(F.col("count") >= k).select("query_id", "query_no")
    few = materialize(
        queries.where((F.col("bound") > float("-inf")) | (F.size("near") < lists))
        .withColumn("query_no", F.xxhash64("query")).join(enough, ["query_id", "query_no"], "left_anti")
        .withColumn("bound", F.lit(float("-inf"))).withColumn("near", F.sequence(F.lit(0), F.lit(lists - 1))), "few")
    if not few.isEmpty():
        found = found.join(few.select("query_id", "query_no"), ["query_id", "query_no"], "left_anti").select(
            *found.columns).unionByName(met(few))
    return merged_ranks(found, k)
