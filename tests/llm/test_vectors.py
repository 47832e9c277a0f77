"""Both vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import ann, top_k


def brute(vectors, every, k, whole=False):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float32).astype(float)
    x = np.floor(1024 * x) if whole else x
    out = {}
    for i in range(len(ids)):
        if ids[i] % every == 0:
            score = (x * x[i]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def clustered(count=1500, width=24, seed=2):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((20, width))
    x = np.where(random.random((count, 1)) < 0.6, centres[random.integers(20, size=count)], 0)
    x = x + 0.1 * random.standard_normal((count, width)) + (x == 0) * random.standard_normal((count, width))
    x[100:140] = x[100]  # ties
    return [(int(i), v.tolist()) for i, v in zip(random.permutation(count), x)]


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(4)


def results(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(rows)] for q, rows in out.items()}


def test_exact_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 300)
    monkeypatch.setattr(top_k, "QUERY_ROWS", 40)
    monkeypatch.setattr(top_k, "SAMPLE", 200)
    rows = clustered()
    assert results(top_k.search(table(spark, rows), F.col("vec_id") % 10 == 0, 10)) == brute(rows, 10, 10, whole=True)


def test_cover_tree_covers():
    x = np.array([v for _, v in clustered(400)])
    tree = top_k.CoverTree(x)
    assert sorted(tree.members.tolist()) == list(range(len(x)))
    below = {n: set(tree.members[s:s + c].tolist()) for n, (s, c) in enumerate(zip(tree.member_start, tree.member_count))}
    for n in range(len(tree.centre) - 1, 0, -1):
        below[tree.parent[n]] |= below[n]
    for n, points in below.items():
        away = np.linalg.norm(x[sorted(points)] - x[tree.centre[n]], axis=1)
        assert away.max() <= tree.radii[n] + 1e-9
    for n, (s, c) in enumerate(zip(tree.child_start, tree.child_count)):
        centres = x[[tree.centre[i] for i in tree.children[s:s + c]]]
        if c > 1:
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2) + 1e9 * np.eye(c)
            assert gaps.min() >= tree.radii[n] / 2 - 1e-9


def test_approximate_search_finds_nine_of_ten(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 400)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "QUERY_ROWS", 40)
    rows = clustered(2000)
    found, wanted = results(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0, 20)), brute(rows, 20, 20)
    assert found.keys() == wanted.keys()
    hits = [len({v for v, _ in found[q]} & {v for v, _ in wanted[q]}) / 20 for q in wanted]
    assert np.mean(hits) >= 0.9 and all(len(found[q]) == 20 for q in wanted)
    scores = {(q, v): s for q, rest in brute(rows, 20, 2000).items() for v, s in rest}
    for q, rest in found.items():
        assert all(abs(scores[q, v] - s) < 1e-9 for v, s in rest)
        assert rest == sorted(rest, key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("module", [ann, top_k])
def test_odd_vectors(spark, module):
    good = [(i, [float(i % 5), 1.0, -2.0]) for i in range(12)]
    odd = [(20, None), (40, []), (60, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]), (100, [float("inf"), 0.0, 0.0]),
           (120, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    for kind in ("float", "double"):
        found = results(module.search(table(spark, good + odd, kind), F.col("vec_id") % 10 == 0, 5))
        assert found == brute(good, 10, 5, whole=module is top_k)
    few = results(module.search(table(spark, good[:3]), F.col("vec_id") % 10 == 0, 5))
    assert [len(x) for x in few.values()] == [2]
    assert module.search(table(spark, good).limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0
    zero = results(module.search(table(spark, [*good, (30, [0.0, 0.0, 0.0])]), F.col("vec_id") == 30, 3))
    assert zero == ({30: [(0, 0), (1, 0), (2, 0)]} if module is top_k else {})
    twice = results(module.search(table(spark, [*good, good[0]]), F.col("vec_id") == 0, 3))
    assert twice == {0: brute(good, 100, 3, whole=module is top_k)[0]}


def test_scores_that_cannot_be_exact_are_refused(spark):
    rows = [(i, [1e13, 1.0]) for i in range(0, 300, 100)]
    with pytest.raises(ValueError, match="not exact"):
        top_k.search(table(spark, rows), F.col("vec_id") % 100 == 0, 2)
