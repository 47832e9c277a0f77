"""Mixing: targets, pieces and texts."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docspark.llm import mixing
from tests.llm.conftest import MEDIUM


def filled(sizes):
    """Targets by sharing again and again: sources in order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 7, None: 50}, {"Z": 10, "a": 0, "é": 3000, "b": 2},
    {"a": 5}, {"a": 0, "b": 0}])
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(df).collect()}
    wanted = filled(sizes)
    assert found.keys() == wanted.keys()
    for s in wanted:
        assert abs(found[s] - wanted[s]) <= 1e-6 * max(1, wanted[s])


def test_permutation_is_one(spark):
    for size in (1, 2, 7, 100, 1001):
        rows = spark.range(size).select(mixing.permute(F.col("id"), F.lit(size).cast("bigint"), F.lit(5).cast("bigint")).alias("p"))
        found = [r.p for r in rows.collect()]
        assert sorted(found) == list(range(size))
        assert size < 100 or found != list(range(size))


def test_mix_of_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = mixing.mix_pieces(docs).withColumn("taken", mixing.taken_words(F.col("pieces"))).collect()
    again = mixing.mix_pieces(docs.repartition(7)).withColumn("taken", mixing.taken_words(F.col("pieces"))).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == words
    total, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        total[r.source] += r.taken
        target[r.source] = r.target
    assert abs(sum(target.values()) - sum(words.values())) < 1e-6 * sum(words.values())
    for s in target:
        assert abs(total[s] - target[s]) <= 0.02 * target[s] + 2 * mixing.BLOCK


def test_mixed_texts_hold_the_pieces(spark):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(i * 13 % 90)), "a" if i % 3 else None, i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, pieces int")
    made = {r.doc_id: r for r in mixing.mix_texts(df).collect()}
    for r in mixing.mix_pieces(df).collect():
        words = rows[r.doc_id][1].split()
        wanted = [w for p in r.pieces for _ in range(p.times) for w in words[p["first"]:p["first"] + p.words]]
        assert (made[r.doc_id].text if wanted else None) == (" ".join(wanted) if wanted else None)
        assert bool(wanted) == (r.doc_id in made)


def test_mixing_odd_rows(odd, nothing):
    rows = mixing.mix_pieces(odd).withColumn("taken", mixing.taken_words(F.col("pieces"))).collect()
    assert len(rows) == odd.count()
    assert [(r.size, r.taken) for r in rows if r.doc_id in (0, 1, 2, 7)] == [(0, 0)] * 4
    assert sorted(r.size for r in rows if r.doc_id == 4) == [2, 2, 2]
    assert mixing.mix_texts(odd).count() <= odd.count()
    assert mixing.mix_pieces(nothing).count() == 0 and mixing.mix_texts(nothing).count() == 0
