"""Language-model scores: exact base, filter levels, both ways to the filter, and what the model knows."""

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import language_model as lm
from docspark.llm import queries
from tests.llm.conftest import SMALL


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))


def base(rows, held):
    counts = Counter(t for d, x in rows if not held(d) for t in [*words_of(x), None])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, x in rows:
        tokens = [*words_of(x), None]
        out.append((str(d), held(d), len(tokens), sum(counts[t] > 0 for t in tokens), total,
                    round(sum(log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens), 6)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


def test_query_has_the_exact_base(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    wanted = base(rows, lambda d: zlib.crc32(str(d).encode()) % 7 == 2)
    for got, want in zip(found(queries.op12_language_model(spark, SMALL)), wanted, strict=True):
        assert got[:5] == want[:5] and abs(got[5] - want[5]) < 1e-5


def test_rare_words_are_joined(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)
    model = lm.train(documents)
    assert 0 < len(model["known"]) <= 50 and model["any_rare"]
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    scored = lm.score_texts(documents, model, keep=["doc_id"]).withColumn("held_out", F.lit(False))
    for got, want in zip(found(scored), base(rows, lambda d: False), strict=True):
        assert got[:5] == want[:5] and abs(got[5] - want[5]) < 1e-5


def test_both_ways_to_the_filter_agree(spark, documents, odd):
    model = lm.train(documents, order=3)
    for df in (documents.select("doc_id", "text"), odd):
        one = lm.score_texts(df, model, keep=["doc_id"])
        two = lm.score_texts(df, model, keep=["doc_id"], filter_bytes=0)
        pick = lambda d: sorted((str(r.doc_id), r.n_tokens, round(r.score, 9)) for r in d.collect())
        assert pick(one) == pick(two)


def plain_scores(texts, trained, order):
    """The model with exact counts rounded to their level's middle: what a filter without false positives gives."""
    grams = Counter()
    for t in trained:
        seq = ["<s>", *words_of(t), "</s>"]
        for size in range(1, order + 1):
            grams.update(tuple(seq[i:i + size]) for i in range(len(seq) - size + 1))
    single = {g: n for g, n in grams.items() if len(g) == 1 and g != ("<s>",)}
    total, distinct = sum(single.values()), len(single)
    mid = lambda g: float(lm.middle(np.array([grams[g].bit_length()]))[0])

    def count(g):
        return min(mid(g[i:]) for i in range(len(g)))

    def p(g):
        if len(g) == 1:
            return (mid(g) + 1) / (total + distinct + 1)
        c = count(g[:-1])
        return (min(count(g), c) + lm.PRIOR * p(g[1:])) / (c + lm.PRIOR)

    out = []
    for t in texts:
        seq = ["<s>", *words_of(t), "</s>"]
        out.append(sum(log10(p(tuple(seq[max(0, i - order + 1):i + 1]))) for i in range(1, len(seq))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_follow_the_quantised_counts(spark, documents, order):
    texts = [r.text for r in documents.orderBy("doc_id").limit(60).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = lm.train(df.where("doc_id < 40"), order=order)
    got = [r.score for r in lm.score_texts(df, model).orderBy("doc_id").collect()]
    want = plain_scores(texts, texts[:40], order)
    # Known n-grams are exact: a filter has no false negatives, and few false positives show in the sums.
    for i, (a, b) in enumerate(zip(got, want)):
        assert abs(a - b) <= (0.02 if i < 40 else 0.06) * abs(b) + 1e-6


def test_filter_has_no_false_negative_and_few_false_positives():
    h = np.random.default_rng(1).integers(0, 1 << 63, 100_000, np.uint64)
    n = np.random.default_rng(2).integers(1, 4, 100_000)
    cells = np.frombuffer(lm.fill_block(h, n), np.uint8)
    found = lm.levels_in(cells, h, np.zeros(len(h), np.int64))
    levels = np.frexp(n.astype(float))[1]
    assert (found >= levels).all() and (found > levels).mean() < 0.07
    others = np.random.default_rng(3).integers(0, 1 << 63, 100_000, np.uint64)
    assert (lm.levels_in(cells, others, np.zeros(len(h), np.int64)) > 0).mean() < 0.07


def test_familiar_texts_score_higher(spark, documents):
    model = lm.train(documents)
    shuffled = documents.withColumn("text", F.array_join(F.reverse(F.split("text", " ")), " "))
    a = {r.doc_id: r.score for r in lm.score_texts(documents, model, keep=["doc_id"]).collect()}
    b = {r.doc_id: r.score for r in lm.score_texts(shuffled, model, keep=["doc_id"]).collect()}
    assert np.mean([a[d] > b[d] for d in a]) > 0.9


def test_odd_rows_no_rows_and_no_training(spark, odd, nothing):
    model = lm.train(odd)
    rows = lm.score_texts(odd, model).collect()
    assert len(rows) == odd.count() and all(r.n_known == r.n_tokens and np.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if not (r.text or "").split()} == {1}
    assert lm.score_texts(nothing, model).count() == 0
    empty = lm.train(nothing)
    rows = lm.score_texts(odd, empty).collect()
    assert all(r.n_known == 0 and r.base_score == 0 and r.train_tokens == 0 for r in rows)
    clashing = lm.score_texts(odd.withColumn("Score", F.lit(1)).withColumn("rare_words", F.lit("r")), model)
    assert {(r.Score, r.rare_words, r.score_ <= 0) for r in clashing.collect()} == {(1, "r", True)}
