"""Quality and language against held-out labels, and their odd cases."""

import numpy as np
from pyspark.sql import functions as F

from docspark.llm import language_bits, quality
from docspark.llm.queries import QUERIES
from tests.llm.conftest import MEDIUM


def test_quality_on_held_out_labels(spark):
    found = QUERIES["op1_quality"](spark, MEDIUM)
    both = found.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(both) > 50
    assert np.mean([r.predicted == r.quality for r in both]) > 0.97
    assert all(0 <= r.score <= 1 for r in both)


def test_vote_equals_brute_force(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.fit(documents, labels, F.lit(True))
    texts = [r.text for r in documents.orderBy("doc_id").limit(20).collect()]
    latent = quality.features(texts) @ model["projection"]
    for row, score in zip(latent, quality.vote(model, texts)):
        cosines = np.array([np.dot(row, v) / np.linalg.norm(row) for v in model["vectors"]])
        near = np.argsort(-cosines)[:quality.NEIGHBOURS]
        weights = np.clip(cosines[near], 0, None) ** quality.SHARPNESS
        assert abs((weights * model["labels"][near]).sum() / weights.sum() - score) < 0.02


def test_quality_odd_rows(spark, odd, nothing, documents):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (77, 1)], "doc_id bigint, quality int")
    model = quality.fit(odd, labels, F.lit(True))
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if not r.text} == {model["prior"]} == {0.5}
    empty = quality.fit(nothing, labels, F.lit(True))
    assert {r.score for r in quality.score_quality(odd, empty).collect()} == {0.5}
    assert quality.score_quality(nothing, model).count() == 0


def test_language_on_held_out_rows(spark):
    found = QUERIES["op5_language"](spark, MEDIUM)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    both = found.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(both) > 200
    assert np.mean([r.lang_pred == r.lang for r in both]) > 0.98


def test_filters_hold_every_gram_of_their_language(spark):
    docs = spark.createDataFrame(
        [("abcd efgh ijkl", "x"), ("mnop qrst uvwx", "y"), ("abcd efgh", "x"), (None, "x"), ("zzzz", None)],
        "text string, lang string")
    model = language_bits.train(docs)
    assert model["names"] == ["x", "y"]
    for text, lang in (("abcd efgh ijkl", 0), ("mnop qrst uvwx", 1)):
        codes, _ = language_bits.grams([text])
        masks = None
        for at in language_bits.positions(codes, model["bits"]):
            found = model["slices"][0][at.astype(np.int64)]
            masks = found if masks is None else masks & found
        assert all(int(m) >> lang & 1 for m in masks)
    assert language_bits.decide(model, ["ABCD, efgh!", "uvwx", None, "12 !!", ""])[0] == ["x", "y", "und", "und", "und"]


def test_language_odd_rows(odd, nothing):
    model = language_bits.train(odd)
    rows = language_bits.identify(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    letterless = [r for r in rows if not any(c.isalpha() for c in r.text or "")]
    assert letterless and all(r.lang_pred == "und" for r in letterless)
    assert all(r.lang_pred in ("en", "de") for r in rows if any(c.isalpha() for c in r.text or ""))
    untrained = language_bits.train(nothing)
    assert {r.lang_pred for r in language_bits.identify(odd, untrained).collect()} == {"und"}
    assert language_bits.identify(nothing, model).count() == 0
