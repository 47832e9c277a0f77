import math

import pytest
from pyspark.sql import functions as F

from docspark.operators import language as L
from docspark.session import materialize

SENTENCES = [
    ("en", "The quick brown fox jumps over the lazy dog"),
    ("es", "El rápido zorro marrón salta sobre el perro perezoso"),
    ("de", "Der schnelle braune Fuchs springt über den faulen Hund"),
]


@pytest.fixture(scope="module")
def profiles(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return materialize(L.train_language_profiles(documents), "profiles")


def detected(df, profiles):
    return L.language_confidence(L.detect_language(df, profiles))


def test_sentences_are_certain(spark, profiles):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(SENTENCES)], "doc_id int, text string")
    rows = detected(df, profiles).orderBy("doc_id").collect()
    assert [r["language"] for r in rows] == [lang for lang, _ in SENTENCES]
    assert all(r["confidence"] == "HIGH" and r["raw_score"] > 0.9 for r in rows)


def test_digits_are_low_and_blank_is_none(spark, profiles):
    df = spark.createDataFrame([(0, "123"), (1, "  \n"), (2, None)], "doc_id int, text string")
    rows = detected(df, profiles).orderBy("doc_id").collect()
    assert [r["confidence"] for r in rows] == ["LOW", "NONE", "NONE"]
    assert [r["language"] is None for r in rows] == [False, True, True]


def test_in_place_and_joined_scores_agree(spark, profiles):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, ""), (-2, None), (-3, "123"), (-4, "𝒜𝒷𝒸 text 😀")], "doc_id bigint, text string")
    df = documents.unionByName(extra)
    columns = ["doc_id", "language", "raw_score", "confidence"]
    joined = sorted(map(tuple, detected(df, profiles).select(columns).collect()))
    inline = sorted(map(tuple, L.with_language(df, profiles, ["doc_id"]).select(columns).collect()))
    assert inline == joined


def test_large_profiles_take_the_join(spark, profiles):
    df = spark.createDataFrame([(1, "the text")], "doc_id int, text string")
    plans = [L.score_languages(df, profiles, ["doc_id"], limit=limit)._jdf.queryExecution().toString() for limit in (10, 1_000_000)]
    assert ["ArrowEvalPython" in p for p in plans] == [False, True]


def test_weights_of_a_tiny_corpus(spark):
    df = spark.createDataFrame([("ab", "x"), ("ab", "y"), ("b", "y")], "text string, lang string")
    rows = {(r["lang"], r["gram"]): r["weight"] for r in L.train_language_profiles(df).collect()}
    assert set(rows) == {("x", "_ab"), ("x", "ab_"), ("x", ""), ("y", "_ab"), ("y", "ab_"), ("y", "_b_"), ("y", "")}
    assert rows[("x", "_ab")] == round(math.log(2 / 5) * 1e6)
    assert rows[("x", "")] == round(math.log(1 / 5) * 1e6)
    assert rows[("y", "_b_")] == round(math.log(2 / 6) * 1e6)


def test_one_language_with_most_rows_is_counted_whole(spark):
    df = spark.range(3000).select(F.lit("aa").alias("text"), F.when(F.col("id") % 3 == 0, "x").otherwise("hot").alias("lang"))
    rows = {r["lang"]: r["weight"] for r in L.train_language_profiles(df).filter("gram = '_aa'").collect()}
    assert rows == {"x": round(math.log(1001 / 2002) * 1e6), "hot": round(math.log(2001 / 4002) * 1e6)}


@pytest.mark.parametrize("n", [2, 3, 4])
def test_both_plans_agree_on_equal_and_missing_ids(spark, n):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trained = materialize(L.train_language_profiles(documents, n=n), "profiles")
    rows = [(1, "the thing and the other"), (1, "der die und das"), (None, "le la et les"), (None, None), (2, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(documents.select("doc_id", "text"))
    columns = ["doc_id", "text", "language", "raw_score", "confidence"]
    inline, joined = (sorted(map(tuple, L.with_language(df, trained, ["doc_id"], limit=limit).select(columns).collect()), key=repr)
                      for limit in (1_000_000, 5))
    assert inline == joined and len(inline) == df.count()


def test_grams_are_counted_before_rows_are_made_of_them(spark):
    """One row per gram, language and task, for grams of any length and letters beyond the 16-bit plane."""
    rows = [("en", "Aa\U00010400b aab"), ("en", "aab"), ("de", ""), (None, "abc"), ("de", None), ("el", "\u039f\u03a3 7")]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    for n in (1, 2, 3, 4):
        expected = {}
        for lang, text in rows:
            if lang and text:
                folded = {"Aa\U00010400b aab": "_aa\U00010428b_aab_", "aab": "_aab_", "\u039f\u03a3 7": "_\u03bf\u03c2_"}[text]
                for i in range(len(folded) - n + 1):
                    key = (lang, folded[i:i + n])
                    expected[key] = expected.get(key, 0) + 1
        folded = df.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", L.fold_letters(F.col("text")).alias("text"))
        found = L._partial_counts(folded, n).collect()
        expected |= {("de", "_"): 1} if n == 1 else {}
        assert {(r.lang, r.gram): r.n for r in found} == expected and len(found) == len(expected)
