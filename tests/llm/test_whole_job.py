"""Whole jobs: what earlier forms of the operators cut, held against literal results."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from docspark.llm import ann, language_bits, line_dedup, quality
from tests.llm.conftest import SMALL
from tests.llm.test_vectors import brute, clustered, results, table


def line_after(spark, first, second):
    """What is left of ``second`` when ``first`` stands in an earlier document."""
    df = spark.createDataFrame([(1, first), (2, second)], "doc_id bigint, text string")
    return {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}[2]


def test_lines_with_a_similarity_of_085_are_linked(spark):
    base = "we met at {} the old mill by the river and sat in the sun the old mill by the river and sat in the sun"
    # 0.885 of 0.85; below 0.85 the line stays.
    assert line_after(spark, base.format("counterrevolutionaries"), base.format("deinstitutionalized")) == ""
    far = base.format("deinstitutionalized and all of it was good")
    assert line_after(spark, base.format("counterrevolutionaries"), far) == far


def test_short_words_are_in_the_simhash(spark):
    df = spark.createDataFrame([(1, "we sat by the old mill")], "doc_id bigint, text string")
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in ("we", "sat", "by", "the", "old", "mill")]
    wanted = sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) > 3)
    norms = line_dedup.norms_of(df).select(F.col("doc_id").alias("v"), "norm")
    assert line_dedup.simhashes(norms).first().sim % (1 << 64) == wanted


def test_nine_of_ten_lines_with_one_word_changed_are_linked(spark):
    random = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    word = lambda: "".join(random.choice(letters, 6))
    rows, sizes = [], (6, 10, 20, 30)
    for i in range(240):
        size = sizes[i % 4]
        line = [word() for _ in range(size)]
        other = list(line)
        # One changed word of six is below 0.85 unless most of its letters stay.
        at = random.integers(size)
        other[at] = other[at][:3] + word()[:3] if size == 6 else word()
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = [r.doc_id // 2 % 4 for r in line_dedup.dedup_lines(df).collect() if r.doc_id % 2 and r.text]
    assert all(left.count(i) <= 6 for i in range(4))


def test_neighbours_come_from_the_visited_lists_alone(spark, monkeypatch):
    monkeypatch.setattr(ann, "PROBED", 0.01)  # one list, and further ones only for want of rows
    rows = [(i, v) for i, v in clustered(600)]
    found, wanted = results(ann.search(table(spark, rows), F.col("vec_id") % 20 == 0, 5)), brute(rows, 20, 5)
    assert all(len(found[q]) == 5 for q in wanted)
    # The sample holds the whole table: with its rows as results, this would be brute force.
    assert found != wanted


def test_copies_of_a_candidate_take_one_place(spark):
    rows = [(i, v) for i, v in clustered(200)]
    wanted = brute(rows, 50, 5)
    nearest = wanted[0][0][0]
    copies = rows + [r for r in rows if r[0] == nearest] * 8
    found = results(ann.search(table(spark, copies), F.col("vec_id") % 50 == 0, 5))
    assert len(found[0]) == 5 and len(set(found[0])) == 5 and found[0][0] == wanted[0][0]


def test_unlike_texts_of_one_id_or_none_all_stay(spark):
    text = lambda w: " ".join(f"{w}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (None, text("b") + " more"), (3, text("c")), (3, text("d")),
            (3, text("d")), (3, text("d") + " more"), (4, text("c")), (None, ""), (None, ""), (5, ""), (5, ""), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = corpus_pipeline.keep_one_of_each_group(spark, docs, SMALL).collect()
    found = sorted((str(r.doc_id), (r.text or "")[:2]) for r in left)
    assert found == sorted([("None", "a0"), ("None", "b0"), ("3", "c0"), ("3", "d0"), ("None", ""), ("None", ""), ("5", ""), ("6", "")])


def test_quality_that_lies_in_the_words(spark):
    random = np.random.default_rng(4)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x4E00, 0x4F00)))):
        words = ["".join(random.choice(list(letters), 5)) for _ in range(600)]
        docs, labels = [], []
        for i in range(400):
            own = words[:200] if i % 2 else words[200:400]
            docs.append((i, " ".join(random.choice(own + words[400:], 60))))
            labels.append((i, i % 2))
        df = spark.createDataFrame(docs, "doc_id bigint, text string")
        model = quality.fit(df, spark.createDataFrame(labels, "doc_id bigint, quality int"), F.col("doc_id") < 300)
        scores = quality.vote(model, [t for _, t in docs[300:]])
        assert np.mean([(s >= 0.5) == y for s, (_, y) in zip(scores, labels[300:])]) >= 0.9


def test_rare_and_shared_ngrams_are_in_the_filters(spark):
    rows = [("aaaa " * 300_000 + "qxzv ", "x"), ("mnop " + "qxzv " * 21, "y")]
    model = language_bits.train(spark.createDataFrame(rows, "text string, lang string"))
    codes, _ = language_bits.grams(["qxzv"])
    masks = np.bitwise_and.reduce([model["slices"][0][p.astype(np.int64)] for p in language_bits.positions(codes, model["bits"])])
    # " qxz" stands once in x, after a million others, and is dominant in y.
    assert masks[0] == 3
    assert language_bits.decide(model, ["qxzv"])[0] == ["y"]
