"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from docspark.llm import queries, spelling
from tests.llm.conftest import MEDIUM, ODD_TEXTS, SMALL


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def variants(words):
    """Neighbours by trying every word with one letter left out, which is another method than the operator's."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1:]]
            if (shorter := w[:i] + w[i + 1:]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
        near[w].discard(w)
    out, form = {}, {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = (n, len(near[w]), words[form[w]] if form[w] else None)
    result = []
    for w, (n, k, m) in out.items():
        root = w
        while form[root]:
            root = form[root]
        result.append((w, form[w], root, n, k, m))
    return sorted(result)


def found(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_query_equals_brute_force(spark):
    for folder in (SMALL, MEDIUM):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        assert found(queries.op11_spelling(spark, folder)) == variants(counted(rows))


def made_words(count, seed, letters="abcdé"):
    pick = random.Random(seed)
    return ["".join(pick.choice(letters) for _ in range(pick.randrange(7, 11))) for _ in range(count)]


def test_split_trees_lose_no_neighbour(spark, monkeypatch):
    words = made_words(3000, 1) + [w * 3 for w in made_words(200, 2)]
    random.seed(6)
    rows = [(i, " ".join(random.choices(words, k=400))) for i in range(60)]
    rows += [(100, "aaaaaaa " * 30 + "aaaaaab " * 2 + "aaaaabb " * 400), (101, None), (None, "aaaaaab")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = variants(counted(rows))
    for leaf in (8192, 40, 1):
        monkeypatch.setattr(spelling, "LEAF", leaf)
        assert found(spelling.spelling_variants(df)) == wanted


def test_words_of_equal_counts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF", 16)
    pick = random.Random(3)
    words = {"".join(pick.sample("abcdefghi", 9)) for _ in range(300)}
    words |= {w[:3] + "x" + w[4:] for w in list(words)[:80]} | {w[:5] + w[6:] for w in list(words)[:80]}
    rows = [(1, " ".join(sorted(words) * 2))]
    rows = [(i, t) for i in range(2, 4) for _, t in rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(spelling.spelling_variants(df)) == variants(counted(rows))


def test_chains_end_at_the_root(spark):
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb"]
    text = " ".join(" ".join([w] * 2 * 10 ** i) for i, w in enumerate(chain))
    rows = [(i, text) for i in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = variants(counted(rows))
    assert found(spelling.spelling_variants(df)) == wanted
    assert {r[2] for r in wanted if r[3] > 2} == {chain[-1]}


def test_one_edit_is_exact():
    grid = lambda *words: np.array([list(w.encode()) for w in words], np.uint8)
    pairs = [("abcdefg", "abcdefg", False), ("abcdefg", "abcxefg", True), ("abcdefg", "bacdefg", False), ("abcdefg", "xabcdefg", True),
             ("abcdefg", "abcdefgx", True), ("abcdefg", "abcxdefg", True), ("abcdefg", "bacdxefg", False), ("aaaaaaa", "aaaaaaaa", True)]
    for a, b, near in pairs:
        assert spelling.one_edit(grid(a), grid(b))[0] == near


def test_odd_rows_and_no_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert len(rows) > len(ODD_TEXTS)
    assert found(spelling.spelling_variants(odd)) == variants(counted(rows))
    assert spelling.spelling_variants(nothing).count() == 0
