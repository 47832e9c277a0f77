"""Near-duplicates and line deduplication against brute force."""

import time
from collections import defaultdict
from functools import partial
from itertools import combinations

import numpy as np
import regex
import xxhash
from pyspark.sql import functions as F

from docspark.llm import line_dedup, linking, near_duplicates
from docspark.llm.linking import connected_groups
from tests.llm.conftest import SMALL


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def near_groups(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    links = [(a, b) for a, b in combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, groups_of(sets, links)


def near_copies(seed):
    """Groups around the threshold, a chain, small sets, a shared passage and hot copies."""
    random = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(3000)]
    base = lambda n: list(random.choice(words, n))
    texts, passage = [], base(60)
    for size in (6, 8, 9, 12, 20, 40, 60, 120, 400):
        one = base(size)
        texts.append(one)
        for _ in range(6):
            other = list(one)
            for at in random.choice(size, max(1, size // 40), replace=False):
                other[at] = f"n{random.integers(1e6)}"
            texts.append(other)
        texts += [one[1:], one[:-1], one + base(1), [w.upper() for w in one]]
    texts += [base(20) + passage + base(20) for _ in range(40)]
    chain = base(100)
    texts += [chain[i * 5:] + base(1) for i in range(8)]
    return {i: " ".join(t) for i, t in enumerate(texts)}


def test_near_duplicates_equal_brute_force(spark):
    texts = near_copies(1) | {r.doc_id + 10_000: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sets, wanted = near_groups(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r for r in near_duplicates.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in found.items()} == wanted
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == wanted[i]) for i, r in found.items())


def test_vertices_that_meet_again_lose_no_link(spark, monkeypatch):
    # Without rounds, all that the stars leave open meets by its rarest values.
    monkeypatch.setattr(near_duplicates, "link_lists", partial(linking.link_lists, rounds=0))
    texts = near_copies(2)
    sets, wanted = near_groups(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df).collect()} == wanted


def test_many_unlike_texts_that_share_a_passage(spark, monkeypatch):
    random = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(45))
    texts = {i: passage + " " + " ".join(f"w{x}" for x in random.integers(0, 10**9, 65)) for i in range(3000)}
    wanted = {i: i for i in texts}
    for i in range(0, 60, 2):
        # One word changed in the own part.
        texts[3000 + i] = texts[i].rsplit(" ", 1)[0] + " other"
        wanted[3000 + i] = i
    formed = []
    confirm = near_duplicates.confirm

    def counting(pairs, given):
        formed.append(pairs.count())
        return confirm(pairs, given)

    monkeypatch.setattr(near_duplicates, "confirm", counting)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(8)
    assert {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df).collect()} == wanted
    assert sum(formed) < 20 * len(texts)


def test_near_duplicates_odd_rows(odd, nothing):
    rows = near_duplicates.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.n_shingles == 0:
            assert r.component_id == r.doc_id and r.kept
    null = [r for r in rows if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in null] == [(4, False)]
    assert [r.n_shingles for r in rows if r.doc_id == 4] == [1, 1, 1]
    assert near_duplicates.near_duplicates(nothing).count() == 0


def test_connected_groups_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (5000, 4000), (5000, 3000)]
    wanted = groups_of({x for link in links for x in link}, links)
    df = spark.createDataFrame(links, "a bigint, b bigint")
    assert {r.v: r.root for r in connected_groups(df).collect()} == wanted
    assert connected_groups(df.limit(0)).count() == 0


def line_facts(line):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w]
    bits = np.zeros(64, int)
    parts = [w for w in words if len(w) >= line_dedup.LONG] or words
    for w in parts:
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        bits += (h >> np.arange(64, dtype=np.uint64)) & np.uint64(1) == 1
    sim = sum(1 << i for i in range(64) if 2 * bits[i] > len(parts))
    return " ".join(words), sim


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def deduped(texts):
    """Texts without repeated lines, by comparing all pairs of lines."""
    places, sims = defaultdict(list), {}
    for doc, text in sorted(texts.items()):
        for pos, line in enumerate((text or "").split("\n")):
            norm, sim = line_facts(line)
            if norm:
                places[norm].append((doc, pos))
                sims[norm] = sim
    links = []
    for a, b in combinations(sims, 2):
        longest = max(len(a), len(b))
        few = max(len(a.split()), len(b.split())) <= line_dedup.SHORT
        if ((few or (sims[a] ^ sims[b]).bit_count() <= line_dedup.DISTANCE)
                and min(len(a), len(b)) >= line_dedup.SIMILARITY * longest
                and edit_distance(a, b) <= int((1 - line_dedup.SIMILARITY) * longest + 1e-9)):
            links.append((a, b))
    root = groups_of(sims, links)
    members = defaultdict(list)
    for norm, at in places.items():
        members[root[norm]] += at
    gone = {p for at in members.values() for p in set(at) - {min(at)}}
    return links, {doc: "\n".join(x for i, x in enumerate(t.split("\n")) if (doc, i) not in gone) for doc, t in texts.items()}


def test_line_dedup_equals_brute_force(spark):
    random = np.random.default_rng(5)
    words = [f"word{i}" for i in range(300)]
    texts, shared = {}, [" ".join(random.choice(words, 60)) for _ in range(6)]
    for doc in range(60):
        lines = []
        for _ in range(random.integers(1, 5)):
            line = str(random.choice(shared)) if random.random() < 0.5 else " ".join(random.choice(words, random.integers(1, 30)))
            if random.random() < 0.5:
                parts = line.split()
                parts[random.integers(len(parts))] += str(random.choice(["", "s", "x"]))
                line = " ".join(parts)
            lines.append(line.title() if random.random() < 0.3 else line)
        texts[doc] = "\n".join([*lines, "", "!!"])
    links, wanted = deduped(texts)
    assert links
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == wanted


def test_long_lines_count_all_words(spark):
    long = " ".join(f"w{i}" for i in range(1000))
    df = spark.createDataFrame([(1, long), (2, "a b c")], "doc_id bigint, text string")
    norms = line_dedup.norms_of(df).select(F.col("doc_id").alias("v"), "norm")
    found = {r.v: r.sim for r in line_dedup.simhashes(norms).collect()}
    for doc, text in ((1, long), (2, "a b c")):
        sim = line_facts(text)[1]
        assert found[doc] == (sim - (1 << 64) if sim >> 63 else sim)


def test_pairs_of_lines_that_must_meet(spark):
    lines = [
        "the quick brown fox jumps over the lazy dog while the old grey cat sleeps under the big oak tree near the river bank today",
        "the quick brown fox jumps over the lazy dog while the old grey cat sleeps under the big oak tree near the river bank tonight",
        "the quick brown bear jumps over the lazy dog while the young grey cat sleeps under the big oak tree near the river bank today",
        "short line number one", "short line numbr one", "internationalisation", "internationalization",
        "a wholly different line about nothing that any of the others says"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id bigint, text string")
    kept = {r.doc_id for r in line_dedup.dedup_lines(df).collect() if r.text}
    assert kept == {0, 3, 5, 7}


def test_line_dedup_odd_rows(odd, nothing):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    assert [r.text for r in rows if r.doc_id == 0] == [None]
    assert [r.text for r in rows if r.doc_id == 1] == [""]
    assert [r.text for r in rows if r.doc_id == 7] == ["\n\n\n"]
    assert [r.text for r in rows if r.doc_id == 4] == ["Ab cd"] * 3
    assert [r.text for r in rows if r.doc_id is None] == [""]
    assert {"lang", "source", "row_hash", "n_lines", "n_dropped"} <= set(rows[0].asDict())
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_no_pair_is_tested_twice(spark):
    """Lists of two name the same pair in every round, and lists that two vertices share name it again."""
    from docspark.llm.linking import link_lists

    lists = spark.createDataFrame([(k, v) for k in range(6) for v in (k // 2 * 10, k // 2 * 10 + 1)] + [(9, 0), (9, 10), (9, 20), (9, 21)],
                                  "key bigint, v bigint")
    vertices = lists.select("v").distinct().withColumn("n", F.lit(1))
    for parts in (None, lambda opened: opened.select("v", F.lit(1).cast("bigint").alias("size"), F.lit(7).cast("bigint").alias("value"))):
        seen = []

        def verify(pairs):
            seen.extend(tuple(r) for r in pairs.collect())
            return pairs.where("a = 20 AND b = 21")

        groups = link_lists(lists, vertices, lambda x, y: F.col(f"{x}n") == F.col(f"{y}n"), verify, parts=parts, share=75)
        assert {tuple(r) for r in groups.collect()} == {(20, 20), (21, 20)}
        assert len(seen) == len(set(seen)) and {(0, 1), (10, 11), (20, 21)} <= set(seen)


def test_one_list_for_each_set_of_members(spark):
    """Copies share all their keys: of lists with the same members one is looked at."""
    rows = [(k, v) for k in range(8) for v in (1, 2, 3)] + [(k, v) for k in (10, 11) for v in (1, 2)] + [(20, 4), (30, 5), (30, 5), (31, 6), (31, 6)]
    lists = linking.shared_lists(spark.createDataFrame(rows, "key bigint, v bigint"))
    members = defaultdict(list)
    for r in lists.collect():
        members[r.key].append(r.v)
    assert sorted(sorted(m) for m in members.values()) == [[1, 2], [1, 2, 3], [5, 5], [6, 6]]


def test_each_vertex_meets_one_star_first(spark):
    """A copy whose lists have several smallest members met each of them."""
    rows = [(k, v) for k, least in enumerate((0, 0, 0, 1, 1, 2)) for v in (least, *range(10, 40))]
    lists = spark.createDataFrame(rows, "key bigint, v bigint")
    vertices = lists.select("v").distinct().withColumn("n", F.lit(1))
    seen = []

    def verify(pairs):
        seen.append(sorted(tuple(r) for r in pairs.collect()))
        return pairs

    groups = linking.link_lists(lists, vertices, lambda x, y: F.col(f"{x}n") == F.col(f"{y}n"), verify)
    assert {tuple(r) for r in groups.collect()} == {(v, 0) for v in (0, 1, 2, *range(10, 40))}
    assert seen[0] == [(0, v) for v in range(10, 40)] and sum(map(len, seen)) < 40


def test_groups_joined_by_more_links(spark):
    links = [(i, i + 1) for i in range(0, 60, 3)] + [(i + 1, i + 2) for i in range(0, 60, 3)]
    more = [(2, 3), (5, 30), (31, 58), (100, 101), (7, 200), (6, 8)]
    groups = connected_groups(spark.createDataFrame(links, "a bigint, b bigint"))
    found = linking.joined_groups(groups, spark.createDataFrame(more, "a bigint, b bigint"))
    wanted = groups_of({x for link in links + more for x in link}, links + more)
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted.items())


def test_edit_distance_without_common_ends(spark, monkeypatch):
    """Common ends are left out, a missing blank counts, and the short cuts accept nothing beyond the bound."""
    monkeypatch.setattr(line_dedup, "PIECES", (2, 5))
    random = np.random.default_rng(4)
    words = ["a", "bb", "ccc", "dddd", "ab", "b", "word", "longerword", "\u00e9"]
    pairs = [("ab longerword ab longerword longerword bb", "ab ab longerword longerword bb"), ("a", "a a"), ("a b", "b")]
    for _ in range(600):
        x = list(random.choice(words, random.integers(1, 15)))
        y = list(x)
        for _ in range(random.integers(0, 4)):
            at, kind = random.integers(len(y)), random.integers(3)
            y[at:at + (kind != 1)] = [random.choice(words)] if kind or len(y) == 1 else []
        pairs.append((" ".join(x), " ".join(y)))
    rows = [(x, y, bound) for x, y in pairs for bound in (edit_distance(x, y) - 1, edit_distance(x, y)) if bound >= 0]
    df = spark.createDataFrame(rows, "x string, y string, bound int")
    found = df.withColumn("near", line_dedup.edits_within(F.col("x"), F.col("y"), F.col("bound"))).collect()
    assert all(r.near == (edit_distance(r.x, r.y) <= r.bound) for r in found)


def test_sums_of_pieces_end_at_the_bound(spark):
    """Unlike lines are far beyond the bound after a few pieces; all others were compared as well."""
    random = np.random.default_rng(6)
    line = lambda: " ".join("".join(chr(97 + c) for c in random.integers(0, 26, 7)) for _ in range(2500))
    df = spark.createDataFrame([(line(), line()) for _ in range(24)], "x string, y string").repartition(1).cache()
    at = F.sequence(F.lit(1), F.length("x"), F.lit(1024))
    pieces = F.aggregate(at, F.lit(0), lambda total, i: total + F.levenshtein(F.substring("x", i, F.lit(1024)), F.substring("y", i, F.lit(1024))))

    def seconds(value):
        took = []
        for _ in range(2):
            start = time.perf_counter()
            assert df.where(value).count() == 0
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds(line_dedup.edits_within(F.col("x"), F.col("y"), F.lit(100))) < seconds(pieces <= 100) / 2
    df.unpersist()
