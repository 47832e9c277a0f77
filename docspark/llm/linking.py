"""Links and connected groups from inverted lists, without pairs inside a linked group.

A list names the vertices that share a key; of lists with the same members one is kept. First every vertex is tested
against one that is the smallest of a list (a star), the one that is so in most of its lists. Verified links are contracted
to groups. Only lists whose members are still in several groups are looked at again. In ``ROUNDS`` rounds, the members
outside a list's largest group are tested against one pseudorandom member of it, another one in each list and round, which
brings in almost all that belong to it. What is still outside meets the members of other groups. A list full of
copies costs as many pairs as it has members. No pair is tested twice: lists of few members, and lists that members
share, would name the same ones in every round. A round that links few is the last; what it leaves open meets at the end.

A list of many members that are not linked would cost the square of their number, and members that share many lists
would meet in each. Where the caller gives the values of a vertex and how many of them a linked one shares at least
(``parts``), what is still open meets otherwise: each vertex is listed under its values that are rarest among the open
ones, all but as many as it may miss. Two vertices with enough values in common share one of these, so no link is lost;
what many have in common keeps nobody together, and a vertex with too many values of its own is listed nowhere.
The first value that two have in common, rarest first, leaves room for no more common ones than stand behind it in both:
where that is too few for their sizes they do not meet. Only vertices that share nearly as many values as a link needs do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.session import materialize

#: Rounds in which outsiders meet one member of their list's largest group.
ROUNDS = 2
#: A round that links fewer than one in so many outsiders is the last.
WORTH = 4

#: Keys that may be broadcast, of 8 bytes each.
BROADCAST_KEYS = 200_000


def shared_lists(postings: DataFrame) -> DataFrame:
    """The rows of ``postings`` (key, v) whose key has two members at least, one key for each set of members.

    Keys are counted with partial sums, so a hot key is collapsed before it is shuffled. Up to
    ``BROADCAST_KEYS`` keys filter the postings where they are; beyond that a join moves them, which
    adaptive execution splits at a hot key. Copies share all of their keys, so most lists name the same
    vertices as another one; sets of members are known by their number and 128 bits.
    """
    def of(keys: DataFrame, rows: DataFrame) -> DataFrame:
        few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        return rows.join(F.broadcast(keys) if few else keys, "key", "left_semi")

    several = materialize(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys")
    lists = materialize(of(several, postings), "shared")
    # Sums of halves of a hash, which no list can overflow; unlike an exclusive or they count repeated rows.
    first, second = F.xxhash64("v"), F.xxhash64("v", F.lit("second"))
    low = F.lit(0xFFFFFFFF).cast("bigint")
    halves = [half for h in (first, second) for half in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
    sets = lists.groupBy("key").agg(F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(halves)])
    one = materialize(sets.groupBy("n", "s0", "s1", "s2", "s3").agg(F.min("key").alias("key")).select("key"), "sets")
    return materialize(of(one, lists), "lists")


def connected_groups(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``links`` (a, b); the root is the smallest vertex of the group.

    Each round orders the vertices anew by a hash, maps each to the first in its neighbourhood, follows
    the map once more, and contracts the links. Whatever the shape of a group, a round leaves it a
    fraction of its vertices, so rounds grow with the logarithm of its size. Each writes its links and its map.
    """
    links = links.select("a", "b").where("a <> b")
    steps: list[DataFrame] = []
    while True:
        links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if links.isEmpty():
            break
        near = (links.union(links.select(F.col("b"), F.col("a")))
                .union(links.select(F.col("a"), F.col("a"))).union(links.select(F.col("b"), F.col("b"))))
        first = F.min(F.struct(F.xxhash64("b", F.lit(len(steps) + 1)).alias("order"), "b"))
        hop = near.groupBy(F.col("a").alias("v")).agg(first.alias("to")).select("v", F.col("to.b").alias("to"))
        step = materialize(hop.join(hop.select(F.col("v").alias("to"), F.col("to").alias("next")), "to").select(
            "v", F.col("next").alias("to")), "step")
        steps.append(step)
        left = links.join(step.select(F.col("v").alias("a"), F.col("to").alias("a2")), "a")
        links = (left.join(step.select(F.col("v").alias("b"), F.col("to").alias("b2")), "b")
                 .where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")))
    if not steps:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root"))
    # From the last round back: its few vertices' ends, then those of the vertices that were contracted to them.
    found = steps.pop()
    while steps:
        found = _led_on(steps.pop(), found.select("v", F.col("to").alias("end")))
    found = materialize(found.select("v", F.col("to").alias("root")), "found")
    least = found.groupBy("root").agg(F.min("v").alias("least"))
    return materialize(found.join(least, "root").select("v", F.col("least").alias("root")), "groups")


def _led_on(step: DataFrame, ends: DataFrame) -> DataFrame:
    """``step`` (v, to) with ``to`` replaced by its end (v, end), where it has one."""
    return step.join(ends.withColumnRenamed("v", "to"), "to", "left").select("v", F.coalesce("end", "to").alias("to"))


def joined_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (v, root) with those that ``links`` (a, b) connect made one; only their roots are linked anew."""
    def rooted(rows: DataFrame, side: str) -> DataFrame:
        own = groups.select(F.col("v").alias(side), F.col("root").alias("own"))
        return rows.join(own, side, "left").withColumn(side, F.coalesce("own", side)).drop("own")

    merged = connected_groups(rooted(rooted(links.select("a", "b"), "a"), "b"))
    moved = _led_on(groups.select("v", F.col("root").alias("to")), merged.select("v", F.col("root").alias("end")))
    new = merged.join(groups.select("v"), "v", "left_anti")
    return materialize(moved.select("v", F.col("to").alias("root")).union(new.select("v", "root")), "groups")


def link_lists(
    lists: DataFrame, vertices: DataFrame, may_link: Callable[[str, str], Column],
    verify: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS,
    parts: Callable[[DataFrame], DataFrame] | None = None, share: int = 0,
) -> DataFrame:
    """(v, root) of every vertex that is linked to another one.

    ``lists`` holds (key, v); ``vertices`` v and what ``may_link("x.", "y.")`` compares; ``verify``
    keeps the pairs (a, b) that are links; ``parts`` gives for vertices (v) the rows (v, size, value): each of v's
    distinct values and their number. A link then has ``share`` / 100 of the union of values in common.
    """
    facts = [c for c in vertices.columns if c != "v"]

    def of(side: str, rows: DataFrame, on: str) -> DataFrame:
        return rows.join(vertices.select(F.col("v").alias(on), F.struct(*facts).alias(side)), on)

    asked: list[DataFrame] = []

    def unasked(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for earlier in asked:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        return pairs

    def tested(pairs: DataFrame) -> DataFrame:
        pairs = materialize(unasked(pairs), "asked")
        asked.append(pairs)
        return materialize(verify(of("y", of("x", pairs, "a"), "b").where(may_link("x.", "y.")).select("a", "b")), "links")

    pivots = lists.groupBy("key").agg(F.min("v").alias("a"))
    stars = lists.withColumnRenamed("v", "b").join(pivots, "key").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", "a")).alias("best")
    groups = connected_groups(tested(stars.groupBy("b").agg(best).select("best.a", "b")))
    members = lists
    for turn in range(1, rounds + 2):
        members = members.join(groups, "v", "left").select("key", "v", F.coalesce("root", "v").alias("root"))
        pick = F.min(F.struct(F.xxhash64("v", "key", F.lit(turn)).alias("order"), "v"))
        sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"), pick.alias("pick"))
        mains = (sizes.groupBy("key").agg(F.count("*").alias("groups"), F.max(F.struct("n", "root", "pick")).alias("main"))
                 .where("groups > 1").select("key", F.col("main.root").alias("main"), F.col("main.pick.v").alias("pick")))
        members = materialize(members.join(mains, "key"), "open")
        odd = members.where("root <> main")
        if turn > rounds:
            break
        # Another member of the largest group each time and in each list: who belongs to it finds a link.
        more = tested(odd.select(F.col("v").alias("a"), F.col("pick").alias("b")))
        members = members.select("key", "v")
        linked = more.count()
        if linked * WORTH < odd.select("v").distinct().count():
            rounds = turn
        if linked:
            groups = joined_groups(groups, more)
    if parts is None:
        left = of("x", odd.select("key", F.col("v").alias("a"), F.col("root").alias("ra")), "a")
        rest = of("y", members.select("key", F.col("v").alias("b"), F.col("root").alias("rb")), "b")
        pairs = unasked(left.join(rest, "key").where((F.col("ra") != F.col("rb")) & may_link("x.", "y.")).select("a", "b"))
    else:
        met = unasked(_meet_again(members.select("v", "root").distinct(), parts, share))
        pairs = of("y", of("x", met, "a"), "b").where(may_link("x.", "y.")).select("a", "b")
    later = materialize(verify(pairs), "links")
    return groups if later.isEmpty() else joined_groups(groups, later)


def _meet_again(opened: DataFrame, parts: Callable[[DataFrame], DataFrame], share: int) -> DataFrame:
    """Pairs (a, b) of the open vertices (v, root) of different groups that share one of their rarest values."""
    opened = materialize(opened, "opened")
    values = materialize(parts(opened.select("v")), "values")
    shared = values.join(values.groupBy("value").agg(F.count("*").alias("n")).where("n > 1"), "value")
    own = Window.partitionBy("v")
    # Values that no other open vertex has come first; they list nothing.
    place = F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "value"))
    # ``left``: this value and those behind it. A link has share / 100 of the larger set in common.
    listed = shared.withColumn("left", F.col("size") - place + 1).where(100 * F.col("left") >= share * F.col("size"))
    listed = materialize(listed.join(opened, "v").select("value", "v", "root", "size", "left"), "listed")
    one = listed.select("value", F.col("v").alias("a"), F.col("root").alias("ra"), F.col("size").alias("na"), F.col("left").alias("la"))
    two = listed.select("value", F.col("v").alias("b"), F.col("root").alias("rb"), F.col("size").alias("nb"), F.col("left").alias("lb"))
    enough = (100 + share) * F.least("la", "lb") >= share * (F.col("na") + F.col("nb"))
    return one.join(two, "value").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & enough).select("a", "b").distinct()
