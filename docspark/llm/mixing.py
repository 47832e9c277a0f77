"""Mixing sources to target weights by blocks of words.

The words of a source form one sequence of documents, cut into blocks of ``BLOCK`` words. The mix is
a row of slots, dealt to output shards of ``SHARD`` slots. Each shard draws its counts per source from
the multinomial shares by systematic sampling: one random offset per shard, so that every count is
within one of its mean and a source's total stays near its target. A source's slots take its blocks in
the order of pseudorandom permutations, a new one for each pass over the source, and are joined to the
documents by block index. A document gives what its blocks give, so never more than ``PASSES`` times its size.

Targets share the total of all sizes by weight; a source stops at ``PASSES`` times its size, and what
it leaves is shared by the others' weights until none is above (solved in one pass over the sources, sorted
by how early they stop).

All of it is DataFrame functions over integers and doubles, with a fixed hash, so that reruns agree.
The table of sources has one row per source; the window that ranks it is the only one over all rows of a
table. Documents are placed in their source by sums over ranges of ids, so a source may hold any share of
the rows.

Cases: null or empty texts have size 0 and give nothing; documents without source form a source of their
own, the last one; a source without words has target 0; rows that share a doc_id are separate documents, placed
by the hash of their text; an empty table gives an empty mix; other columns pass through ``mix_texts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docspark.llm.batches import free_name
from docspark.session import materialize

#: Fixed values of the contract.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PASSES = 3

BLOCK = 128
SHARD = 4096
#: Documents per range of a source.
RANGE = 4_000
#: Buckets of the cumulated shares through which slots find their source.
BUCKETS = 1024
ROUNDS = 12
#: Rows of a side that may be broadcast; beyond it Spark shuffles.
BROADCAST_ROWS = 200_000

PRIME = 2147483647


def scramble(x: Column) -> Column:
    """A fixed pseudorandom number in [0, PRIME) for each bigint; every step stays below 2 ** 62."""
    y = (x % PRIME * 48271 + 1013904223) % PRIME
    # Lists of one element bind the steps, which are used twice each.
    squared = F.transform(F.array(y), lambda v: (v * v + 12345) % PRIME)
    mixed = F.transform(squared, lambda v: (v * 69621 + 7) % PRIME)
    return F.element_at(F.transform(mixed, lambda v: (v * v + v) % PRIME), 1)


def permute(index: Column, size: Column, salt: Column) -> Column:
    """Swap-or-not permutation of [0, size): each round swaps a number with its mirror, or not, by one bit."""
    def one(x: Column, i: Column) -> Column:
        key = scramble(salt * 31 + i * 7919 + 1) % size
        mirror = (key + size - x) % size
        swap = scramble(F.greatest(x, mirror) + salt * 131 + i * 104729) % 2 == 1
        return F.when(swap, mirror).otherwise(x)

    rounds = F.sequence(F.lit(0).cast("bigint"), F.lit(ROUNDS - 1).cast("bigint"))
    return F.aggregate(rounds, index, one)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, row_hash, source, size) of every row."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("row_hash"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(sid, source, source_size, target, blocks, low, high) per source, one row each.

    ``low`` and ``high`` bound the source's part of the unit interval that slots are drawn from.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn("sid", F.row_number().over(order).cast("bigint") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("sid") % len(WEIGHTS)).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(PASSES))
    early = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    before = early.rowsBetween(Window.unboundedPreceding, -1)
    after = early.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    level = ((F.sum("source_size").over(everyone) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    levelled = ranked.withColumn("level", level)
    stops = F.col("most") / F.col("weight")
    first_open = F.min(F.when(F.col("level") <= stops, F.struct(stops.alias("stops"), "sid", "level"))).over(everyone)
    open_level = first_open["level"]
    levelled = levelled.withColumn("target", F.least(F.col("most"), F.coalesce(open_level, F.lit(0.0)) * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("bigint")
    levelled = levelled.withColumn("blocks", blocks).withColumn(
        "slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levelled = levelled.withColumn("sum_slots", F.sum("slots").over(upto))
    every = F.max("sum_slots").over(everyone)
    levelled = levelled.withColumn("all_slots", every).withColumn("high", F.coalesce(F.try_divide("sum_slots", every), F.lit(0.0)))
    low = F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0))
    return levelled.withColumn("low", low).select(
        "sid", "source", "source_size", "target", "blocks", "all_slots", "low",
        F.when(F.col("sum_slots") == every, F.lit(1.0)).otherwise(F.col("high")).alias("high"))


def place(sizes: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Add sid, target, source_size and ``start``, the words of the source before the document."""
    ranges = max(1, -(-count // RANGE))
    known = sizes.join(_small(sources.select(F.col("source").alias("name"), "sid", "source_size", "target")),
                       F.col("source").eqNullSafe(F.col("name"))).drop("name")
    known = known.withColumn("part", F.coalesce(F.pmod("doc_id", F.lit(ranges)), F.lit(0)))
    parts = known.groupBy("sid", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("sid", "part").orderBy(F.col("doc_id").asc_nulls_last(), "row_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    known = known.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return known.join(_small(parts), ["sid", "part"]).withColumn("start", F.col("base") + F.col("inside")).drop(
        "base", "inside", "part")


def draw_slots(spark: SparkSession, sources: DataFrame, seed: int = 0) -> DataFrame:
    """Every slot of the mix: shard, place in the shard, sid and the block it takes."""
    found = sources.agg(F.max("all_slots")).first()[0]
    slots = round(found or 0)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(0, slots, 1, parts).select(
        F.floor(F.col("id") / SHARD).cast("bigint").alias("shard"), (F.col("id") % SHARD).alias("slot"))
    held = F.least(F.lit(SHARD), F.lit(slots) - F.col("shard") * SHARD)
    offset = scramble(F.col("shard") * 3 + seed) / float(PRIME)
    rows = rows.withColumn("at", (F.col("slot") + offset) / held).withColumn("bucket", F.floor(F.col("at") * BUCKETS).cast("int"))
    spans = sources.where("high > low").select(
        "sid", "blocks", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") * BUCKETS).cast("int"), F.floor(F.col("high") * BUCKETS).cast("int"))).alias("bucket"))
    drawn = rows.join(_small(spans), "bucket").where("at >= low AND at < high").select("shard", "slot", "sid", "blocks")
    drawn = materialize(drawn, "slots")
    # A source's slots in a shard are neighbours, so its earlier slots are its earlier shards' counts.
    counts = drawn.groupBy("sid", "shard").agg(F.count("*").alias("n"), F.min("slot").alias("first"))
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "shard", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    turn = F.col("base") + F.col("slot") - F.col("first")
    placed = drawn.join(_small(counts), ["sid", "shard"]).withColumn("turn", turn)
    # Rounding may draw a slot beyond the last pass.
    placed = placed.where(F.col("turn") < PASSES * F.col("blocks"))
    salt = F.col("sid") * 1009 + F.floor(F.col("turn") / F.col("blocks")) * 17 + seed
    return placed.select(
        "shard", "slot", "sid", permute(F.col("turn") % F.col("blocks"), F.col("blocks"), salt).alias("block"))


def mix_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """(doc_id, row_hash, source, size, source_size, target, start, pieces) of every document.

    ``pieces`` lists (first, words, times): the words from ``first`` on that the mix takes ``times`` times.
    """
    sizes = materialize(sized(docs, doc_id, text, source), "sizes")
    sources = materialize(source_targets(sizes), "sources")
    placed = place(sizes, sources, sizes.count())
    slots = draw_slots(docs.sparkSession, sources, seed)
    taken = slots.groupBy("sid", "block").agg(F.count("*").alias("times"))
    end = F.col("start") + F.col("size")
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK)))
    spread = placed.withColumn("block", F.explode_outer(blocks))
    low = F.greatest(F.col("start"), F.col("block") * BLOCK)
    high = F.least(end, (F.col("block") + 1) * BLOCK)
    piece = F.when(F.col("times").isNotNull(), F.struct(
        (low - F.col("start")).alias("first"), (high - low).alias("words"), "times"))
    keys = ["doc_id", "row_hash", "source", "size", "source_size", "target", "sid", "start"]
    # Documents without words have no place of their own; copies of such a row stay rows.
    met = spread.join(taken, ["sid", "block"], "left").withColumn("piece", piece)
    full = met.where("size > 0").groupBy(*keys).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    empty = met.where("size = 0").select(*keys, F.array().cast(full.schema["pieces"].dataType).alias("pieces"))
    return full.unionByName(empty)


def taken_words(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("bigint"), lambda n, p: n + p["words"] * p["times"])


def mix_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """``df`` with each text made of the words that the mix takes of it; texts it takes nothing of are left out.

    Repeated passes over a piece stand one after another, words are joined by one blank.
    """
    mixed = mix_pieces(df, doc_id, text, source, seed)
    taken = mixed.where(F.size("pieces") > 0).select(
        F.col("doc_id").alias("m_id"), F.col("row_hash").alias("m_hash"), F.col("source").alias("m_source"), "pieces", "start")
    copy, row_hash = free_name(df, "copy"), free_name(df, "row_hash")
    # Rows equal in id, source and text are told apart by their number.
    same = ["m_id", "m_hash", "m_source"]
    taken = taken.withColumn(copy, F.row_number().over(Window.partitionBy(*same).orderBy("start"))).drop("start")
    rows = df.withColumn(row_hash, F.xxhash64(text))
    rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(doc_id, row_hash, source).orderBy(doc_id)))
    pieces = free_name(df, "pieces")
    taken = taken.withColumnRenamed("pieces", pieces)
    joined = rows.join(
        taken, rows[doc_id].cast("bigint").eqNullSafe(taken["m_id"]) & (rows[row_hash] == taken["m_hash"])
        & rows[source].eqNullSafe(taken["m_source"]) & (rows[copy] == taken[copy]))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = F.transform(F.array(words), lambda ws: F.flatten(F.transform(pieces, lambda p: F.flatten(F.array_repeat(
        F.slice(ws, p["first"].cast("int") + 1, p["words"].cast("int")), p["times"].cast("int"))))))
    made = F.array_join(F.element_at(parts, 1), " ")
    return joined.select(*[made.alias(c) if c == text else rows[c] for c in df.columns])
