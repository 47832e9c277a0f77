"""Repair of conversations: a generalised LR parse with weighted edits over the grammar of roles.

A conversation should read ``C``: nothing, or turns ``P``, or a system turn ``s`` before them, where ``P`` is one
or more pairs of a user turn ``u`` and an assistant turn ``a``. The parser reads the rows in order and follows every
choice at once: keep a row, change its role to user or assistant, delete it, or insert an empty turn before it. The
stacks of all parses form a graph: a node is a state of the table and the node below it, so parses that
share what lies below share the nodes, and parses whose top node is the same merge, where the smaller (cost,
edits) stays. The grammar is left-recursive, so there are never more than ten different nodes.

The edits so far are not compared as texts. After a row all of them end in the letter of that row, and of two
that differ none starts with the other; so their order decides, whatever follows, and a rank stands for it. Work
is linear in a conversation's rows.

Rows stream by in order, one conversation at a time. A task holds the parses of one conversation (one letter per row
and parse) and none of its texts, so a conversation of any length passes; its rows are read by one task, since every
edit depends on those before it.

Cases: null roles and texts are one space; rows without a turn come first, ties are ordered by role and text; rows
without conv_id form one conversation; repeated rows are duplicates of the first; texts of any length are taken
whole; an empty table gives no conversation; other columns, whatever their names, do not matter. Gaps beyond a long
are given as the largest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Letters of the edits: their order decides ties.
KEPT, REROLED, DELETED, INSERTED = "K", "R", "D", "I"
ROLES = {"u": "user", "a": "assistant"}

#: The LR(0) table of C -> | P | s P and P -> P u a | u a: the state after a symbol, the length
#: of the rule that ends in a state, the state after P, and the states in which C may end.
_SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 5}, 3: {"u": 6}, 4: {"u": 6}, 6: {"a": 7}}
_REDUCE = {5: 2, 7: 3}
_GOTO = {0: 3, 1: 4}
_ENDS = {0, 3, 4}
_SYMBOLS = {"s", "u", "a"}

#: A node of the stack graph: a state and the node below.
Node = tuple[int, "Node | None"]
START: Node = (0, None)
#: Edits of a parse: earlier pieces, and the piece that grows.
Trail = tuple[tuple | None, str]
_PIECE = 512


@lru_cache(maxsize=None)
def advance(node: Node, symbol: str) -> Node | None:
    """The top node after a symbol and all reductions; None where the grammar does not allow it."""
    state = _SHIFT.get(node[0], {}).get(symbol)
    if state is None:
        return None
    top: Node = (state, node)
    while top[0] in _REDUCE:
        for _ in range(_REDUCE[top[0]]):
            top = top[1]
        top = (_GOTO[top[0]], top)
    return top


@lru_cache(maxsize=None)
def _insertions(node: Node) -> tuple[tuple[Node, int], ...]:
    """Every node that inserted turns reach, with the fewest of them."""
    found, new = {node: 0}, [node]
    while new:
        later = []
        for top in new:
            for symbol in ROLES:
                to = advance(top, symbol)
                if to is not None and to not in found:
                    found[to] = found[top] + 1
                    later.append(to)
        new = later
    return tuple(found.items())


@lru_cache(maxsize=4096)
def _moves(node: Node, initial: str, fault: str | None) -> tuple[tuple[Node, int, str], ...]:
    """(node after, cost, letters) of every way over one row: turns inserted before it, then its own edit."""
    moves = []
    for top, count in _insertions(node):
        cost, before = INSERT * count, INSERTED * count
        moves.append((top, cost + DELETE, before + DELETED))
        if fault in ("blank", "duplicate"):
            continue
        cost += TRUNCATED * (fault == "truncated")
        kept = advance(top, initial)
        if kept is not None:
            moves.append((kept, cost, before + KEPT))
        for symbol in ROLES:
            to = advance(top, symbol)
            if to is not None:
                moves.append((to, cost + REROLE, before + REROLED))
    return tuple(moves)


class Parse:
    """The cheapest parses of the rows read so far, one for each top node."""

    def __init__(self) -> None:
        self.heads: dict[Node, tuple[int, int, Trail]] = {START: (0, 0, (None, ""))}

    def read(self, initial: str, fault: str | None) -> None:
        best: dict[Node, tuple[int, int, str, Trail]] = {}
        for node, (cost, rank, trail) in self.heads.items():
            for to, more, edits in _moves(node, initial, fault):
                offered, held = (cost + more, rank, edits), best.get(to)
                if held is None or offered < held[:3]:
                    best[to] = (*offered, trail)
        ranks = {key: i for i, key in enumerate(sorted({(rank, edits) for _, rank, edits, _ in best.values()}))}
        self.heads = {to: (cost, ranks[rank, edits], _longer(trail, edits)) for to, (cost, rank, edits, trail) in best.items()}

    def end(self) -> tuple[int, str]:
        """Cost and edits of the cheapest parse that is a whole conversation."""
        cost, _, edits, trail = min(
            (cost + INSERT * count, rank, INSERTED * count, trail) for node, (cost, rank, trail) in self.heads.items()
            for to, count in _insertions(node) if to[0] in _ENDS)
        pieces, earlier = [trail[1] + edits], trail[0]
        while earlier is not None:
            earlier, piece = earlier
            pieces.append(piece)
        return cost, "".join(reversed(pieces))


def _longer(trail: Trail, edits: str) -> Trail:
    piece = trail[1] + edits
    return (trail[0], piece) if len(piece) < _PIECE else ((trail[0], piece), "")


def ordered_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, again): the rows, and whether role and text stood in an earlier one."""
    space = F.lit(" ")
    rows = df.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"))
    # The window's key holds the text, so a long conversation is spread over tasks here.
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return rows.withColumn("again", F.row_number().over(same) > 1)


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    """One conversation after the other in a partition, its rows in order."""
    return df.repartition("conv_id").sortWithinPartitions(
        "conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text", "again")


SCRIPT = ("conv_id bigint, n_rows bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string")


def repair_scripts(rows: DataFrame) -> DataFrame:
    """Faults, cost and edits of every conversation of :func:`ordered_rows`.

    ``audit`` has a letter for each edit: K keep, R change the role, D delete, one per row in order, and I for each turn
    inserted. Of the edits of least cost it is the first in ASCII order.
    """
    kinds = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in (
        "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        key, now = None, None

        def finished() -> dict:
            first, last, turns = now["turns"]
            cost, audit = now["parse"].end()
            gaps = 0 if first is None else min(last - first + 1 - turns, (1 << 63) - 1)
            return {"conv_id": key, "n_rows": now["rows"], "gaps": gaps, **now["faults"], "illegal": now["illegal"],
                    "cost": cost, "audit": audit}

        for batch in batches:
            for conv, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != key:
                    if now is not None:
                        out.append(finished())
                    key = conv
                    now = {"rows": 0, "turns": (None, None, 0), "faults": dict.fromkeys(("blank", "duplicate", "truncated"), 0),
                           "illegal": 0, "parse": Parse(), "last": None}
                now["rows"] += 1
                first, last, turns = now["turns"]
                if turn is not None and turn != last:
                    now["turns"] = (turn if first is None else first, turn, turns + 1)
                if fault is not None:
                    now["faults"][fault] += 1
                if now["last"] is not None:
                    now["illegal"] += now["last"] + initial not in ("su", "ua", "au")
                now["last"] = initial
                now["parse"].read(initial if initial in _SYMBOLS else "", fault)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=kinds)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([finished()], schema=kinds)

    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(F.col("again"), "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z"), "truncated"))
    return _in_order(rows).select("conv_id", "turn", F.substring("role", 1, 1), fault.alias("fault")).mapInArrow(run, SCRIPT)


def repaired_turns(rows: DataFrame, scripts: DataFrame) -> DataFrame:
    """(conv_id, pos, edit, role, text): the turns of every repaired conversation, a conversation's in order.

    The rows of one conversation stand together, in order, in one partition.
    """
    kinds = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, at, pos, shift = None, "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []

            def insert() -> None:
                nonlocal at, pos
                while at < len(audit) and audit[at] == INSERTED:
                    out.append((key, pos, INSERTED, ROLES["ua"[(pos - shift) % 2]], ""))
                    at, pos = at + 1, pos + 1

            for conv, edits, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if edits is not None:
                    # What is left of the last conversation's edits came with its last row.
                    key, audit, at, pos = conv, edits, 0, 0
                    # An odd number of turns starts with a system turn; the others alternate.
                    shift = (len(edits) - edits.count(DELETED)) % 2
                    insert()
                    continue
                edit = audit[at]
                at += 1
                if edit != DELETED:
                    out.append((conv, pos, edit, role if edit == KEPT else ROLES["ua"[(pos - shift) % 2]], text))
                    pos += 1
                insert()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)

    none = F.lit(None)
    both = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", "again", none.cast("string").alias("audit")).unionByName(
        scripts.select("conv_id", F.lit(0).alias("part"), none.cast("bigint").alias("turn"), none.cast("string").alias("role"),
                       none.cast("string").alias("text"), none.cast("boolean").alias("again"), "audit"))
    return _in_order(both, "part").select("conv_id", "audit", "role", "text").mapInArrow(
        run, "conv_id bigint, pos bigint, edit string, role string, text string")
