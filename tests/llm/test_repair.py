"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from docspark.llm import queries, repair
from tests.llm.conftest import SMALL

WHOLE = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """(cost, edits) by a best-first search over all edit sequences. ``rows``: (initial, fault)."""
    # A state of the pattern: the text so far, reduced to what may follow.
    def after(state, symbol):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "su"}, "su": {"a": "sa"}, "sa": {"u": "su"}, "u": {"a": "ua"}, "ua": {"u": "u"}}.get(
            state, {}).get(symbol)

    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, edits, at, state = heapq.heappop(queue)
        if at == len(rows) and state in ("", "sa", "ua"):
            return cost, edits
        if (at, state) in done:
            continue
        done.add((at, state))
        for symbol in "ua":
            if (to := after(state, symbol)) is not None:
                heapq.heappush(queue, (cost + 2, edits + "I", at, to))
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(queue, (cost + 3, edits + "D", at + 1, state))
            if fault not in ("blank", "duplicate"):
                stays = cost + (fault == "truncated")
                if (to := after(state, initial)) is not None:
                    heapq.heappush(queue, (stays, edits + "K", at + 1, to))
                for symbol in "ua":
                    if (to := after(state, symbol)) is not None:
                        heapq.heappush(queue, (stays + 2, edits + "R", at + 1, to))


def described(turns):
    """The whole contract for the rows (turn, role, text) of one conversation after damage, in plain Python."""
    rows = sorted(((t is not None, t or 0, r, x) for t, r, x in turns))
    seen, marked, lines = set(), [], []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        solid = text.rstrip(" \t\n\r\x0b\x0c")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        marked.append((role[:1], fault))
        if fault:
            counts[fault] += 1
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, edits = brute(marked)
    size = len(edits) - edits.count("D")
    left = iter(rows)
    for e in edits:
        row = None if e == "I" else next(left)
        if e == "D":
            continue
        role = row[2] if e == "K" else "user" if (len(lines) - size % 2) % 2 == 0 else "assistant"
        lines.append(f"{role}:{row[3] if row else ''}")
    assert WHOLE.match("".join(line[0] for line in lines))
    return (gaps, *counts.values(), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    space = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if case == 0:
            continue
        if case in (1, 2):
            text = "" if case == 1 else re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        for _ in range(2 if case == 3 else 1):
            yield conv, turn, role, text


def wanted(rows):
    found = {r[0]: [] for r in rows}
    for conv, turn, role, text in damaged(rows):
        found[conv].append((turn, role, text))
    return sorted(((str(c), *described(t)) for c, t in found.items()))


def got(df):
    return sorted((str(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
                  for r in df.collect())


def test_parses_equal_a_search_over_all_edits():
    random.seed(5)
    for _ in range(1500):
        rows = [(random.choice("suauat"), random.choice([None, None, "blank", "duplicate", "truncated"])) for _ in range(random.randrange(9))]
        parse = repair.Parse()
        for initial, fault in rows:
            parse.read(initial, fault)
        assert parse.end() == brute(rows)


def test_a_long_conversation_keeps_all_its_edits():
    parse = repair.Parse()
    for i in range(4001):
        parse.read("ua"[i % 2], "blank" if i == 2000 else None)
    cost, audit = parse.end()
    assert len(audit.replace("I", "")) == 4001 and audit[2000] == "D" and cost == brute(
        [("ua"[i % 2], "blank" if i == 2000 else None) for i in range(4001)])[0]


def test_query_equals_the_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_repair(spark, SMALL)) == wanted(rows)


ODD = [
    (1, 1, "user", "Hi."), (1, 2, "assistant", None), (1, 5, "assistant", "So"), (1, 5, "assistant", "So"), (1, None, "tool", "x."),
    (2, None, None, None), (2, None, "", ""), (None, 3, "user", "Who?"), (None, 4, "assistant", "Me. \n\t"), (None, 4, "assistant", "Me. \n\t"),
    (3, 7, "system", "Be kind."), (4, -9, "user", "A." * 60_000), (4, 9, "assistant", " " * 50_000), (5, 1, "User", "a!"), (5, 2, "ass", "b?"),
    (6, 1, "system", "Rules."), (6, 2, "system", "Rules."), (6, 2, "user", "Go!"), (7, 1, "user", "\x85\xa0"), (7, 2, "assistant", "漢字。"),
]


def test_odd_rows(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, role string, text string"
    extra = spark.createDataFrame([(*r, 0, "z") for r in ODD], f"{schema}, pos int, audit string")
    extra.write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(queries.op13_repair(spark, str(tmp_path))) == wanted(ODD)


def test_operator_returns_the_turns(spark):
    rows = spark.createDataFrame(
        [(1, 1, "user", "Hi."), (1, 2, "user", "Still here."), (2, 1, "assistant", "Yes.")],
        "conv_id bigint, turn bigint, role string, text string")
    rows = repair.ordered_rows(rows)
    scripts = repair.repair_scripts(rows)
    found = sorted(tuple(r) for r in repair.repaired_turns(rows, scripts).collect())
    assert {r.conv_id: (r.cost, r.audit) for r in scripts.collect()} == {1: (2, "KR"), 2: (2, "IK")}
    assert found == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Still here."), (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "Yes.")]


def test_no_rows(spark):
    rows = repair.ordered_rows(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))
    scripts = repair.repair_scripts(rows)
    assert scripts.count() == 0 and repair.repaired_turns(rows, scripts).count() == 0


@pytest.mark.parametrize("text", [None, "", " \t"])
def test_blank_turns_alone_leave_nothing(spark, text):
    rows = repair.ordered_rows(spark.createDataFrame([(1, 1, "user", text)], "conv_id bigint, turn bigint, role string, text string"))
    assert [(r.cost, r.audit) for r in repair.repair_scripts(rows).collect()] == [(3, "D")]
