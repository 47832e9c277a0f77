"""Chat formatting: round trips, spans, and templates that rewrite history."""

import random

from docspark.llm import template as t


def test_round_trip_of_hostile_texts():
    rng = random.Random(1)
    parts = [*"ab \\[]</|>s", "[INST] ", " [/INST]", "</s>", "<|", "|>", "<s>", "INST", t.MARK]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "", "<|>", "|>x\\"]), "".join(rng.choices(parts, k=rng.randint(0, 12))))
                 for _ in range(rng.randint(0, 5))]
        formatted, spans, rewrites = t.render_spans(t.instruction_template, turns)
        assert t.read_back(formatted) == turns and not rewrites
        assert [t.unescape(formatted[c:d]) for _, _, c, d in spans] == [text for _, text in turns]
        assert [a for a, *_ in spans[1:]] == [b for _, b, *_ in spans[:-1]]


def test_rewriting_templates_are_noticed():
    def counts(turns):
        return f"{len(turns)} turns: " + "|".join(f"{r}={x}" for r, x in turns)

    def drops_thoughts(turns):
        return "".join(f"<{r}>{x if i == len(turns) - 1 else x[:3]}" for i, (r, x) in enumerate(turns))

    turns = [("user", "hello there"), ("assistant", "long answer"), ("user", "bye")]
    assert t.render_spans(counts, turns)[2]
    assert t.render_spans(drops_thoughts, turns)[2]
    assert not t.render_spans(lambda ts: "".join(f"{r}:{x}\n" for r, x in ts), turns)[2]


def test_conversations_of_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "c"), (None, 0, "user", "x"), (2, None, "user", "first"),
            (2, 5, "assistant", "y" * 100_000), (3, 0, "user", "same"), (3, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: t.read_back(r.formatted) for r in t.format_conversations(df).collect()}
    assert found == {
        1: [("user", ""), ("assistant", "b"), ("", "c")], None: [("user", "x")],
        2: [("user", "first"), ("assistant", "y" * 100_000)], 3: [("user", "same"), ("user", "same")]}
    assert t.format_conversations(df.limit(0)).count() == 0


def test_query_digests_equal_the_plain_version(spark):
    import hashlib

    from docspark.llm import queries
    from tests.llm.conftest import SMALL

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        turns.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = []
    for conv, said in turns.items():
        loss = "".join(x for r, x in said if r == "assistant")
        wanted.append((conv, len(said), sha("".join(f"{r}\n{x}\n" for r, x in said)), len(loss), sha(loss), len(t.instruction_template(said))))
    found = queries.op7_chat(spark, SMALL).collect()
    assert sorted((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in found) == sorted(wanted)
    assert not any(r.rewrites for r in found)
