"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text. Each prefix of a conversation's turns is rendered, and
consecutive outputs are compared: where the earlier one is the start of the later one, the rest is the
span of the new turn; where it is not, the template rewrites history and the conversation is marked.
The turn is rendered once more with a single mark as its text, which shows where in the span the text
stands. The loss mask covers the texts of the trained role, without anything of the template.

A black box must see a conversation whole, so one task holds one conversation at a time (others in
its partition stream by), and work grows with the square of a conversation's turns.

Cases: null texts are empty and null roles are empty roles; rows without conv_id form one conversation;
rows of one conversation are ordered by turn (rows without one first), then role, then text, and repeated
rows are turns of their own; an empty table gives no conversation; texts of any length are rendered
whole; other columns do not matter.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
#: Start and end of a turn, start and end of its text.
Span = tuple[int, int, int, int]
Template = Callable[[list[Turn]], str]

#: Control strings of the template below.
OPEN, CLOSE, START, END, NAME, NAMED = "[INST] ", " [/INST]", "<s>", "</s>", "<|", "|>"
#: Every control string starts with one of these or with a blank before one; inside texts they are escaped.
_SPECIAL = re.compile(r"[\\<|\[]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TOKEN = re.compile(r"\\.| \[/INST\]|</s>|\|>|[^\\\[<| ]+|.", re.DOTALL)
#: Stands for a turn's text when its place is looked for.
MARK = "\ue000"


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def instruction_template(turns: list[Turn]) -> str:
    """User turns between instruction marks, assistant turns up to an end mark, other roles named."""
    out = [START]
    for role, text in turns:
        if role == "user":
            out.append(f"{OPEN}{escape(text)}{CLOSE}")
        elif role == "assistant":
            out.append(f" {escape(text)}{END}")
        else:
            out.append(f"{NAME}{escape(role)}{NAMED}{escape(text)}{END}")
    return "".join(out)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that ``instruction_template`` made."""
    turns: list[Turn] = []
    at = len(START)
    while at < len(formatted):
        role, ends = "assistant", END
        if formatted.startswith(OPEN, at):
            role, ends, at = "user", CLOSE, at + len(OPEN)
        elif formatted.startswith(NAME, at):
            name, at = _until(formatted, at + len(NAME), NAMED)
            role = unescape(name)
        else:
            at += 1
        text, at = _until(formatted, at, ends)
        turns.append((role, unescape(text)))
    return turns


def _until(formatted: str, at: int, ends: str) -> tuple[str, int]:
    """What stands before the next unescaped ``ends``, and the place after it."""
    start = at
    for m in _TOKEN.finditer(formatted, at):
        if m[0] == ends:
            return formatted[start:m.start()], m.end()
    raise ValueError("the text ends inside a turn")


def render_spans(template: Template, turns: list[Turn]) -> tuple[str, list[Span], bool]:
    """The formatted text, the span of each turn, and whether the template rewrites history."""
    before, found, rewrites = template([]), [], False
    for i, (role, _) in enumerate(turns):
        now = template(turns[:i + 1])
        start = len(before)
        if not now.startswith(before):
            rewrites, start = True, len(os.path.commonprefix([before, now]))
        probe = template([*turns[:i], (role, MARK)])
        at = probe.find(MARK, start)
        end = len(now) - (len(probe) - at - 1)
        if at < 0 or now[:at] != probe[:at] or now[end:] != probe[at + 1:] or end < at:
            rewrites, at, end = True, start, start  # what stands around the text depends on it
        found.append((start, len(now), at, end))
        before = now
    return before, found, rewrites


SCHEMA = ("conv_id bigint, formatted string, rewrites boolean, "
          "turns array<struct<role: string, start: bigint, end: bigint, text_start: bigint, text_end: bigint>>")


def format_conversations(
    df: DataFrame, template: Template = instruction_template, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: its formatted text, the spans of its turns and texts, the rewriting flag."""
    kinds = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("rewrites", pa.bool_()), (
        "turns", pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                     ("text_start", pa.int64()), ("text_end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(key: int | None, turns: list[Turn]) -> dict:
            formatted, spans, rewrites = render_spans(template, turns)
            return {"conv_id": key, "formatted": formatted, "rewrites": rewrites, "turns": [
                {"role": r, "start": a, "end": b, "text_start": c, "text_end": d}
                for (r, _), (a, b, c, d) in zip(turns, spans)]}

        key, turns, out = None, [], []
        for batch in batches:
            for one, who, said in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and one != key:
                    out.append(finished(key, turns))
                    turns = []
                key = one
                turns.append((who, said))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=kinds)
                out = []
        if turns:
            yield pa.RecordBatch.from_pylist([finished(key, turns)], schema=kinds)

    plain = df.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)
