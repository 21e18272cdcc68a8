"""Conversations as training text: rendered by a template, with the parts that a model is to learn."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.templates import compiled

#: Strings with a meaning in the formatted text.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")
TEMPLATE = (
    "{% for m in messages %}<s>"
    "{% if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}[ROLE]{{ m.role | escape }}[/ROLE]{{ m.text | escape }}{% endif %}"
    "</s>{% endfor %}"
)
PIECE_CHARS = 1 << 16
_FORBIDDEN = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """The text without control strings: a backslash breaks each after its first character and doubles itself."""
    return _FORBIDDEN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, formatted, learnt) from ``turns`` (conv_id, turn, role, text, any other columns).

    The ``formatted`` of a conversation's parts, joined in order, is its training text. ``learnt`` lists the
    spans (start, end) to learn from, in code points from the beginning of the conversation.

    Turns go by turn, then role and text, so ties have one order and repeated rows stay repeated; null roles
    and texts read as empty; a null conv_id is a conversation of its own; no turns give no rows. A
    conversation streams through its task: neither its turns nor its text are held as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, {"escape": escape})
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple] = []
        size = 0
        for conv_id, turns_ in groupby(rows, key=lambda row: row[0]):
            messages = ({"role": role or "", "text": text or ""} for _, _, role, text in turns_)
            at = part = 0
            pieces, learnt, held = [], [], 0
            for text, marked in render({"messages": messages}):
                if marked and text:
                    learnt.append({"start": at, "end": at + len(text)})
                at, held = at + len(text), held + len(text)
                pieces.append(text)
                if held >= PIECE_CHARS:
                    out.append((conv_id, part, "".join(pieces), learnt))
                    size += held
                    part, pieces, learnt, held = part + 1, [], [], 0
                    if size > 1 << 22:
                        yield packed(out)
                        out, size = [], 0
            for _ in messages:  # a template may not have asked for every turn
                pass
            out.append((conv_id, part, "".join(pieces), learnt))
            size += held + 64
            if size > 1 << 22:
                yield packed(out)
                out, size = [], 0
        yield packed(out)

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int32(), pa.string(), spans)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "part", "formatted", "learnt"])

    ordered = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, part int, formatted string, learnt array<struct<start: bigint, end: bigint>>"
    return ordered.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of conversations in TEMPLATE's form.

    Reads the formatted text alone: splits it at the control strings and takes the escapes back. The parts
    must lie together and in order, as ``format_conversations`` returns them; they are hashed as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out = []
        for conv_id, parts in groupby(rows, key=lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = chars = loss_chars = at = 0
            rest = ""
            spans: list[tuple[int, int]] = []
            for _, _, text, learnt in parts:
                chars += len(text)
                rest += text
                spans += [(s["start"], s["end"]) for s in learnt]
                begin = 0
                while (end := rest.find("</s>", begin)) >= 0:
                    if not rest.startswith("<s>", begin):
                        raise ValueError(f"conversation {conv_id}: a turn does not begin with <s>")
                    role, body = turn(rest[begin + 3 : end])
                    turns.update(f"{role}\n{body}\n".encode())
                    n += 1
                    while spans and spans[0][1] <= at + end:
                        start, stop = spans.pop(0)
                        said = unescape(rest[start - at : stop - at])
                        loss.update(said.encode())
                        loss_chars += len(said)
                    begin = end + 4
                at, rest = at + begin, rest[begin:]
            out.append((conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) == 5000:
                yield packed(out)
                out = []
        yield packed(out)

    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [()] * len(names)
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(names))

    def turn(text: str) -> tuple[str, str]:
        if text.startswith("[INST]"):
            return "user", unescape(text[6:-7])
        if text.startswith("[ROLE]"):
            role, body = text[6:].split("[/ROLE]", 1)
            return unescape(role), unescape(body)
        return "assistant", unescape(text)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "part", "formatted", "learnt").mapInArrow(run, schema)
