"""Secrets in texts: fixed patterns, and literals that an assignment binds to a sensitive name.

The lexer reads lines that hold an assignment (source code, JSON, YAML, shell, INI) into pairs of a name and a
value: a literal, another name, or a sum of both. Constants are propagated through names in the order of the
text, so a literal counts for every name it reaches. A literal's score is the sensitivity of the most
sensitive such name times how much the literal looks like a secret.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.arrays import slices

#: Longer values are no placeholders.
LONGEST_PLACEHOLDER = 400
KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5
REDACTED = "[SECRET]"
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: How telling a part of a name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "auth": 0.7, "authorization": 0.8,
    "bearer": 0.8, "key": 0.6, "signature": 0.6, "salt": 0.6, "session": 0.5, "cookie": 0.5, "pin": 0.5,
}
PLACEHOLDERS = re.compile(
    r"^(?:x+|\*+|\.+|change_?me|example|sample|test|dummy|none|null|nil|true|false|todo|your[\w-]*|<.*>|\$\{?.*\}?|%.*%)$",
    re.IGNORECASE,
)
#: Begins where no name goes on and never gives letters back, so a line is read once however long its names are.
NAME = r"(?<![A-Za-z0-9_.\-])[0-9.\-]*+(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)"
PAIR = re.compile(
    rf"{NAME}(?:\[[\"'](?P<item>[^\"'\]]+)[\"']\])?[\"']?[ \t]*(?::=|=>|=(?!=)|:(?!/))[ \t]*"
)
#: A bare value ends before a sign that binds the next one, as in a=b=c.
TERM = re.compile(rf"\"(?P<double>(?:[^\"\\\n]|\\.)*)\"|'(?P<single>(?:[^'\\\n]|\\.)*)'|(?P<bare>(?:[^\s\"',;(){{}}\[\]+=]|=(?![A-Za-z0-9_]))++)")
PLUS = re.compile(r"[ \t]*\+[ \t]*")
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


def sensitivity(name: str) -> float:
    """How much a name promises a secret, 0 to 1: by its parts, and by neighbouring parts joined."""
    parts = [p.lower() for p in SPLIT.split(name) if p]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


@dataclass
class Value:
    """What a name is bound to, as far as its looks go: a literal, or several joined."""

    letters: Counter
    length: int
    text: str | None  # None beyond LONGEST_PLACEHOLDER

    @classmethod
    def of(cls, text: str) -> Value:
        return cls(Counter(text), len(text), text if len(text) <= LONGEST_PLACEHOLDER else None)

    @classmethod
    def joined(cls, parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        length = sum(p.length for p in parts)
        known = length <= LONGEST_PLACEHOLDER and all(p.text is not None for p in parts)
        letters = sum((p.letters for p in parts), Counter())
        return cls(letters, length, "".join(p.text for p in parts) if known else None)


def strangeness(value: Value) -> float:
    """How much a literal looks like a secret, 0 to 1: its entropy and kinds of characters, nothing for words."""
    if value.length < 6 or " " in value.letters or (value.text is not None and PLACEHOLDERS.match(value.text)):
        return 0.0
    shares = [n / value.length for n in value.letters.values()]
    entropy = -sum(p * math.log2(p) for p in shares)
    signs = "".join(value.letters)
    kinds = sum(map(bool, (re.search(p, signs) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))))
    return min(1.0, entropy / 4.0) * (0.5 if kinds == 1 else 1.0)


def literals(text: str) -> dict[tuple[int, int], float]:
    """The score of every literal (start, end) that a name is bound to, directly or through constants.

    Bindings form a graph: each has the literals and the earlier bindings that it is made of. Scores go from every
    binding down to its parts, last binding first, so each part is visited once whatever the number of names and
    however often a constant is used.
    """
    bound: dict[str, int] = {}
    values: list[Value] = []
    own: list[float] = []
    parts: list[list[int | tuple[int, int]]] = []
    at = 0
    while (mark := min((p for p in (text.find("=", at), text.find(":", at)) if p >= 0), default=-1)) >= 0:
        begin = text.rfind("\n", 0, mark) + 1
        end = text.find("\n", mark)
        end = len(text) if end < 0 else end
        for pair in PAIR.finditer(text, begin, end):
            made, looks, place = [], [], pair.end()
            while term := TERM.match(text, place, end):
                kind = term.lastgroup
                value = term[kind]
                if kind == "bare" and value in bound:
                    made.append(bound[value])
                    looks.append(values[bound[value]])
                elif value:
                    made.append(term.span(kind))
                    looks.append(Value.of(value))
                more = PLUS.match(text, term.end(), end)
                if not more:
                    break
                place = more.end()
            names = [pair["name"], pair["item"]] if pair["item"] else [pair["name"]]
            whole = Value.joined(looks) if looks else Value.of("")
            weight = max(map(sensitivity, names))
            bound[names[-1]] = len(own)
            values.append(whole)
            own.append(weight * strangeness(whole) if weight else 0.0)
            parts.append(made)
        at = end + 1
    scores: dict[tuple[int, int], float] = {}
    for k in range(len(own) - 1, -1, -1):
        for part in parts[k]:
            if isinstance(part, int):
                own[part] = max(own[part], own[k])
            elif own[k]:
                scores[part] = max(scores.get(part, 0.0), own[k])
    return scores


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed in KINDS; places are code points."""
    found = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if any(part in lower for part in SENSITIVE):
        found += [("literal", *place) for place, score in literals(text).items() if score >= THRESHOLD]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text, any other columns): all secrets of the whole text.

    Null reads as empty, which has none. Repeated rows stay repeated; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, "text"):
            rows = [
                [{"kind": k, "start": a, "end": b} for k, a, b in spans(text or "")]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): counts and digests of the spans."""
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind != 'literal')"
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS[:3]]
    digests = F.sha2(F.expr(joined.format(base)).cast("binary"), 256).alias("base_sha256")
    return scanned.select("doc_id", *counts, digests, F.expr(joined.format("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret of the text replaced by a mark; overlapping spans are one. n_chars follows."""

    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([masked(t) for t in column.to_pylist()], pa.string())

    def masked(text: str | None) -> str | None:
        if not text:
            return text
        out, done = [], 0
        for _, start, end in spans(text):
            if start >= done:
                out += [text[done:start], REDACTED]
            done = max(done, end)
        return "".join(out) + text[done:]

    from pyspark.sql.functions import arrow_udf

    docs = docs.withColumn("text", arrow_udf(clean, "string")("text"))
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs
