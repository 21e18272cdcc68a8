"""SentencePiece encoding and decoding with a vocabulary file: best segmentation by piece scores, byte fallback.

An Aho-Corasick automaton reads the text once; at every position the pieces that end there (found over its
output links) relax the best score, and a backward walk gives the pieces. A text falls apart at places that
no piece spans; such stretches are segmented by the same pass and remembered, in a store of bounded size.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (used as pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from taskspark.llm.arrays import give_back, kept_by_worker, ragged, slices

MARK = "▁"
#: Texts whose ids a worker keeps, and text that it takes at once: a worker stays small beside others of its executor.
REMEMBERED = 1 << 16
PASS_BYTES = 1 << 19
LONGEST_REMEMBERED = 64
#: An unknown character costs this much more than the worst piece, as in the public unigram model.
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class Remembered(dict):
    """Ids by text, found when first asked for; the first ``most`` texts of a task are kept, common ones among them."""

    def __init__(self, find, most: int = REMEMBERED) -> None:
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, text: str) -> bytes:
        ids = self.find(text)
        if len(self) < self.most and len(text) <= LONGEST_REMEMBERED and "\n" not in text:
            self[text] = ids
        return ids


class Pieces:
    """The vocabulary, and the segmentation of texts by it. Ids are little-endian int32 as bytes."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick

        self.stretches = Remembered(self.segment, REMEMBERED // 8)
        self.words = Remembered(lambda word: self._apart(MARK + word))
        self.automaton = ahocorasick.Automaton()
        self.bytes_at = [0] * 256
        self.texts: list[bytes] = []
        self.unknown, self.dummy_prefix = 0, True
        worst, joined = 0.0, set()
        for number, value in fields(model):
            if number == 3:
                self.dummy_prefix = bool(dict(fields(value)).get(3, 1))
            if number != 1:
                continue
            parts = dict(fields(value))
            text, kind, at = parts[1].decode(), parts.get(3, NORMAL), len(self.texts)
            score = float(np.frombuffer(parts.get(2, bytes(4)), "<f4")[0])
            surface = text.replace(MARK, " ").encode()
            if kind == BYTE:
                self.bytes_at[int(text[3:5], 16)] = at
                surface = bytes([int(text[3:5], 16)])
            elif kind == UNKNOWN:
                self.unknown, surface = at, "⁇".encode()
            elif kind == CONTROL:
                surface = b""
            if kind in (NORMAL, USER_DEFINED):
                self.automaton.add_word(text, (len(text), score, at))
                worst = min(worst, score)
                if len(text) > 1:
                    joined.update(text)
            self.texts.append(surface)
        self.automaton.make_automaton()
        self.singles = {t for t in self.automaton.keys() if len(t) == 1}  # noqa: SIM118
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.whole = any(re.search(f"[^{MARK}]{MARK}", t) for t in self.automaton.keys())  # noqa: SIM118
        loose = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        self.stretch = re.compile(f"[{loose}]|{MARK}*[^{MARK}{loose}]+|{MARK}+" if loose else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.sizes = np.array([len(t) for t in self.texts])
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.letters = np.frombuffer(b"".join(self.texts), np.uint8)

    def segment(self, text: str) -> bytes:
        """The best segmentation of a stretch; ties go to the longer last piece.

        Matches come by ascending end, and every earlier end is final by then. A character that is no piece
        of its own may also stand as unknown, which is spelt in bytes.
        """
        best = [-math.inf] * (len(text) + 1)
        best[0] = 0.0
        sizes, ids = [1] * (len(text) + 1), [-1] * (len(text) + 1)
        strange = [] if self.singles.issuperset(text) else [k + 1 for k, c in enumerate(text) if c not in self.singles]
        strange.append(len(text) + 1)
        ahead = 0
        for last, (size, score, at) in self.automaton.iter(text):
            end = last + 1
            while strange[ahead] < end:
                self._unknown(best, sizes, ids, strange[ahead])
                ahead += 1
            total = best[end - size] + score
            if total > best[end]:
                best[end], sizes[end], ids[end] = total, size, at
        for end in strange[ahead:-1]:
            self._unknown(best, sizes, ids, end)
        out, end = [], len(text)
        while end:
            if ids[end] < 0:
                out.extend(self.bytes_at[b] for b in reversed(text[end - 1].encode()))
            else:
                out.append(ids[end])
            end -= sizes[end]
        return array("i", out[::-1]).tobytes()

    def _unknown(self, best: list[float], sizes: list[int], ids: list[int], end: int) -> None:
        total = best[end - 1] + self.unknown_score
        if total > best[end]:
            best[end], sizes[end], ids[end] = total, 1, -1

    def _apart(self, text: str) -> bytes:
        """Segmentation of a text with marks, stretch by stretch."""
        if self.whole:
            return self.segment(text)
        parts = self.stretch.findall(text)
        if len(parts) == 1:
            return self.segment(text)
        return b"".join([self.words[p[1:]] if p[0] == MARK and p != MARK else self.stretches[p] for p in parts])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text. The mark itself, where a text has it, is spelt in bytes."""
        if not text:
            return b""
        if MARK in text:
            spelt = np.array([self.bytes_at[b] for b in MARK.encode()], "<i4").tobytes()
            head, *tail = text.split(MARK)
            first = self.encode(head) if head else (self._apart(MARK) if self.dummy_prefix else b"")
            return first + b"".join(spelt + self._inner(part) for part in tail)
        return self._inner(" " + text if self.dummy_prefix else text)

    def _inner(self, text: str) -> bytes:
        if self.whole or "  " in text or not text:
            return self._apart(text.replace(" ", MARK))
        head, *words = text.split(" ")
        return (self._apart(head) if head else b"") + b"".join(map(self.words.__getitem__, words))

    def surface(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a list of ids, and where each id's bytes end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        from_ = np.repeat(self.begins[ids] - (ends - sizes), sizes)
        return self.letters[from_ + np.arange(len(from_))], ends


def load(path: str) -> Pieces:
    """A vocabulary file, loaded once per worker."""

    def read() -> Pieces:
        with open(path, "rb") as file:
            return Pieces(file.read())

    return kept_by_worker(f"pieces {path}", read)


def encode(docs: DataFrame, model: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column of piece ids of the whole text.

    ``model`` is the path of the vocabulary file on every executor. Null and empty texts have no ids. Other
    columns, repeated rows and their order within a partition stay; an existing column ``out`` is replaced.
    """
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in slices(batches, text, PASS_BYTES):
            parts = [pieces.encode(t or "") for t in batch.column(text).to_pylist()]
            bounds = np.cumsum([0, *(len(p) // 4 for p in parts)])
            ids = ragged(np.frombuffer(b"".join(parts), "<i4"), bounds, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])
        pieces.words.clear()
        pieces.stretches.clear()
        give_back()

    schema = StructType([*docs.schema.fields, StructField(out, ArrayType(IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids spell; bytes that form no character become U+FFFD, null reads as no ids."""
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                column = batch.column(ids)
                lengths = np.nan_to_num(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)).astype(int)
                data, ends = pieces.surface(column.flatten().to_numpy(zero_copy_only=False))
                at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])]
                drop = int(pieces.dummy_prefix)
                data = data.tobytes()
                texts = []
                for a, b in pairwise(at):
                    part = data[a:b]
                    texts.append((part[drop:] if part[:1] == b" " else part).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out]
                )

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, StringType())]))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, n_pieces, exact): the ids of each text, and whether they decode to the very text."""
    done = decode(encode(docs.select("doc_id", "text"), model), model)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return done.select("doc_id", "ids", F.size("ids").alias("n_pieces"), same.alias("exact"))
