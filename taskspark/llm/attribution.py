"""Token counts of fields and sections: a document is encoded once, whole, and its tokens' places are laid over spans.

Tokens and spans are both ordered and do not overlap among themselves, so the interval join is a merge of two
sorted lists within the row. A token that crosses a boundary is given away by a named rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.arrays import give_back, kept_by_worker

#: first: the span of its first byte; last: that of its last byte; largest: the span that holds most of its
#: bytes, the earlier one on a tie; shared: every span gets its share of the bytes.
RULES = ("first", "last", "largest", "shared")


class Bytepairs:
    """A byte-level vocabulary: ids of a text and the byte length of each id."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, at in ranks.items():
            self.sizes[at] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token of the text ends, in bytes."""
        ids = self.encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        return np.cumsum(self.sizes[ids])


def allot(ends: np.ndarray, cuts: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per span, as float. Token k covers bytes ends[k-1]..ends[k], span j covers cuts[j]..cuts[j+1]."""
    spans = len(cuts) - 1
    starts = np.concatenate([[0], ends[:-1]])
    left = np.searchsorted(cuts, starts, "right") - 1
    right = np.searchsorted(cuts, ends, "left") - 1
    if rule == "first":
        return np.bincount(left, minlength=spans).astype(float)
    if rule == "last":
        return np.bincount(right, minlength=spans).astype(float)
    inside = left == right
    out = np.bincount(left[inside], minlength=spans).astype(float)
    for k in np.flatnonzero(~inside):
        at = np.arange(left[k], right[k] + 1)
        share = np.minimum(cuts[at + 1], ends[k]) - np.maximum(cuts[at], starts[k])
        if rule == "largest":
            out[at[np.argmax(share)]] += 1
        else:
            out[at] += share / share.sum()
    return out


def attribute(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    fields: tuple[str, ...] = ("source", "lang", "text"),
    separator: str = "\n",
    rule: str = "first",
) -> DataFrame:
    """(doc_id, field, section, char_start, char_end, n_tokens, doc_tokens): one row per section of a document.

    The document is its fields in order, joined by ``separator``; it is encoded once as a whole. Every field
    is cut into sections after each line break; a separator belongs to the section before it, so sections
    cover the document without gaps and n_tokens adds up to doc_tokens. Places are code points of the whole
    document. A null or empty field is one empty section without tokens of its own (but for its separator);
    a missing field raises. Repeated rows stay repeated, an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = kept_by_worker(f"bytepairs {vocabulary}", lambda: Bytepairs(vocabulary, pattern))
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row in range(batch.num_rows):  # one document at a time: a batch may hold many long ones
                doc_id, *values = (column[row].as_py() for column in batch.columns)
                sections = []
                for k, value in enumerate(values):
                    lines = (value or "").split("\n")
                    parts = [line + "\n" for line in lines[:-1]] + lines[-1:]
                    if k < len(values) - 1:
                        parts[-1] += separator
                    sections += [(fields[k], i, part) for i, part in enumerate(parts)]
                ends = pairs.ends("".join(s[2] for s in sections))
                cuts = np.cumsum([0, *(len(s[2].encode()) for s in sections)])
                places = np.cumsum([0, *(len(s[2]) for s in sections)])
                counts = allot(ends, cuts, rule)
                out[0] += [doc_id] * len(sections)
                out[1] += [s[0] for s in sections]
                out[2] += [s[1] for s in sections]
                out[3] += places[:-1].tolist()
                out[4] += places[1:].tolist()
                out[5] += counts.tolist()
                out[6] += [len(ends)] * len(sections)
                if len(out[0]) > 50_000:
                    yield packed(out)
                    out = [[] for _ in range(7)]
            yield packed(out)
        give_back()

    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
    names = ("doc_id", "field", "section", "char_start", "char_end", "n_tokens", "doc_tokens")

    def packed(out: list[list]) -> pa.RecordBatch:
        arrays = [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(names))

    schema = "doc_id long, field string, section int, char_start long, char_end long, n_tokens double, doc_tokens long"
    chosen = [F.col(name).cast("string").alias(f"field_{k}") for k, name in enumerate(fields)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *chosen).mapInArrow(run, schema)
