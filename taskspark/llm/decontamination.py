"""Test items in training texts: rare n-grams of the items find passages, and local alignment scores them.

The test set is the stated query set. It is taken in blocks of bounded size, and each block is held against
all documents in two passes: the first counts in how many documents every n-gram of the block occurs, the
second looks for the rare ones and aligns item and passage word by word (Smith-Waterman). Nothing is shuffled
but the counts, and no document is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.arrays import LOWER, WordHasher, flat, mix, runs, slices

SEED_WORDS = 3
#: A seed is rare if at most this share of the documents has it, or so few of them that a share says nothing.
#: An item's rarest seeds always count.
RARE_SHARE = 0.0005
RARE_DOCUMENTS = 50
SEEDS_AT_LEAST = 8
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an item's best possible score from which a passage is a copy of it, and the words it must align.
THRESHOLD = 0.5
ALIGNED_WORDS = 8
#: Words of a block of test items; a block is what is sent to every task.
BLOCK_WORDS = 1_000_000
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Block:
    """Test items: their words (hashes), and their seeds in ascending order with item and place of each."""

    ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray
    items: np.ndarray
    places: np.ndarray


def read_words(texts: pa.Array, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Word hashes of all texts, the first word of each, word starts and ends in bytes, and (bytes, offsets)."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, bounds = runs(WORD[data], offsets)
    return hasher(data, starts, ends), bounds, starts, ends, (data, offsets)


def windows(words: np.ndarray, width: int = SEED_WORDS) -> np.ndarray:
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        total = total * np.uint64(0xA24BAED4963EE407) + words[k : k + len(total)]
    return mix(total)


def blocks(items: DataFrame, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """The test items in blocks of at most ``most`` words (or one longer item)."""
    hasher, size, rows = WordHasher(), 0, []
    for row in items.select("item_id", "text").where("text IS NOT NULL AND item_id IS NOT NULL").toLocalIterator():
        words = read_words(pa.array([row.text]), hasher)[0]
        if rows and size + len(words) > most:
            yield block(rows)
            size, rows = 0, []
        size += len(words)
        rows.append((row.item_id, words))
    if rows:
        yield block(rows)


def block(rows: list[tuple[int, np.ndarray]]) -> Block:
    grams = [windows(words) for _, words in rows]
    items = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
    places = np.concatenate([np.arange(len(g)) for g in grams])
    seeds = np.concatenate(grams)
    order = np.argsort(seeds, kind="stable")
    return Block([i for i, _ in rows], [w for _, w in rows], seeds[order], items[order], places[order])


class _Filter:
    """Which of many hashes are in a sorted table: a bit table first, then a search."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        size = 1 << max(12, int(16 * len(table)).bit_length())
        self.bits, self.low = np.zeros(size, bool), np.uint64(size - 1)
        self.bits[(table & self.low).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the hashes that are there, and where each first is in the table."""
        maybe = np.flatnonzero(self.bits[(hashes & self.low).astype(np.int64)])
        at = np.searchsorted(self.table, hashes[maybe])
        at[at == len(self.table)] = 0
        there = self.table[at] == hashes[maybe]
        return maybe[there], at[there]


def seed_counts(docs: DataFrame, seeds: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each (distinct, ascending) seed occurs, and how many documents there are."""
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, find = WordHasher(), _Filter(shared.value)
        counts, n = np.zeros(len(shared.value), np.int64), 0
        for batch in slices(batches, "text"):
            words, bounds, *_ = read_words(batch.column("text"), hasher)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            at, seed = find(windows(words))
            whole = rows[at] == rows[at + SEED_WORDS - 1]
            pairs = np.unique(rows[at[whole]] * len(counts) + seed[whole])
            counts += np.bincount(pairs % len(counts), minlength=len(counts))
            n += batch.num_rows
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(counts[used], n), pa.int64())],
            names=["seed", "n"],
        )

    found = docs.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    at, n = table["seed"].to_numpy(), table["n"].to_numpy()
    counts = np.zeros(len(seeds), np.int64)
    counts[at[at >= 0]] = n[at >= 0]
    return counts, int(n[at < 0].sum())


def rare(
    part: Block, counts: np.ndarray, documents: int, share: float = RARE_SHARE, least: int = SEEDS_AT_LEAST,
    few: int = RARE_DOCUMENTS,
) -> np.ndarray:
    """Which of the block's seeds (in its order) are to be looked for.

    Of every item the seeds in at most ``share`` of the documents or ``few`` of them, and in any case its ``least``
    rarest ones, so an item that many documents have copied is still found. A share of 1 keeps all seeds.
    """
    keep = counts <= max(share * documents, few)
    order = np.lexsort((counts, part.items))
    first = np.searchsorted(part.items[order], part.items[order])
    keep[order[np.arange(len(order)) - first < least]] = True
    return keep


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: score, words of the item that match in it, and the
    passage's part (start, end). Of equal scores the earliest in the item, then in the passage, counts."""
    n = len(passage)
    score, begin, same = np.zeros(n + 1, np.int64), np.arange(n + 1), np.zeros(n + 1, np.int64)
    steps = np.arange(n + 1)
    best = (0, 0, 0, 0)
    for word in item:
        hit = passage == word
        diagonal = score[:-1] + np.where(hit, MATCH, MISMATCH)
        above = score[1:] + GAP
        own = np.maximum(np.maximum(diagonal, above), 0)
        from_diagonal = diagonal >= np.maximum(above, 1)
        from_above = ~from_diagonal & (above > 0)
        start = np.where(from_diagonal, begin[:-1], np.where(from_above, begin[1:], steps[1:]))
        match = np.where(from_diagonal, same[:-1] + hit, np.where(from_above, same[1:], 0))
        # a gap along the passage: the best earlier cell, less one for each step
        level = np.concatenate([[0], own]) - GAP * steps
        high = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == high, steps, 0))
        score = np.maximum(high + GAP * steps, 0)
        begin = np.concatenate([[0], start])[source]
        same = np.concatenate([[0], match])[source]
        begin, same = np.where(score > 0, begin, steps), np.where(score > 0, same, 0)
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(same[end]), int(begin[end]), end)
    return best


def _passages(at: np.ndarray, place: np.ndarray, words: int) -> list[tuple[int, int]]:
    """Stretches of a document in which an item of ``words`` words may stand, from the places of its seeds."""
    slack = 4 + words // 4
    out: list[list[int]] = []
    for begin in np.sort(at - place) - slack:
        end = begin + words + 2 * slack
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(end))
        else:
            out.append([int(begin), int(end)])
    return [(a, b) for a, b in out]


def leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    rare_share: float = RARE_SHARE,
    seeds_at_least: int = SEEDS_AT_LEAST,
    aligned_words: int = ALIGNED_WORDS,
    rare_documents: int = RARE_DOCUMENTS,
) -> DataFrame:
    """(doc_id, item_id, score, matched_words, start, end): the best passage of every document for every item
    it has a copy of, edited or not. ``score`` is the share of the item's best possible alignment score;
    start and end are code points of the text.

    Seeds of an item that more than ``rare_share`` of the documents, and more than ``rare_documents``, have are
    looked for only if they are among its ``seeds_at_least`` rarest; a copy that shares none of the chosen seeds is
    not found. With a share of 1.0 all are looked for. Null and empty texts have no passages; an item of fewer than ``aligned_words`` words is too short
    to be told from common speech and is in no document; repeated rows stay repeated; empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, score double, matched_words long, start long, end long"
    found = docs.sparkSession.createDataFrame([], schema)
    for part in blocks(items):
        if not len(part.seeds):
            continue
        distinct, index = np.unique(part.seeds, return_inverse=True)
        counts, documents = seed_counts(docs, distinct)
        keep = rare(part, counts[index], documents, rare_share, seeds_at_least, rare_documents)
        chosen = (part.ids, part.words, part.seeds[keep], part.items[keep], part.places[keep])
        found = found.union(docs.mapInArrow(_finder(docs.sparkSession, chosen, threshold, aligned_words), schema))
    return found


def _finder(spark, chosen: tuple, threshold: float, aligned_words: int):
    # Plain arrays: a broadcast of our own class would ask every worker for an installed copy.
    shared = spark.sparkContext.broadcast(chosen)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (ids, spelt, seeds, items, places) = WordHasher(), shared.value
        table, first = np.unique(seeds, return_index=True)
        last = np.append(first[1:], len(seeds))
        look = _Filter(table)
        for batch in slices(batches, "text"):
            words, bounds, starts, ends, (data, offsets) = read_words(batch.column("text"), hasher)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            at, seed = look(windows(words))
            whole = rows[at] == rows[at + SEED_WORDS - 1]
            at, seed = at[whole], seed[whole]
            sizes = last[seed] - first[seed]
            entry = np.repeat(first[seed] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            at = np.repeat(at, sizes)
            item, place, row = items[entry], places[entry], rows[at]
            order = np.lexsort((at, item, row))
            cuts = np.flatnonzero(np.diff(row[order]) | np.diff(item[order])) + 1
            out: list[list] = [[] for _ in range(6)]
            for group in np.split(order, cuts) if len(order) else []:
                doc, which = int(row[group[0]]), int(item[group[0]])
                low, high = bounds[doc], bounds[doc + 1]
                own, best = spelt[which], (0, 0, 0, 0)
                for a, b in _passages(at[group], place[group], len(own)):
                    a = max(a, int(low))
                    score, same, begin, end = align(own, words[a : min(b, int(high))])
                    if score > best[0]:
                        best = (score, same, a + begin, a + end - 1)
                share = best[0] / (MATCH * len(own))
                if share >= threshold and best[1] >= aligned_words:
                    text = data[offsets[doc] : offsets[doc + 1]]
                    letters = np.cumsum((text & 0xC0) != 0x80)
                    begin, end = starts[best[2]] - offsets[doc], ends[best[3]] - offsets[doc]
                    values = (batch.column("doc_id")[doc].as_py(), ids[which], share, best[1],
                              int(letters[begin]) - 1, int(letters[end - 1]))
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "item_id", "score", "matched_words", "start", "end"],
            )

    return find


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item; rows without an id are judged as one document."""
    found = leaks(docs, items, threshold).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_leaked"]), "left_anti")
