"""Phrases whose words stand together more often than their parts would suggest, for each language.

1. Words are counted. Those below the least count end a suffix: no phrase with them can be frequent.
2. Every word position is a suffix of up to ``longest`` words inside its piece. Equal suffixes of a task are put
   together and routed by their two leading words, so that all suffixes that begin alike meet in one partition.
   Where a pair of leading words is very common (a count of hash slots tells), its suffixes are dealt out by the
   third word as well; the pair is then counted in parts that are added up.
3. Each partition sorts its suffix pointers by multikey three-way quicksort (``suffixes.frequent_prefixes``).
4. Phrases are cut, scored, compared with longer ones and ranked by joins and a range sort.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.llm.arrays import WordHasher, mix, ragged, slices
from taskspark.llm.suffixes import combined, frequent_prefixes, words_of
from taskspark.operators.ids import dense_ids
from taskspark.session import store_and_reload

LEAST = 10
LONGEST = 3
TOP = 2_000
INSIDE_PERCENT = 50
#: Bits of the table that tells which words may be frequent: 2 MB, whatever their number.
WORD_BITS = 24
PAIR_BITS = 12
#: A slot of pairs with more than this share of all words is dealt out over so many buckets.
HOT_SHARE, HOT_BUCKETS = 1 / 512, 64
#: Suffixes that a partition gets on average, and rows that a task gathers before it passes them on.
PART_ROWS = 1_500_000
GATHER = 400_000


def _pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        both = mix(first.view(np.uint64) * np.uint64(0xA24BAED4963EE407) + second.view(np.uint64))
    return (both >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """(kind, id, lang, word, n): kind 0 words, kind 1 all words of a language, kind 2 slots of neighbouring words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        slots, totals, known = np.zeros(1 << PAIR_BITS, np.int64), {}, {}

        def batch_of(kind, ids, langs, words, n):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), kind, np.int32)),
                    pa.array(ids, pa.int64()),
                    pa.array(langs, pa.string()),
                    pa.array(words, pa.string()),
                    pa.array(n, pa.int64()),
                ],
                names=["kind", "id", "lang", "word", "n"],
            )

        def passed_on():
            ids = list(known)
            langs, words, n = zip(*known.values(), strict=True) if known else ((), (), ())
            known.clear()
            return batch_of(0, ids, langs, words, n)

        for batch in slices(batches, "text"):
            data, starts, ends, row, ids, goes_on = words_of(batch.column("text"), batch.column("lang"), hasher)
            langs = batch.column("lang").to_pylist()
            for at, n in enumerate(np.bincount(row, minlength=len(langs)).tolist()):
                if n:
                    totals[langs[at]] = totals.get(langs[at], 0) + n
            on = np.flatnonzero(goes_on)
            slots += np.bincount(_pair_slots(ids[on], ids[on + 1]), minlength=len(slots))
            found, at, n = np.unique(ids, return_index=True, return_counts=True)
            whole = data.tobytes()
            for key, k, i, j, m in zip(
                found.tolist(), row[at].tolist(), starts[at].tolist(), ends[at].tolist(), n.tolist(), strict=True
            ):
                old = known.get(key)
                if old is None:
                    known[key] = [langs[k], whole[i:j].decode(), m]
                else:
                    old[2] += m
            if len(known) > GATHER:
                yield passed_on()
        yield passed_on()
        yield batch_of(1, [None] * len(totals), list(totals), [None] * len(totals), list(totals.values()))
        used = np.flatnonzero(slots)
        yield batch_of(2, used, [None] * len(used), [None] * len(used), slots[used])

    rows = docs.mapInArrow(count, "kind int, id long, lang string, word string, n long")
    name = F.struct("lang", "word")
    grouped = rows.groupBy("kind", "id", F.when(F.col("kind") == 1, F.col("lang")).alias("total_of")).agg(
        F.sum("n").alias("n"), F.min(name).alias("name"), F.max(name).alias("other")
    )
    clash = F.raise_error(F.lit("two words with one 64-bit hash"))
    sure = F.when(F.col("name").eqNullSafe(F.col("other")), F.col("name")).otherwise(clash)
    return grouped.select("kind", "id", "n", sure.alias("name")).select("kind", "id", "name.lang", "name.word", "n")


def suffix_table(docs: DataFrame, frequent: np.ndarray, hot: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(w0 .. , n, salt): suffixes of two words or more, cut before the first word that is surely infrequent.

    salt is -1, or the bucket of a suffix whose two leading words are very common.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, hot))
    names = [f"w{k}" for k in range(longest)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (bits, crowded) = WordHasher(), shared.value
        held, size = [], 0

        def passed_on():
            keys = np.concatenate([k for k, _ in held], axis=1) if held else np.zeros((longest, 0), np.int64)
            n = np.concatenate([n for _, n in held]) if held else np.zeros(0, np.int64)
            held.clear()
            keys, n = combined(keys, n)
            salt = np.full(len(n), -1, np.int64)
            if longest > 2 and len(n):
                busy = crowded[_pair_slots(keys[0], keys[1])]
                salt[busy] = mix(keys[2][busy].view(np.uint64)) % np.uint64(HOT_BUCKETS)
            return pa.RecordBatch.from_arrays(
                [*[pa.array(k) for k in keys], pa.array(n), pa.array(salt.astype(np.int32))], names=[*names, "n", "salt"]
            )

        for batch in slices(batches, "text"):
            _, _, _, _, ids, goes_on = words_of(batch.column("text"), batch.column("lang"), hasher)
            place = ids & ((1 << WORD_BITS) - 1)
            alive = (bits[place >> 6] >> (place & 63)) & 1 == 1
            fits = alive.copy()
            parts = [ids]
            for k in range(1, longest):
                more = np.zeros(len(ids), bool)
                if len(ids) > k:
                    more[:-k] = fits[:-k] & goes_on[k - 1 : -1] & alive[k:]
                fits = more
                word = np.zeros(len(ids), np.int64)
                word[fits] = ids[np.flatnonzero(fits) + k]
                parts.append(word)
            keys = np.stack(parts)[:, parts[1] != 0]
            keys, n = combined(keys, np.ones(keys.shape[1], np.int64))
            held.append((keys, n))
            size += len(n)
            if size > GATHER:
                yield passed_on()
                size = 0
        yield passed_on()

    return docs.mapInArrow(build, ", ".join(f"{x} long" for x in names) + ", n long, salt int")


def count_phrases(suffixes: DataFrame, least: int, longest: int) -> DataFrame:
    """(words, a): phrases of two words or more, as word ids, with at least ``least`` occurrences."""
    names = [f"w{k}" for k in range(longest)]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = np.stack([table[x].to_numpy() for x in names])
        n, salted = table["n"].to_numpy(), table["salt"].to_numpy() >= 0
        for part, bounds in ((~salted, [least] * longest), (salted, [1, 1, *[least] * (longest - 2)])):
            own = keys[:, part]
            if not own.shape[1]:
                continue
            for d, (rows, counts) in enumerate(frequent_prefixes(own, n[part], bounds), 1):
                if d > 1 and len(rows):
                    flat = own[:d, rows].T.ravel()
                    yield pa.RecordBatch.from_arrays(
                        [ragged(flat, np.arange(0, d * len(rows) + 1, d), pa.int64()), pa.array(counts)],
                        names=["words", "a"],
                    )

    parts = suffixes.mapInArrow(sort, "words array<long>, a long")
    return parts.groupBy("words").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int | None = TOP,
    inside_percent: int = INSIDE_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language (None: all).

    ``docs`` has lang and text; other columns are ignored. A-Z are lower-cased, texts are split into pieces at
    ``.,;:!?`` and line breaks, pieces into words at blanks and tabs. Candidates are phrases of 2 to ``longest``
    words with a >= ``least`` occurrences in pieces. Cut after the first k words, a candidate has
    l = f(first part), r = f(rest) and floor(1000000 a a / (l r)); its lowest cut counts, the smallest k on ties. A
    candidate goes if a longer one that holds its words has 100 f >= ``inside_percent`` a. Order: score, a (both
    falling), phrase by bytes. n is the number of words of the language. All arithmetic is exact.

    A null lang reads as ``und``; null and empty texts have no words; repeated rows count as often as they stand;
    an empty table gives no rows. Words are told apart by 64-bit hashes; where the counts of two tasks show two
    words under one hash, the job ends with an error. Every text is read whole, whatever its length.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counted = count_words(docs)
    counted = store_and_reload(counted.where((F.col("kind") > 0) | (F.col("n") >= least)), "words")
    words = counted.where("kind = 0").select("id", "lang", "word", "n")
    totals = counted.where("kind = 1").select("lang", "n")

    place = F.col("id").bitwiseAND((1 << WORD_BITS) - 1)
    marks = words.groupBy(F.shiftright(place, 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(id & 63 AS INT)))").alias("w"))
    marks, slots = marks.toArrow(), counted.where("kind = 2").select("id", "n").toArrow()
    frequent, pairs = np.zeros(1 << (WORD_BITS - 6), np.int64), np.zeros(1 << PAIR_BITS, np.int64)
    frequent[marks["at"].to_numpy()] = marks["w"].to_numpy()
    pairs[slots["id"].to_numpy()] = slots["n"].to_numpy()
    hot = pairs > max(HOT_SHARE * pairs.sum(), least)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(int(pairs.sum()) / PART_ROWS))
    suffixes = suffix_table(docs, frequent, hot, longest).repartition(parts, "w0", "w1", "salt")
    phrases = store_and_reload(count_phrases(suffixes, least, longest), "phrases")

    inner = F.expr("filter(transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m)), x -> size(x) = m)")
    held = phrases.where(F.size("words") > 2).withColumn("m", F.explode(F.expr("sequence(2, size(words) - 1)")))
    held = held.select(F.explode(inner).alias("words"), F.col("a").alias("longer")).groupBy("words").agg(F.max("longer").alias("longer"))
    free = phrases.join(held, "words", "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    free = store_and_reload(free.select("words", "a"), "free")

    known = phrases.union(words.select(F.array("id").alias("words"), "n"))
    cuts = free.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)"))).select(
        "words", "a", "k", F.expr("slice(words, 1, k)").alias("x"), F.expr("slice(words, k + 1, size(words) - k)").alias("y")
    )
    cuts = cuts.join(known.select(F.col("words").alias("x"), F.col("a").alias("l")), "x")
    cuts = cuts.join(known.select(F.col("words").alias("y"), F.col("a").alias("r")), "y")
    big = {x: f"CAST({x} AS DECIMAL(19, 0))" for x in "alr"}
    score = F.expr(f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * {big['a']} * {big['a']}) div ({big['l']} * {big['r']}) AS LONG)")
    scored = cuts.groupBy("words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    spelt = free.select("words", F.posexplode("words").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("words").agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
    phrase = F.expr("array_join(transform(spelt, x -> x.word), ' ')")
    named = scored.join(spelt, "words").select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score").join(totals, "lang")
    named = named.select("lang", (-F.col("score")).alias("down"), (-F.col("a")).alias("rare"), "phrase", "a", "l", "r", "n", "score")
    numbered = store_and_reload(dense_ids(store_and_reload(named, "scored"), ["lang", "down", "rare", "phrase"], distinct=True), "ranks")
    first = numbered.groupBy("lang").agg(F.min("Id").alias("first"))
    ranked = numbered.join(first, "lang").withColumn("rank", F.col("Id") - F.col("first") + 1)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
