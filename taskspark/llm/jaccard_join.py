"""Exact n-gram Jaccard self-join by a token-group matrix, and the groups that its links form.

1. Distinct shingle sets: rows with equal sets are one *class*, named by its smallest doc_id.
2. A global order of shingles: those that many documents share come last. Which are frequent is read from
   counts of hash slots over all documents (a table of fixed size). Any order gives the same links; this one
   keeps common passages out of the prefixes.
3. Two sets with the similarity t share a shingle that is among the first n - ceil(t n) + 1 of the larger set and
   among the first n - ceil(2 t n / (1 + t)) + 1 of the smaller. The former is a set's prefix, the latter its
   *short* prefix. Shingles that two classes have in their prefixes, one of them in the short one, are the
   columns of the matrix. Pages of one template that differ too much have their own words there, as common
   shingles come last, so they never meet. Prefixes are EXTRA longer where that adds no more common ones: two such
   sets share EXTRA more, so those that share one passage by chance are told apart before anything wide moves.
4. Groups: every class is compared with two classes at each of its columns, the smallest and the most central,
   and linked classes are one group. Of a group, the union of its members' shingles is stored as a bitmap: a row
   of the matrix.
5. Every class is a query against the groups it shares a column with but does not belong to, where that column
   is short on either side, the sizes fit, and enough shingles follow for a link. The bitmap bounds the overlap
   from above: shingles of the query whose bit is missing are in no member. Only groups that can still reach the
   overlap that a link asks for are opened, and their members compared exactly.

Every link between classes either lies inside one group (already connected) or is found in step 5, so the
components are those of all links, while no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from taskspark.llm.arrays import WordHasher, give_back, ragged, slices
from taskspark.llm.components import components
from taskspark.llm.shingles import WIDTH, bitmap, common, fold, missing, shingle_sets
from taskspark.session import store_and_reload

PERCENT = 80
SLOT_BITS = 18
#: Bits of the table that tells which ids a step may need: 2 MB, whatever the number of ids.
ID_BITS = 24
#: Shingles by which prefixes are longer than needed to share one; such sets must share as many more.
EXTRA = 2
#: Text that a task takes at once, and what a writer gathers of bitmaps before it passes them on.
PASS_BYTES = 1 << 19
GROUP_BYTES = 16 << 20


def _slot(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def frequency_ranks(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """A rank per hash slot: 0 for the bulk, higher the more its shingles exceed it. 2**SLOT_BITS bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = WordHasher(), np.zeros(1 << SLOT_BITS, np.int64)
        for batch in slices(batches, "text", PASS_BYTES):
            found = shingle_sets(batch.column("text"), hasher, width)
            counts += np.bincount(_slot(np.concatenate(found)), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["slot", "n"])

    table = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SLOT_BITS)
    counts[table["slot"].to_numpy()] = table["n"].to_numpy()
    mean = counts.mean()
    usual = mean + 6 * np.sqrt(mean) + 8
    return np.ceil(np.log2(np.maximum(counts / usual, 1))).astype(np.uint8)


def shingle_table(docs: DataFrame, ranks: np.ndarray, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(doc_id, n, digest, mark, prefix, short, bulk, bits, alone) of every row: set size, set digest (whole and 48
    bits of it), prefix shingles, how many of them are the short prefix, how many have the rank 0, which come first,
    bitmap, whether the prefix is as short as can be. It is EXTRA longer if that adds none of a higher rank than the
    short prefix has. A set that only its equal can link with has no prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        hasher, order = WordHasher(), shared.value
        for batch in slices(batches, "text", PASS_BYTES):
            sets = shingle_sets(batch.column("text"), hasher, width)
            prefixes, shorts, bulks, bits, digests, alone = [], [], [], [], [], []
            for values in sets:
                n = len(values)
                length = n + (-percent * n) // 100 + 1 if n else 0
                short = n + (-2 * percent * n) // (100 + percent) + 1 if n else 0
                if length <= 1 and 100 * n // percent <= n:
                    length = short = 0
                rank = order[_slot(values)]
                places = np.argsort(rank, kind="stable")
                alone.append(not 0 < length <= n - EXTRA or rank[places[length + EXTRA - 1]] > rank[places[short - 1]])
                if not alone[-1]:
                    length, short = length + EXTRA, short + EXTRA
                shorts.append(short)
                prefixes.append(values[places[:length]])
                bulks.append(min(length, np.count_nonzero(rank == 0)))
                bits.append(bitmap(values).tobytes() if n else b"")
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            bounds = np.cumsum([0, *map(len, prefixes)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(v) for v in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([int.from_bytes(d[:6], "little") for d in digests], pa.int64()),
                    ragged(np.concatenate(prefixes).view(np.int64), bounds, pa.int64()),
                    pa.array(shorts, pa.int32()),
                    pa.array(bulks, pa.int32()),
                    pa.array(bits, pa.binary()),
                    pa.array(alone, pa.bool_()),
                ],
                names=["doc_id", "n", "digest", "mark", "prefix", "short", "bulk", "bits", "alone"],
            )

    schema = "doc_id long, n long, digest binary, mark long, prefix array<long>, short int, bulk int, bits binary, alone boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, schema)


def _asked(x: str, y: str, percent: int) -> str:
    """SQL: how many shingles sets of the sizes ``x`` and ``y`` must have in common to link."""
    return f"({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent}"


def _meeting(left: DataFrame, right: DataFrame, on: list[str], percent: int) -> DataFrame:
    """Rows ``left`` (r, n, rest, short, alone, token, ..) and rows or groups ``right`` (b, b_low, b_high, b_rest,
    b_short, b_any, b_all, token, ..) that may link, at every column they have in common: (a, b, n, weight, g if left has it).

    One side is short: two joins, so that no pair of two long sides is ever formed. The sizes leave the similarity
    possible. And behind the first common shingle, itself included, either set has ``rest`` shingles, of which
    as many must be common as a link asks for; the least y that can link counts, and the longest rest of a group.
    Where neither prefix is alone, this holds for the first EXTRA + 1 common shingles but for those before them. All
    of them are met, so their weights add up to EXTRA + 1; where one is alone, the first one weighs as much.
    """
    least = f"greatest(b_low, ({percent} * n + 99) div 100)"
    asked, rest = _asked("n", least, percent), "least(rest, b_rest)"
    sizes = f"100 * b_high >= {percent} * n AND 100 * n >= {percent} * b_low"
    fits = F.expr(f"{sizes} AND {rest} >= {asked} - IF(alone OR b_all, 0, {EXTRA})")
    weight = F.expr(f"IF((alone OR b_any) AND {rest} >= {asked}, {EXTRA + 1}, 1)").alias("weight")
    out = []
    for own, other in ((left.where("short"), right), (left.where("NOT short"), right.where("b_short"))):
        met = own.alias("x").join(other.alias("y"), [*(F.col(f"x.{c}") == F.col(f"y.{c}") for c in on), fits])
        out.append(met.select(F.col("x.r").alias("a"), F.col("y.b").alias("b"), "n", weight, *[F.col(f"x.{c}") for c in left.columns if c == "g"]))
    return out[0].union(out[1])


def _enough(met: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``met`` (a, b, n, weight) that meet in as many columns as a link takes."""
    least = _asked("n", f"({percent} * n + 99) div 100", percent)
    pairs = met.groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.min("n").alias("n"))
    return pairs.where(F.expr(f"weight >= least({EXTRA + 1}, {least})")).select("a", "b")


def _bounded(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their sizes and bitmaps leave possible; needs a_n, a_bits, b_low, b_high, b_bits.

    A set of x shingles needs ceil(p (x + y) / (100 + p)) of them in common with one of y, of which the least y that
    can link counts.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for spare, own, other in zip(
                batch.column("spare").to_pylist(), batch.column("a_bits"), batch.column("b_bits"), strict=True
            ):
                gone = missing(np.frombuffer(own.as_buffer(), np.uint8), np.frombuffer(other.as_buffer(), np.uint8))
                marks.append(gone <= spare)
            yield batch.select(["a", "b"]).filter(pa.array(marks, pa.bool_()))
            del batch, own, other
        give_back()

    fits = (F.col("b_high") * 100 >= F.col("a_n") * percent) & (F.col("a_n") * 100 >= F.col("b_low") * percent)
    least = f"greatest(b_low, ({percent} * a_n + 99) div 100)"
    spare = F.expr(f"a_n - {_asked('a_n', least, percent)}")
    rows = pairs.where(fits).withColumn("spare", spare).where("spare >= 0")
    return rows.select("a", "b", "spare", "a_bits", "b_bits").mapInArrow(keep, "a long, b long")


def _needed(rows: DataFrame, name: str, ids: DataFrame) -> DataFrame:
    """Those of ``rows`` whose ``name`` may be one of ``ids`` (id), so that the others' texts and bitmaps need
    not move for the join that follows. A table of hash bits decides: of a fixed size, the fuller the more it
    lets through."""
    return rows.where(F.col(name).isNotNull()).where(_maybe(name, ids))


def _maybe(name: str, ids: DataFrame) -> Column:
    """Whether column ``name`` may be one of ``ids`` (id): never false for one that is."""
    place = F.pmod(F.xxhash64(name), F.lit(1 << ID_BITS))
    marks = ids.select(F.col("id").alias(name)).select(place.alias("h"))
    marks = marks.groupBy(F.shiftright("h", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(h & 63 AS INT)))").alias("w"))
    found = marks.toArrow()
    bits = np.zeros(1 << (ID_BITS - 6), np.int64)
    bits[found["at"].to_numpy()] = found["w"].to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(bits)

    def known(places: pa.Array) -> pa.Array:
        h = places.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[h >> 6] >> (h & 63)) & 1 == 1)

    return F.arrow_udf(known, "boolean")(place)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def _similar(pairs: DataFrame, docs: DataFrame, sets: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets have the similarity, compared shingle by shingle."""
    pairs = store_and_reload(pairs, "pairs")
    sizes = _needed(sets.where("n > 0").select("doc_id", "n", "bits"), "doc_id", _ends(pairs))
    left = sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    right = sizes.select(
        F.col("doc_id").alias("b"), F.col("n").alias("b_low"), F.col("n").alias("b_high"), F.col("bits").alias("b_bits")
    )
    likely = store_and_reload(_bounded(pairs.join(left, "a").join(right, "b"), percent), "likely")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = _needed(texts, "id", _ends(likely))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches, "a_text"):
            marks = []
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                for x, y in zip(
                    shingle_sets(part.column("a_text"), hasher, width),
                    shingle_sets(part.column("b_text"), hasher, width),
                    strict=True,
                ):
                    both = common(x, y)
                    marks.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(marks, pa.bool_()))

    rows = likely.join(texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a")
    rows = rows.join(texts.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")
    found = rows.select("a", "b", "a_text", "b_text").mapInArrow(compare, "a long, b long")
    return store_and_reload(found.distinct(), "similar")


def _group_unions(members: DataFrame) -> DataFrame:
    """(g, low, high, bits) of each group from (g, n, bits): its smallest and largest set, its token union.

    Unions are formed within every partition first, so a large group sends one row per partition.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                bits = np.frombuffer(row["bits"], np.uint8)
                old = kept.get(row["g"])
                if old is None:
                    kept[row["g"]] = [row["low"], row["high"], bits]
                else:
                    size = min(len(bits), len(old[2]))
                    old[:] = [min(old[0], row["low"]), max(old[1], row["high"]), fold(old[2], size) | fold(bits, size)]
            if sum(len(x[2]) for x in kept.values()) > 1 << 26:
                yield packed(kept)
                kept = {}
        yield packed(kept)

    def packed(kept: dict[int, list]) -> pa.RecordBatch:
        rows = [(g, low, high, bits.tobytes()) for g, (low, high, bits) in kept.items()]
        g, low, high, bits = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (g, low, high)] + [pa.array(bits, pa.binary())],
            names=["g", "low", "high", "bits"],
        )

    schema = "g long, low long, high long, bits binary"
    partial = members.select("g", F.col("n").alias("low"), F.col("n").alias("high"), "bits").mapInArrow(merge, schema)

    def finish(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(merge(table.to_batches()))

    return partial.groupBy("g").applyInArrow(finish, schema)


def _places(sets: DataFrame, which: str) -> DataFrame:
    """(mark, token, n, rest, short, alone) of every prefix shingle at a place ``which`` tells."""
    places = sets.select("mark", "n", "short", "bulk", "alone", F.posexplode("prefix").alias("at", "token")).where(which)
    return places.select("mark", "token", "n", (F.col("n") - F.col("at")).alias("rest"), (F.col("at") < F.col("short")).alias("short"), "alone")


def _folded(places: DataFrame, name: str) -> DataFrame:
    """One row for those of ``places`` that copies of one set, or texts of one id, have at the same shingle."""
    by = places.groupBy(name, "token", "n", "alone")
    return by.agg(F.max("rest").alias("rest"), F.max("short").alias("short")).select(name, "token", "n", "rest", "short", "alone")


def matrix_columns(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(r, token, n, rest, short, alone): the prefix shingles of every class that another one shares and one of them has
    in short, with the set's size, how many of its shingles begin there, and whether its prefix is as short as can be.

    Shingles of rank 0, nearly all, are in no more documents than a hash slot usually holds shingles: a window moves
    their places once. The others may be in any number of documents: they are folded first and joined back. Places
    name their set only; its ids come to the few that are shared.
    """
    sets = sets.where("doc_id IS NOT NULL")
    by = Window.partitionBy("token")
    usual = _places(sets, "at < bulk").withColumns(
        {"low": F.min("mark").over(by), "high": F.max("mark").over(by), "any": F.max("short").over(by)}
    )
    often = _folded(_places(sets.where("bulk < size(prefix)"), "at >= bulk"), "mark")
    shared = often.groupBy("token").agg(F.min("mark").alias("low"), F.max("mark").alias("high"), F.max("short").alias("any"))
    shared = shared.where("low < high AND any").select("token")
    places = _folded(usual.where("low < high AND any"), "mark").unionByName(often.join(shared, "token"))
    heads = rows.where("doc_id = rep").select("doc_id").distinct()
    heads = sets.where("n > 0").select("doc_id", "mark").join(heads, "doc_id", "left_semi").distinct()
    columns = places.join(heads.withColumnRenamed("doc_id", "r"), "mark")
    # a doc_id with several texts stands for each of them
    return store_and_reload(_folded(columns, "r"), "columns")


def central_links(columns: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): every class with the smallest and with the most central class at each of its columns, to be compared,
    unless their sizes, or what follows in them, rule out a link whose first common shingle is there.

    Copies mostly link with the text they were made from, less with each other. That text often has the smallest
    id; else it tends to be central, as its columns are shared by many copies.
    """
    crowd = columns.groupBy("token").agg(F.count("*").alias("m"))
    degree = columns.join(crowd, "token").groupBy("r").agg(F.sum("m").alias("degree"))
    ranked = columns.select("token", (-F.col("r")).alias("id"), "n", "rest", "r").join(degree, "r")
    hubs = ranked.groupBy("token").agg(
        F.max(F.struct("degree", "id", "n", "rest")).alias("x"), F.max(F.struct("id", "n", "rest")).alias("y")
    )
    hubs = hubs.select("token", F.inline(F.array(F.struct("x.id", "x.n", "x.rest"), "y")))
    hubs = hubs.select("token", (-F.col("id")).alias("b"), F.col("n").alias("b_n"), F.col("rest").alias("b_rest"))
    # an id with several texts has several sizes; a pair that is left out for one of them is met in step 5
    sizes = f"100 * b_n >= {percent} * n AND 100 * n >= {percent} * b_n"
    fits = F.expr(f"{sizes} AND least(rest, b_rest) >= {_asked('n', 'b_n', percent)}")
    met = columns.select("token", F.col("r").alias("a"), "n", "rest").join(hubs, "token").where("a != b").where(fits)
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def asked_groups(open_rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): classes and the other groups they may link into, from (token, r, n, rest, short, alone, g)."""
    cells = open_rows.groupBy("token", F.col("g").alias("b")).agg(
        F.min("n").alias("b_low"), F.max("n").alias("b_high"), F.max("rest").alias("b_rest"),
        F.max("short").alias("b_short"), F.max("alone").alias("b_any"), F.min("alone").alias("b_all"),
    )
    return _enough(_meeting(open_rows, cells, ["token"], percent).where("g > b"), percent)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text, any other columns).

    Two documents link when their shingle sets have a Jaccard similarity of at least ``percent`` / 100;
    component_id is the smallest doc_id reachable by links. Null and empty texts have no shingles and link
    with nothing. Repeated rows stay repeated; rows that repeat a doc_id are one document to the links. A
    null doc_id names no document: its row takes part only through rows with the very same set.
    An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    ranks = frequency_ranks(docs, width)
    sets = store_and_reload(shingle_table(docs, ranks, percent, width), "shingles", GROUP_BYTES)

    classes = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    rows = store_and_reload(sets.select("doc_id", "n", "digest").join(classes, "digest", "left").drop("digest"), "classes")

    columns = matrix_columns(sets, rows)

    links = _similar(central_links(columns, percent), docs, sets, percent, width)
    groups = components(links)

    named = columns.join(groups.withColumnRenamed("node", "r"), "r", "left")
    named = store_and_reload(named.select("token", "r", "n", "rest", "short", "alone", F.coalesce("component", "r").alias("g")), "matrix")
    several = named.groupBy("token").agg(F.min("g").alias("x"), F.max("g").alias("y")).where("x < y").select("token")
    open_rows = store_and_reload(named.join(several, "token", "left_semi"), "open")
    # a link to another group shares a shingle with it, so its ends are all in open_rows
    asked = store_and_reload(asked_groups(open_rows, percent), "asked")
    ends = store_and_reload(open_rows.select(F.col("r").alias("id"), "g").distinct(), "ends")
    member = ends.join(asked.select(F.col("b").alias("g")).distinct(), "g", "left_semi")
    wanted = asked.select(F.col("a").alias("id")).union(member.select("id")).distinct()
    # a doc_id may have a text without words beside others
    rows_of = _needed(sets.where("n > 0").select("doc_id", "n", "bits"), "doc_id", wanted)
    unions = _group_unions(rows_of.join(member, rows_of["doc_id"] == member["id"]).select("g", "n", "bits")).select(
        F.col("g").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"), F.col("bits").alias("b_bits")
    )
    query = rows_of.select(F.col("doc_id").alias("a"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    opened = store_and_reload(_bounded(asked.join(query, "a").join(unions, "b"), percent), "opened")

    queries = opened.select(F.col("a").alias("r"), F.col("b").alias("g_open")).distinct()
    queries = queries.join(open_rows.drop("g"), "r")
    inside = open_rows.select(
        "token", F.col("r").alias("b"), F.col("g").alias("g_open"), F.col("n").alias("b_low"), F.col("n").alias("b_high"),
        F.col("rest").alias("b_rest"), F.col("short").alias("b_short"), F.col("alone").alias("b_any"), F.col("alone").alias("b_all"),
    )
    pairs = _enough(_meeting(queries, inside, ["token", "g_open"], percent), percent)
    found = components(links.union(_similar(pairs, docs, sets, percent, width)))

    named_rows = rows.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    return named_rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One document of each group of near copies: the row with the smallest doc_id; repeats of it go too.

    Documents without words stay. Rows with a null doc_id stay unless they are copies of a document with one.
    Only texts of rows that may have to go are moved.
    """
    groups = store_and_reload(near_duplicates(docs, percent, width), "groups")
    gone = groups.where("doc_id != component_id OR (doc_id IS NULL AND component_id IS NOT NULL)").select("doc_id")
    several = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    doubt = store_and_reload(gone.union(several).where("doc_id IS NOT NULL").distinct(), "doubt")
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    maybe = _maybe("doc_id", doubt.select(F.col("doc_id").alias("id")))
    named = docs.where("doc_id IS NOT NULL")
    sure = named.where(~maybe)
    judged = named.where(maybe).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where("doc_id IS NULL")
    if gone.where("doc_id IS NULL").limit(1).count():
        nameless = _nameless(nameless, docs, width)
    return sure.union(judged.select(*docs.columns)).union(nameless)


def _nameless(rows: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Rows without an id whose shingle set no row with an id has."""
    nothing = np.zeros(1 << SLOT_BITS, np.uint8)
    known = shingle_table(docs.where("doc_id IS NOT NULL"), nothing, PERCENT, width).where("n > 0").select("digest")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        hasher = WordHasher()
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), hasher, width)
            digests = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in sets]
            yield batch.append_column("_digest", pa.array(digests, pa.binary()))

    schema = StructType([*rows.schema.fields, StructField("_digest", BinaryType())])
    marked = rows.mapInArrow(add, schema)
    return marked.join(known.withColumnRenamed("digest", "_digest").distinct(), "_digest", "left_anti").drop("_digest")
