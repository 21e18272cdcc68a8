"""Entity files -> tables: resolve keys, keep rejects, append only new rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspark.functions.dates import sentinel_date
from taskspark.functions.texts import blank_nulls
from taskspark.operators.keys import expand, resolve, resolved, unresolved, without_partner
from taskspark.plans.entities import ENTITIES, Entity
from taskspark.session import store_and_reload
from taskspark.sources.sinks import mark_rejects
from taskspark.sources.tables import Tables


def expand_taskcode(codes: DataFrame, groups: DataFrame) -> DataFrame:
    """Task codes with their group's code and text instead of its id."""
    return expand(codes, groups, "GroupCode")


def expand_material(materials: DataFrame, categories: DataFrame) -> DataFrame:
    """Materials with their category's name instead of its id."""
    return expand(materials, categories, "Category_Id")


def expand_program(programs: DataFrame, codings: DataFrame) -> DataFrame:
    """Engine programs with coding and its text instead of its id."""
    return expand(programs, codings.withColumnRenamed("Coding", "__coding"), "CodingCode").withColumnRenamed(
        "__coding", "CodingCode"
    )


def expand_item(
    items: DataFrame,
    programs: DataFrame,
    codings: DataFrame,
    causes: DataFrame,
    damages: DataFrame,
) -> DataFrame:
    """Items with the columns of their program, cause and damage instead of the ids."""
    whole = expand_program(programs, codings).withColumnRenamed("Notification_Id", "Notification")
    df = expand(items, whole, "Notification_Id")
    df = expand(df, causes, "CauseCode")
    return expand(df, damages, "DamageCode")


def dimension(tables: Tables, entity: str) -> DataFrame:
    """Ids and business keys of an entity, to look keys up in."""
    df = tables.read(ENTITIES[entity].table)
    if entity == "TaskCode":
        groups = tables.read(ENTITIES["GroupCode"].table).select("Id", "GroupCode")
        return expand(df, groups, "GroupCode")
    if entity == "LayoutType":
        programs = tables.read(ENTITIES["EngineProgram"].table)
        numbers = programs.select("Id", F.col("Notification_Id").alias("__number"))
        return expand(df, numbers, "Notification_Id").withColumnRenamed("__number", "Notification_Id")
    return df


def prepare(entity: Entity, source: DataFrame, tables: Tables) -> DataFrame:
    """Source rows with ids for keys, dates as stored, and ``reject_reason``."""
    df = blank_nulls(source.select(*entity.columns)).withColumnsRenamed(entity.rename)
    df = resolve(df, [(look, dimension(tables, look.entity)) for look in entity.lookups])
    raw = {c: F.col(c).alias(c) for c in entity.dates}
    read = {c: sentinel_date(F.col(c)) for c in entity.dates}
    bad = [F.when(value.isNull(), f"bad date {c}") for c, value in read.items()]
    bad += [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), f"cast {c}")
        for c, t in entity.types.items()
    ]
    df = df.withColumn("reject_reason", F.coalesce("reject_reason", *bad))
    # A rejected row keeps its text so that it can be repaired.
    good = F.col("reject_reason").isNull()
    return df.withColumns({c: F.when(good, read[c]).otherwise(raw[c]) for c in entity.dates})


KNOWN = "known"


@dataclass(frozen=True)
class Loaded:
    """What one load did: rows stored, rows whose key was stored before, rows rejected.

    ``rejects`` holds the rejected rows as they came, folded to one row with its ``copies``, with
    ``reject_reason``. It is read from the stored marks, so nothing is computed again for it.
    """

    entity: str
    rows: int
    known: int
    rejected: int
    rejects: DataFrame


def mark(entity: Entity, source: DataFrame, tables: Tables) -> DataFrame:
    """Every source row once, folded with its equals to ``copies``, with what keeps it from the table.

    ``reject_reason`` is the first that holds: a required key without a match (``no <entity>``), a date
    or value that cannot be read, ``known`` for a key that is stored already, ``duplicate key`` for all
    but the least row of a key. Null for the rows to store.
    """
    df = prepare(entity, source, tables)
    if tables.exists(entity.table):
        stored = tables.read(entity.table)
        names = {k: f"__known_{k}" for k in entity.key}
        keys = stored.select(*[F.col(k).cast("string").alias(n) for k, n in names.items()]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).cast("string").eqNullSafe(F.col(n)) for k, n in names.items()])
        found = F.when(F.col("__stored"), F.lit(KNOWN))
        df = df.join(keys.withColumn("__stored", F.lit(True)), same, "left")
        df = df.withColumn("reject_reason", F.coalesce("reject_reason", found)).drop("__stored", *names.values())
    return mark_rejects(df, unique=entity.key)


def load_entity(entity: Entity, source: DataFrame, tables: Tables) -> Loaded:
    """Append the source rows whose key is not stored yet, the least row of each key.

    The rows are marked once and stored; appending, counting and rejects all read those marks. Stored,
    known and rejected rows are together the rows of ``source``. Loading the same source again stores
    nothing. Ids only have to be new and unique, so they follow the highest stored one without a sort.
    """
    marked = store_and_reload(mark(entity, source, tables), f"load-{entity.name}")
    reason = F.col("reject_reason")
    state = F.when(reason.isNull(), "new").when(reason == KNOWN, KNOWN).otherwise("rejected")
    counts = marked.groupBy(state.alias("state")).agg(F.sum("copies").alias("n")).collect()
    n = {r["state"]: r["n"] for r in counts}
    exists = tables.exists(entity.table)
    if n.get("new") or not exists:
        last = tables.read(entity.table).agg(F.max("Id")).first()[0] or 0 if exists else 0
        good = resolved(marked).drop("copies")
        good = good.withColumns({c: F.col(c).try_cast(t) for c, t in entity.types.items()})
        good = good.select((F.monotonically_increasing_id() + last + 1).alias("Id"), *good.columns)
        tables.append(good, entity.table)
    rejects = unresolved(marked).where(reason != KNOWN)
    return Loaded(entity.name, n.get("new", 0), n.get(KNOWN, 0), n.get("rejected", 0), rejects)


def load_all(sources: Mapping[str, DataFrame], tables: Tables) -> list[Loaded]:
    """Load the enabled entities, dimensions before what refers to them."""
    todo = sorted((ENTITIES[name] for name in sources), key=lambda e: e.order)
    return [load_entity(e, sources[e.name], tables) for e in todo if e.enabled]


def task_item_mismatch(tasks: DataFrame, items: DataFrame) -> DataFrame:
    """Tasks without item and items without task; both sides hold (Notification, Item) keys."""
    return without_partner(tasks, items, ["Notification", "Item"], ("task", "item"))
