"""Quality rules as a ledger: every rule is evaluated once per document and leaves a bit and its measurements.

A policy is a named set of rules, so another policy, or leaving one rule out, is bit arithmetic on the ledger
and reads no text. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = "' \\t\\n\\u000B\\f\\r'"
GAP = "[\\x20\\x09-\\x0D]+"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations",
)


@dataclass(frozen=True)
class Rule:
    """A document fails if ``fails`` (SQL over the measurements) is true."""

    name: str
    fails: str


#: The position of a rule is its bit; append only.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("capitals", "100 * n_capitals > 50 * word_chars"),
    Rule("exclamations", "100 * n_exclamations > 50 * n_words"),
)
BASE = ("few_words", "repeated_words")
#: Policies by version.
POLICIES = {1: BASE, 2: tuple(rule.name for rule in RULES)}


def mask(names: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    order = [rule.name for rule in RULES]
    return sum(1 << order.index(name) for name in names)


def _repeated_windows(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words: windows of three words sorted within their row, so equal ones are neighbours."""
    n = F.greatest(F.size("words") - 2, F.lit(0))
    docs = docs.withColumns({f"_{k}": F.slice("words", k + 1, n) for k in range(3)})
    docs = docs.withColumn("_at", F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))
    docs = docs.withColumn("_sorted", F.sort_array(F.arrays_zip("_0", "_1", "_2", "_at")))
    rest = F.greatest(F.size("_sorted") - 1, F.lit(0))
    docs = docs.withColumn("_left", F.slice("_sorted", 1, rest)).withColumn("_right", F.slice("_sorted", 2, rest))
    same = F.expr(
        "filter(arrays_zip(_left, _right), p -> p._left._2 = p._right._2 AND p._left._1 = p._right._1"
        " AND p._left._0 = p._right._0)"
    )
    docs = docs.withColumn("_same", same)
    covered = F.expr(
        "size(array_distinct(flatten(transform(_same, p -> array(p._left._at, p._left._at + 1, p._left._at + 2,"
        " p._right._at, p._right._at + 1, p._right._at + 2)))))"
    )
    names = ("_0", "_1", "_2", "_at", "_sorted", "_left", "_right", "_same")
    return docs.withColumn("n_repeat_words", covered.cast("long")).drop(*names)


def _count(pattern: str) -> Column:
    return F.expr(f"regexp_count(body, r'{pattern}')").cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, failed) of every row of ``docs`` (doc_id, text, any other columns).

    ``failed`` has bit k set if rule k fails. Null reads as the empty text, which fails few_words and has
    zeros as measurements; repeated rows stay repeated; an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    docs = docs.withColumn("_trimmed", F.expr(f"btrim(body, {WHITE})"))
    words = F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", GAP))
    docs = docs.withColumn("words", words)
    docs = docs.withColumn("_lines", F.expr(f"filter(split(body, '\\n'), x -> btrim(x, {WHITE}) != '')"))
    docs = docs.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": _count("[#*$%&|<>]"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_capitals": _count(r"\p{Lu}"),
            "n_exclamations": _count("!"),
        }
    )
    docs = _repeated_windows(docs).select("doc_id", *MEASURES)
    bits = [F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, rule in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return docs.withColumn("failed", failed)


def verdict(entries: DataFrame, version: int) -> DataFrame:
    """Adds base_failed and kept under a policy."""
    fails = lambda names: F.col("failed").bitwiseAND(F.lit(mask(names))) != 0
    return entries.withColumn("base_failed", fails(BASE)).withColumn(
        "kept", ~fails(BASE) & ~fails(POLICIES[version])
    )


def ablations(entries: DataFrame, version: int) -> DataFrame:
    """(rule, n_failed, n_alone, kept, kept_without): what each rule of a policy does, and what goes without it.

    The counts are those of ``verdict``: base rules hold under every policy, so leaving one out of a policy keeps
    no more rows. Ledger rows are first counted per combination of bits, of which there are at most 2**rules; an
    empty ledger gives no rows.
    """
    names = tuple(dict.fromkeys((*BASE, *POLICIES[version])))
    combos = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask(names))).alias("bits")).agg(F.count("*").alias("n"))
    rules = [
        F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).alias("bit"), F.lit(0 if name in BASE else mask((name,))).alias("free"))
        for name in names
    ]
    rows = combos.select("bits", "n", F.explode(F.array(*rules)).alias("x")).select("bits", "n", "x.*")
    total = lambda condition: F.sum(F.expr(f"CASE WHEN {condition} THEN n ELSE 0 END"))
    return rows.groupBy("rule").agg(
        total("(bits & bit) != 0").alias("n_failed"),
        total("bits = bit").alias("n_alone"),
        total("bits = 0").alias("kept"),
        total("(bits & ~free) = 0").alias("kept_without"),
    )
