"""Phrases against plain counting, and suffix sorting against a counter."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from taskspark.llm import collocations as module
from taskspark.llm.collocations import collocations
from taskspark.llm.suffixes import combined, frequent_prefixes

SCHEMA = "text string, lang string, a long, n string, rank int"


def plain(rows, longest, least, top, inside=50):
    f, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    strong = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in strong.items():
        longer = [b for (x, w), b in strong.items() if x == lang and len(w) > len(words)
                  and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * b >= inside * a for b in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    }


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "of", "a", "New", "york", "é", "\U0001f600", "x-1", "日本", "THE"]
    return [
        ("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(rng.randint(0, 60))),
         rng.choice(["en", "en", "de", None, "und", ""]))
        for _ in range(n)
    ]


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 10, 2000), (3, 2, 5), (2, 3, None), (4, 4, None)])
def test_phrases_equal_plain_ones(spark, longest, least, top):
    rows = texts(least, 60) + [(None, "en"), ("", None), ("long " * 20_000, "en"), ("one", "fr"), ("a b c", None)]
    rows += rows[:3]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    got = {tuple(r) for r in collocations(df, longest, least, top).collect()}
    assert got == plain(rows, longest, least, top)


def test_hot_pairs_are_dealt_out_and_added_up(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT_SHARE", 0.0)
    monkeypatch.setattr(module, "GATHER", 50)
    monkeypatch.setattr(module, "PART_ROWS", 100)
    rows = texts(8, 80)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    assert {tuple(r) for r in collocations(df, 3, 3, None).collect()} == plain(rows, 3, 3, None)


def test_no_texts(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(spark.createDataFrame([(None, None, 1, "", 1), (" . ", "en", 1, "", 1)], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_equal_partitions_are_counts(seed):
    rng = np.random.default_rng(seed)
    n, depths, least = 2_000, 3, [3, 3, 5]
    keys = rng.zipf(1.5, (depths, n)) * rng.choice([-1, 1], (depths, n))
    keys[1][rng.random(n) < 0.1] = 0
    keys[2][keys[1] == 0] = 0
    weights = rng.integers(1, 4, n)
    folded = combined(keys, weights)
    assert folded[1].sum() == weights.sum()
    for k, w in ((keys, weights), folded):
        for d, (rows, counts) in enumerate(frequent_prefixes(k, w, least), 1):
            want = Counter()
            for suffix, weight in zip(keys.T[:, :d].tolist(), weights.tolist(), strict=True):
                if 0 not in suffix:
                    want[tuple(suffix)] += weight
            got = dict(zip(map(tuple, k.T[rows, :d].tolist()), counts.tolist(), strict=True))
            assert len(got) == len(rows) and got == {x: c for x, c in want.items() if c >= least[d - 1]}


def test_no_suffixes():
    assert [len(r) for r, _ in frequent_prefixes(np.zeros((3, 0), np.int64), np.zeros(0, np.int64), [1, 1, 1])] == [0, 0, 0]
