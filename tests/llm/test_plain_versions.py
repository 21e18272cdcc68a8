"""Operators against plain versions of themselves: best segmentations, alignments of all pairs, tokens by hand, features."""

import hashlib
import math
import random

import pytest
import sentencepiece
import tiktoken
import tiktoken.load
from pyspark.sql import functions as F

import corpus_pipeline
from taskspark.llm import decontamination, jaccard_join, pieces, queries, toxicity
from taskspark.llm.attribution import RULES, attribute
from taskspark.llm.chat import format_conversations, read_back
from tests.llm.test_operators import FOLDER, ODD, SCHEMA, components

MARK = "▁"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def vocabulary():
    known = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    plain = [k for k in range(known.get_piece_size()) if not (known.is_control(k) or known.is_unknown(k) or known.is_byte(k))]
    return known, {known.id_to_piece(k): (known.get_score(k), k) for k in plain}


def best_ways(text, scores, unknown):
    """Best score of a segmentation, in how many ways it comes about, and one of them (None for a character in bytes)."""
    longest = max(map(len, scores))
    best, ways, last = [0.0] + [-math.inf] * len(text), [1] + [0] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for size in range(1, min(end, longest) + 1):
            part = text[end - size : end]
            score, at = scores.get(part, (unknown if size == 1 else -math.inf, None))
            total = best[end - size] + score
            if total > best[end]:
                best[end], ways[end], last[end] = total, ways[end - size], (size, at)
            elif total == best[end] and total > -math.inf:
                ways[end] += ways[end - size]
    out, end = [], len(text)
    while end:
        size, at = last[end]
        out.append(at if at is not None else text[end - 1])
        end -= size
    return best[-1], ways[-1], out[::-1]


def test_pieces_are_a_best_segmentation_and_the_one_where_it_is_unique(spark, docs, vocabulary):
    known, scores = vocabulary
    unknown = min(s for s, _ in scores.values()) - pieces.UNKNOWN_PENALTY
    extra = spark.createDataFrame([(-1, "日本語 é \U0001f600\U0001f600 ñandú  two   blanks\n\ttabs "), (-2, "a"), (-3, " ")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").where("text != ''").limit(25).union(extra)
    unique = 0
    for r in pieces.encode(rows, queries.PIECES).collect():
        score, ways, want = best_ways((" " + r.text).replace(" ", MARK), scores, unknown)
        got, total, k = list(r.ids), 0.0, 0
        while k < len(got):
            if known.is_byte(got[k]):
                lead = int(known.id_to_piece(got[k])[3:5], 16)
                k += 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
                total += unknown
            else:
                total += known.get_score(got[k])
                k += 1
        assert total == pytest.approx(score, abs=1e-6 * max(len(got), 1))
        if ways == 1:
            unique += 1
            spelt = [x for w in want for x in ([w] if isinstance(w, int) else [known.piece_to_id(f"<0x{b:02X}>") for b in w.encode()])]
            assert got == spelt
    assert unique


def test_null_ids_decode_to_nothing_and_other_columns_stay(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, [], "y"), (2, [], "y")], "doc_id long, ids array<int>, text string")
    assert sorted(map(tuple, pieces.decode(rows, queries.PIECES).collect())) == [(1, None, "x", ""), (2, [], "y", ""), (2, [], "y", "")]
    assert pieces.decode(rows.limit(0), queries.PIECES).collect() == []


def best_share(item, words):
    """Smith-Waterman of two word lists, as a share of the item's best score."""
    match, mismatch, gap = decontamination.MATCH, decontamination.MISMATCH, decontamination.GAP
    row, best = [0] * (len(words) + 1), 0
    for a in item:
        corner, row[0] = row[0], 0
        for j, b in enumerate(words, 1):
            value = max(0, corner + (match if a == b else mismatch), row[j] + gap, row[j - 1] + gap)
            corner, row[j] = row[j], value
            best = max(best, value)
    return best / (match * len(item))


@pytest.mark.parametrize(("settings", "least"), [({}, 0.95), ({"rare_share": 1.0}, 0.95), ({"rare_documents": 0}, 0.8)])
def test_recall_against_an_alignment_of_all_pairs(spark, settings, least):
    """By default, with all seeds, and with only the rarest eight of an item, as if all were frequent."""
    rng = random.Random(7)
    common = [f"w{k}" for k in range(150)]
    items = [[rng.choice(common) for _ in range(rng.randint(16, 40))] for _ in range(12)]
    rows = []
    for k in range(80):
        words = [rng.choice(common) for _ in range(rng.randint(20, 120))]
        if k % 4:
            copy = []
            for w in rng.choice(items):
                kind = rng.random() / max(0.02, (k % 7) / 18)
                copy += [] if kind < 0.25 else ["new", w] if kind < 0.5 else ["other"] if kind < 1 else [w]
            at = rng.randrange(len(words))
            words[at:at] = copy
        rows.append((k, " ".join(words)))
    few = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.leaks(few, asked, **settings).collect()}
    shares = {(k, i): best_share(item, text.split()) for k, text in rows for i, item in enumerate(items)}
    want = {pair for pair, s in shares.items() if s >= decontamination.THRESHOLD}
    assert set(got) <= want and all(s <= shares[pair] + 1e-9 for pair, s in got.items())
    recall = len(set(got) & want) / len(want)
    print("recall", settings, recall, len(want))
    assert len(want) > 30 and recall >= least


def test_leaks_of_odd_rows(spark, odd):
    text = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame(
        [(1, text, "x", 1.0), (1, text, "x", 1.0), (2, None, None, None), (None, text, "x", 1.0), (3, "", "x", 1.0), (4, "one two three", "x", 0.0)],
        "item_id long, text string, doc_id string, score double",
    )
    copy = spark.createDataFrame([(8, "a", "en", f"so {text}", 1, 0.0, 1), (8, "a", "en", f"so {text}", 1, 0.0, 1)], SCHEMA)
    all_rows = odd.union(copy)
    found = decontamination.leaks(all_rows, items).collect()
    assert {(r.doc_id, r.item_id, r.score, r.start, r.end) for r in found} == {(8, 1, 1.0, 3, 3 + len(text))}
    kept = decontamination.without_leaks(all_rows, items)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in ODD), key=str)
    assert decontamination.without_leaks(odd.limit(0), items).collect() == []


def plain_allot(text, spans, sizes, rule):
    """Tokens of each span, token by token. Spans and tokens are byte ranges."""
    out, at = [0.0] * len(spans), 0
    for size in sizes:
        inside = [max(0, min(b, at + size) - max(a, at)) for a, b in spans]
        hit = [k for k, n in enumerate(inside) if n]
        if rule == "shared":
            for k in hit:
                out[k] += inside[k] / size
        else:
            out[{"first": hit[0], "last": hit[-1], "largest": max(hit, key=lambda k: (inside[k], -k))}[rule]] += 1
        at += size
    return out


@pytest.mark.parametrize("rule", RULES)
def test_sections_get_the_tokens_laid_out_by_hand(spark, docs, odd, rule):
    ranks = tiktoken.load.load_tiktoken_bpe(queries.BYTEPAIRS)
    known = tiktoken.Encoding("x", pat_str=queries.BYTEPAIR_PATTERN, mergeable_ranks=ranks, special_tokens={})
    names = ["doc_id", "source", "lang", "text"]
    lines = spark.createDataFrame([(-1, "a", "b", "x\n\n  \n\n\ny = 1\n\n\n\nz  \n"), (-2, "", None, "\n"), (-3, "é\U0001f600", "語\n", "\r\n")], "doc_id long, source string, lang string, text string")
    rows = docs.select(names).limit(15).union(odd.select(names)).union(lines)
    want = []
    for r in rows.collect():
        sections = []
        for k, name in enumerate(names[1:]):
            parts = (r[name] or "").split("\n")
            parts = [p + "\n" for p in parts[:-1]] + [parts[-1] + ("\n" if k < 2 else "")]
            sections += [(name, i, p) for i, p in enumerate(parts)]
        text = "".join(p for _, _, p in sections)
        sizes = [len(known.decode_single_token_bytes(t)) for t in known.encode_ordinary(text)]
        cuts, places = [0], [0]
        for _, _, p in sections:
            cuts.append(cuts[-1] + len(p.encode()))
            places.append(places[-1] + len(p))
        counts = plain_allot(text, list(zip(cuts, cuts[1:])), sizes, rule)
        want += [(r.doc_id, n, i, places[k], places[k + 1], round(counts[k], 6), len(sizes)) for k, (n, i, _) in enumerate(sections)]
    got = [(*tuple(r)[:5], round(r.n_tokens, 6), r.doc_tokens) for r in attribute(rows, queries.BYTEPAIRS, queries.BYTEPAIR_PATTERN, rule=rule).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert attribute(rows.limit(0), queries.BYTEPAIRS, queries.BYTEPAIR_PATTERN, rule=rule).collect() == []


def test_conversations_with_nulls_ties_and_clashing_names(spark):
    rows = [
        (1, 0, "user", "b", "x", 1), (1, 0, "user", "a", "x", 1), (1, 0, "user", "a", "x", 1), (1, None, "assistant", "first", "x", 1),
        (2, 0, None, "no role", "x", 1), (2, 1, "assistant", None, "x", 1), (None, 0, "user", "nobody", "x", 1), (3, 0, "assistant", "y" * 200_000, "x", 1),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string, n_turns int")
    got = {r.conv_id: r for r in read_back(format_conversations(turns)).collect()}
    order = {1: [("assistant", "first"), ("user", "a"), ("user", "a"), ("user", "b")], 2: [("", "no role"), ("assistant", "")],
             None: [("user", "nobody")], 3: [("assistant", "y" * 200_000)]}
    assert set(got) == set(order)
    for conv, turns_ in order.items():
        every = "".join(f"{r}\n{t}\n" for r, t in turns_)
        loss = "".join(t for r, t in turns_ if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns_), hashlib.sha256(every.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_toxicity_features_by_hand(spark, odd):
    names = toxicity.FEATURES
    at = lambda text, lexicon=None: dict(zip(names, toxicity.features(text, lexicon or {}), strict=True))
    word = sorted(toxicity.INSULTS)[0]
    f = at(f"You are a {word}! WOW! Why? Foul words", {"foul": toxicity.STRONG + 1.0, "words": toxicity.STRONG - 0.5})
    n = 8
    assert f["log_words"] == pytest.approx(math.log1p(n)) and f["insult_density"] == pytest.approx(1 / n)
    assert (f["strong_density"], f["weak_density"]) == (pytest.approx(1 / n), pytest.approx(1 / n))
    assert f["heaviest"] == toxicity.STRONG + 1.0 and f["second_person"] == pytest.approx(1 / n)
    assert f["proximity"] == pytest.approx(1 / 4) and f["distinct"] == 1.0
    assert (f["exclamations"], f["questions"]) == (pytest.approx(2 / n), pytest.approx(1 / n))
    assert set(toxicity.features(None, {})) == {0.0} and set(toxicity.features("", {})) == {0.0}
    rows = toxicity.with_features(odd, {"one": 3.0}, ["doc_id"]).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((r[0] for r in ODD), key=str)
    assert all(len(r.features) == len(names) for r in rows)


def test_toxicity_without_labels_is_the_share(spark, odd):
    labels = spark.createDataFrame([(4, None), (None, 1), (5, 0), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    assert toxicity.score(odd.limit(0), toxicity.fit(odd, labels.limit(0))).collect() == []


def test_stages_on_odd_rows(spark, docs, odd):
    """A stage keeps the columns it gets, whatever they are called; ids here stand for several texts, some without words."""
    wide = docs.select(*[c for c in odd.columns if c in docs.columns]).limit(300)
    for c in odd.columns:
        if c not in wide.columns:
            wide = wide.withColumn(c, F.lit(1).cast(odd.schema[c].dataType))
    rows = wide.select(odd.columns).union(odd).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, rows, FOLDER)
        assert got.columns == odd.columns, name
        ids = {r.doc_id for r in got.select("doc_id").collect()}
        assert {4, 6, None} & ids and stage(spark, odd.limit(0), FOLDER).collect() == [], name
    last = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER)
    assert last.count() == rows.count() and set(odd.columns) < set(last.columns)


def test_an_id_may_have_a_text_without_words_beside_others(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([*base[:-1], f"x{k}"])) for k in range(20)] + [(k, None) for k in range(0, 20, 2)] + [(3, " \n")]
    rows += [(k, " ".join([f"y{k % 3}", *base[1:-4], f"z{k}", *base[-3:]])) for k in range(20, 40)] + [(21, "")]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = components([r for r in rows if (r[1] or "").split()])
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.n_shingles} == {(k, n, c) for k, (n, c) in want.items()}
    assert len(got) == len(rows) and sum(r.n_shingles == 0 for r in got) == 12


def test_a_worker_keeps_no_more_ids_than_it_may(vocabulary):
    """Many different words: the store of words is bounded by its bytes, and words beyond it get the same ids."""
    model = pieces.load(queries.PIECES)
    words = [f"w{k}q{k * 7919 % 1_000_003}" for k in range(150_000)]
    found = [model.encode(w) for w in words]
    held = len(model.words), len(model.stretches)
    again = [model.encode(w) for w in words[::1_000]]
    model.words.clear()
    model.stretches.clear()
    assert again == found[::1_000] == [model.encode(w) for w in words[::1_000]]
    assert sum(held) <= 100_000  # of about 200 bytes each
