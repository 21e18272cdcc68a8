"""Every corpus operator against brute force, a round trip or held-out accuracy, and on odd tables."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
import sentencepiece
import tiktoken
import tiktoken.load
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from taskspark.llm import decontamination, jaccard_join, language_id, licenses, pieces, quality_rules, queries, secrets
from taskspark.llm.attribution import attribute
from taskspark.llm.chat import format_conversations, read_back
from taskspark.llm.quality_rules import ablations, ledger, verdict
from taskspark.llm.templates import TemplateError, compiled

FOLDER = "/root/testdata/sf0.001"
#: The smallest tables whose labels hold enough toxic documents to learn from.
LABELLED = "/root/testdata/sf0.1"
SCHEMA = "doc_id bigint, source string, lang string, text string, count bigint, score double, n int"
LONG = " ".join(f"w{i}" for i in range(30_000))
ODD = [
    (1, "a", "en", None, 1, 0.0, 1),
    (2, None, None, "", 1, 0.0, 1),
    (3, "a", "en", " \n\t ", None, None, None),
    (4, "a", "en", "one two three four five six seven", 1, 0.0, 1),
    (5, "a", "fr", "one two three four five six seven", 1, 0.0, 1),
    (5, "a", "fr", "one two three four five six seven", 1, 0.0, 1),
    (6, "b", "en", LONG, 1, 0.0, 1),
    (7, "b", "fr", "日本語 é \U0001f600 ñandú", 1, 0.0, 1),
    (None, "b", "fr", "a row without a name", 1, 0.0, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet")


@pytest.fixture(scope="module")
def languages(docs):
    return language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"), 4, 2)))


def whole(docs):
    """Ways to apply an operator to a table, each with one row out per row in."""
    return {
        "pieces": lambda d: pieces.round_trip(d, queries.PIECES),
        "jaccard": jaccard_join.near_duplicates,
        "quality": lambda d: verdict(ledger(d), 2),
        "secrets": lambda d: secrets.digest(secrets.scan(d)),
        "redact": secrets.redact,
        "licenses": licenses.scan,
    }[docs]


@pytest.mark.parametrize("name", ["pieces", "jaccard", "quality", "secrets", "redact", "licenses"])
def test_odd_rows_stay_whole_and_empty_tables_are_empty(odd, name):
    ids = sorted((r[0] for r in ODD), key=str)
    assert sorted((r.doc_id for r in whole(name)(odd).collect()), key=str) == ids
    assert whole(name)(odd.limit(0)).collect() == []


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(rows):
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {k: (len(sets[k]), top(k)) for k in sets}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows, bases = [], [[f"t{rng.randrange(60)}" for _ in range(rng.choice([3, 5, 9, 40, 80]))] for _ in range(12)]
    for k in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(30)}"
        rows.append((k, " ".join(words)))
    rows += [(200, None), (201, ""), (202, "  ")]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows)
    assert len(got) == len(rows)


def test_keep_one_leaves_one_row_of_each_group(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "quite another text is here"), (4, None), (5, "")]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4, 5]


def test_pieces_come_back(docs):
    known = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    got = pieces.decode(pieces.encode(docs.limit(60), queries.PIECES), queries.PIECES).collect()
    assert got
    for r in got:
        assert r.decoded == known.decode(list(r.ids)) if r.text else True
        best = known.encode(r.text or "")
        assert known.decode(best) == known.decode(list(r.ids))


def test_tokens_are_those_of_the_whole_document(spark, docs):
    ranks = tiktoken.load.load_tiktoken_bpe(queries.BYTEPAIRS)
    known = tiktoken.Encoding("x", pat_str=queries.BYTEPAIR_PATTERN, mergeable_ranks=ranks, special_tokens={})
    few = docs.limit(40)
    for rule in ("first", "last", "largest"):
        rows = attribute(few, queries.BYTEPAIRS, queries.BYTEPAIR_PATTERN, rule=rule).collect()
        sums = {}
        for r in rows:
            sums.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.n_tokens
        assert all(a == b for a, b in sums.values())
        for d in few.collect():
            text = "\n".join(x or "" for x in (d.source, d.lang, d.text))
            assert sums[d.doc_id][1] == len(known.encode_ordinary(text))


def test_ablation_counts_equal_verdicts_without_a_rule(docs, monkeypatch):
    entries = ledger(docs).cache()
    got = {r.rule: r for r in ablations(entries, 2).collect()}
    rules = quality_rules.POLICIES[2]
    assert set(got) == set(rules)
    for rule in rules:
        monkeypatch.setitem(quality_rules.POLICIES, 99, tuple(x for x in rules if x != rule))
        bit = quality_rules.mask((rule,))
        want = (
            entries.where(F.col("failed").bitwiseAND(F.lit(bit)) != 0).count(), entries.where(f"failed = {bit}").count(),
            verdict(entries, 2).where("kept").count(), verdict(entries, 99).where("kept").count(),
        )
        assert tuple(got[rule])[1:] == want
    assert ablations(entries.limit(0), 2).collect() == []


BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)


def base_secrets(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def test_base_secrets_equal_the_plain_patterns(spark, docs):
    extra = spark.createDataFrame(
        [
            (-1, "é Password = 'abcdEFGH1234' tokentoken:aaaaaaaaaaaa api_key=short"),
            (-2, "AKIA" + "A" * 14 + " AKIAAKIA" + "0" * 9 + " deadbeefdeadbeef0 passwd:secret=abcdefabcdef"),
            (-3, None),
        ],
        "doc_id bigint, text string",
    )
    rows = docs.select("doc_id", "text").union(extra)
    got = {r.doc_id: r for r in secrets.digest(secrets.scan(rows)).collect()}
    for r in rows.collect():
        base = base_secrets(r.text)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) - {""} <= set(got[r.doc_id].spans.split(","))


def test_redacted_texts_hold_no_secret(docs):
    left = secrets.digest(secrets.scan(secrets.redact(docs))).agg(F.sum("n_assign"), F.sum("n_access"), F.sum("n_hex"))
    assert tuple(left.first()) == (0, 0, 0)


def test_base_licenses_equal_the_plain_phrases(spark, docs):
    extra = spark.createDataFrame(
        [(-1, "Under the MIT-License; apache license, version 2.0 cc-by-nc"), (-2, None), (-3, "undér the mit license")],
        "doc_id bigint, text string",
    )
    rows = docs.select("doc_id", "text").union(extra)
    got = {r.doc_id: r for r in licenses.scan(rows).collect()}
    for r in rows.collect():
        lower = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [
            (i, i + len(p.split()) - 1, label)
            for p, label in licenses.PHRASES
            for i in range(len(words))
            if words[i : i + len(p.split())] == p.split()
        ]
        g = got[r.doc_id]
        assert (g.n_words, g.n_base) == (len(words), len(places))
        assert g.first_word == (min(p[0] for p in places) if places else None)
        labels = sorted({p[2] for p in places})
        assert g.base_labels == ",".join(labels)
        assert set(labels) <= set(g.labels.split(",")) | {""}
        assert 0 <= g.score <= 1


def test_languages_of_held_out_documents(docs, odd, languages):
    told = language_id.predict(docs.where(language_id.held_out(F.col("doc_id"), 4, 2)), languages)
    right = told.where("lang is not null").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right >= 0.9
    bare = {r.doc_id: r.lang_pred for r in language_id.predict(odd.drop("score"), languages).collect()}
    assert bare[1] == bare[2] == bare[3] == "und" and bare[4] != "und"


def test_held_out_is_the_checksum(docs):
    for r in docs.select("doc_id", language_id.held_out(F.col("doc_id"), 3, 1).alias("away")).limit(50).collect():
        assert r.away == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_toxic_held_out_documents_score_higher(spark):
    scored = queries.op2_toxicity(spark, LABELLED).where("held_out")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("toxic is not null").select("score", F.col("toxic").cast("int")).collect()
    good, bad = [r.score for r in rows if not r.toxic], [r.score for r in rows if r.toxic]
    assert all(0 <= r.score <= 1 for r in rows)
    above = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(good) * len(bad))
    print("held out", len(good), len(bad), above)
    assert above >= 0.8


def test_planted_benchmark_copies_are_found_and_clean_texts_stay(spark, benchmark):
    names = benchmark.columns
    item = benchmark.where(F.size(F.split("text", " ")) >= 15).first() if "text" in names else None
    if item is None:
        item = benchmark.first()
    text = item["text"] if "text" in names else next(v for v in item if isinstance(v, str) and len(v) > 60)
    words = text.split()
    edited = [*words[:3], "edited", *words[4:]]
    filler = " ".join(f"plain{i} word{i * 7}" for i in range(80))
    rows = [(1, f"{filler} {text} {filler}"), (2, f"{filler} {' '.join(edited)}"), (3, filler), (4, None), (5, "")]
    few = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in decontamination.leaks(few, benchmark).collect()} == {1, 2}
    assert sorted(r.doc_id for r in decontamination.without_leaks(few, benchmark).collect()) == [3, 4, 5]
    assert decontamination.leaks(few.limit(0), benchmark).collect() == []
    assert decontamination.leaks(few, benchmark.limit(0)).collect() == []


def test_chat_reads_back_texts_with_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", None, "", "[ROLE]x[/ROLE]\n", "é\U0001f600"]
    rows = [(c, t, "assistant" if t % 2 else "user", texts[(c + t) % len(texts)]) for c in range(9) for t in range(1 + c % 5)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    got = {r.conv_id: r for r in read_back(format_conversations(turns)).collect()}
    for c in range(9):
        mine = [r for r in rows if r[0] == c]
        every = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert got[c].n_turns == len(mine)
        assert got[c].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert read_back(format_conversations(turns.limit(0))).collect() == []


def test_templates_refuse_what_is_not_in_the_language():
    assert "".join(text for text, _ in compiled("{{ x.__class__ }}{{ x['__init__'] }}")({"x": 1})) == ""
    with pytest.raises(TemplateError):
        compiled("{% for a in b %}")


def test_pipeline_stages_follow_their_operators(spark, docs, benchmark, languages):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    told = {r.doc_id: r.text for r in language_id.predict(docs, languages).where("lang_pred <> 'und'").collect()}
    groups = components(list(told.items()))
    one = {k: told[k] for k, (_, least) in groups.items() if k == least}
    left = spark.createDataFrame(list(one.items()), "doc_id bigint, text string")
    found = {r.doc_id for r in decontamination.leaks(left, benchmark).collect()}
    assert set(got) == set(one) - found
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    masked = {r.doc_id: r.text for r in secrets.redact(left).collect()}
    for k in list(got)[:30]:
        assert got[k].text == masked[k] and model.decode(list(got[k].ids)) == model.decode(model.encode(masked[k]))


def test_queries_are_registered():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names and set(queries.ORACLE) <= set(entry.oracle_sql())


def test_pages_of_one_template_never_meet(spark, monkeypatch):
    """3,000 pages that share 10 of 12 words and link with nothing: no square of their number."""
    rows = []
    for k in range(3_000):
        words = [f"t{i}" for i in range(14)]
        words[0], words[13] = f"a{k}", f"b{k}"
        rows.append((k, " ".join(words)))
    pages = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    asked = []
    real = jaccard_join.asked_groups
    monkeypatch.setattr(jaccard_join, "asked_groups", lambda *r: asked.append(real(*r)) or asked[-1])
    found = jaccard_join.near_duplicates(pages)
    assert found.where("doc_id != component_id").count() == 0
    assert asked[0].count() < 100_000


@pytest.mark.parametrize(("seed", "percent"), [(1, 80), (2, 80), (3, 90), (4, 50), (5, 67)])
def test_random_near_copies_equal_all_pairs(spark, seed, percent):
    """Sets of very different and of nearly equal sizes around the threshold."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randint(0, 60)}" for _ in range(rng.choice([5, 6, 8, 12, 25, 60]))] for _ in range(12)]
    rows = []
    for k in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [f"x{rng.randint(0, 5)}"], [f"x{k}", "y"]])
            words = words or ["z"]
        rows.append((k, " ".join(words)))
    sets = {}
    for k, text in rows:
        w = text.split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3), percent).collect()}
    assert got == {k: top(k) for k in range(len(rows))}


def test_half_signs_are_no_letters(spark, languages):
    rows = spark.createDataFrame([(1, "½ ²"), (2, "3½ ①"), (3, "½ the ②"), (4, "_ 12")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(rows, languages).collect()}
    assert got[1] == got[2] == got[4] == ("und", 0.0) and got[3][0] != "und"
    assert set(language_id.grams("a½b").tolist()) == set(language_id.grams("a b").tolist())


def test_join_compares_no_pair_that_its_sizes_rule_out(spark):
    columns = spark.createDataFrame(
        [(r, t, n, n, True) for t, r, n in ((7, 1, 10), (7, 2, 100), (7, 3, 11), (8, 2, 100), (8, 4, 90))],
        "r long, token long, n long, rest long, short boolean",
    )
    found = {(row["a"], row["b"]) for row in jaccard_join.central_links(columns).collect()}
    assert (3, 1) in found and (4, 2) in found  # 11 and 10, 90 and 100
    assert not {(2, 1), (3, 2)} & found


def test_join_columns_are_the_same_whatever_the_ranks(spark):
    texts = [" ".join(f"w{(i * 7 + j * (1 + i % 3)) % 40}" for j in range(30)) for i in range(40)]
    rows = [(i, text) for i, text in enumerate(texts)] + [(90, texts[0]), (None, texts[1]), (91, None), (3, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for rank in (0, 1):  # every shingle is moved by the window, or by fold and join
        ranks = np.full(1 << jaccard_join.SLOT_BITS, rank, np.uint8)
        sets = jaccard_join.shingle_table(docs, ranks)
        heads = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
        named = sets.select("doc_id", "n", "digest").join(heads, "digest", "left")
        found.append(sorted(map(tuple, jaccard_join.matrix_columns(sets, named).collect())))
        seen = {}
        for row in sets.where("doc_id IS NOT NULL").collect():
            for at, token in enumerate(row["prefix"]):
                seen.setdefault(token, []).append((row["mark"], at < row["short"]))
        shared = {t for t, x in seen.items() if len({m for m, _ in x}) > 1 and any(s for _, s in x)}
        assert shared and {x[1] for x in found[-1]} == shared
    assert found[0] == found[1]


def test_texts_that_share_one_passage_by_chance_ask_no_group(spark, monkeypatch):
    """300 texts with their own words and one common passage each, at the least rank: no pair moves a bitmap."""
    rng = random.Random(7)
    passages = [" ".join(f"p{k}x{i}" for i in range(5)) for k in range(100)]
    rows = []
    for k in range(300):
        words = [f"d{k}x{i}" for i in range(40)]
        rows.append((k, " ".join([*words[:20], passages[k % 100], *words[20:]])))
    rows += [(1_000 + k, rows[k][1] + " more") for k in range(0, 300, 50)]  # one word behind: near copies
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked, central = [], []
    for name, seen in (("asked_groups", asked), ("central_links", central)):
        real = getattr(jaccard_join, name)
        monkeypatch.setattr(jaccard_join, name, lambda *r, real=real, seen=seen: seen.append(real(*r)) or seen[-1])
    monkeypatch.setattr(jaccard_join, "frequency_ranks", lambda *_: np.zeros(1 << jaccard_join.SLOT_BITS, np.uint8))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == {k: k - 1_000 if k >= 1_000 else k for k, _ in rows}
    assert asked[0].count() == 0


def test_links_of_long_and_short_prefixes_are_found(spark):
    """Sets whose prefix is EXTRA longer beside such whose is not, as their shingles are frequent: all links by pairs."""
    rng = random.Random(3)
    rows = []
    for k in range(60):
        base = [f"w{k % 6}x{i}" for i in range(30 + k % 6)]
        for _ in range(rng.choice([0, 1, 1, 2])):
            base[rng.randrange(len(base))] = f"z{rng.randrange(9)}"
        rows.append((k, " ".join(base[: len(base) - rng.randrange(4)])))
    rows += [(3, rows[9][1]), (None, rows[1][1]), (70, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for ranks in (np.zeros(1 << jaccard_join.SLOT_BITS, np.uint8), (np.arange(1 << jaccard_join.SLOT_BITS) % 3 > 0).astype(np.uint8)):
        sets = jaccard_join.shingle_table(docs, ranks).where("n > 0")
        assert {r["alone"] for r in sets.collect()} == ({True, False} if ranks.any() else {False})
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(jaccard_join, "frequency_ranks", lambda *_, ranks=ranks: ranks)
            found.append(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or -1)
                                for r in jaccard_join.near_duplicates(docs).collect()))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jaccard_join, "EXTRA", 0)
        plain = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or -1)
                       for r in jaccard_join.near_duplicates(docs).collect())
    assert found[0] == found[1] == plain
