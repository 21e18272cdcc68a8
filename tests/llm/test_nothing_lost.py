"""No cap, gate or slow pattern stands between a text and its secrets, licenses and features."""

import random
import re._constants as c
import re._parser as parser
import time

import pytest

from taskspark.llm import licenses, secrets, toxicity

RULES = licenses.signatures()


def found(text):
    return {text[a:b] for kind, a, b in secrets.spans(text) if kind == "literal"}


def test_constants_are_followed_after_any_number_of_others():
    text = "\n".join(f"n{i} = {i}" for i in range(10_050)) + "\nlate='Zx81kQpL77aaZ'\npassword=late\n"
    assert "Zx81kQpL77aaZ" in found(text)


def test_sums_are_followed_whole_and_once():
    parts = "\n".join(f"k = k + 'aB{i:03d}'" for i in range(200))
    text = f"k = 'Zx81kQpL77'\n{parts}\nsecret_key = k\n"
    assert {"Zx81kQpL77", "aB000", "aB199"} <= found(text)
    doubled = "x = 'Zx81kQpL77aaZ'\n" + "x = x + x\n" * 300 + "token = x\n"
    assert found(doubled) == {"Zx81kQpL77aaZ"}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a = 'Zx81kQpL77aaZ'\nb = a\nc = b\napi_secret: c", {"Zx81kQpL77aaZ"}),
        ("a = 'Zx81kQpL77aaZ'\na = 'plain'\npassword = a", set()),
        ('{"auth": {"password": "Zx81-kQpL-77aaZ"}}', {"Zx81-kQpL-77aaZ"}),
        ("config['password'] = 'Zx81kQpL77aaZ'", {"Zx81kQpL77aaZ"}),
        ("--client-secret=Zx81kQpL77aaZ", {"Zx81kQpL77aaZ"}),
        ("1password := Zx81kQpL77aaZ", {"Zx81kQpL77aaZ"}),
        ("password = 'changeme'\ntoken = '${TOKEN}'\nsecret = 'xxxxxxxxxxxx'", set()),
        ("height = 'Zx81kQpL77aaZ'", set()),
        ("password == 'Zx81kQpL77aaZ'", set()),
        ("password = ''", set()),
    ],
)
def test_literals_through_constants(text, want):
    assert found(text) == want


@pytest.mark.parametrize(
    "line", ["key " + "a" * 200_000 + "!=", "key: " + "a.b-" * 50_000, "password " * 20_000 + "=", "9" * 200_000 + "key=", "a=" * 50_000 + "token"]
)
def test_long_lines_are_read_once(line):
    start = time.process_time()
    secrets.spans(line)
    assert time.process_time() - start < 2


@pytest.mark.parametrize("text", ["語" * 200_000, "a" * 200_000, "a1" * 100_000, "1" * 200_000, "a_" * 100_000])
def test_long_words_are_read_once(text):
    start = time.process_time()
    toxicity.features(text, {})
    assert time.process_time() - start < 5


def sample(items, rng):
    """A text that a parsed pattern matches, every branch and repeat by chance."""
    out = ""
    for kind, value in items:
        if kind == c.LITERAL:
            out += chr(value)
        elif kind == c.IN:
            what, of = rng.choice([v for v in value if v[0] != c.NEGATE])
            out += chr(of) if what == c.LITERAL else chr(of[0]) if what == c.RANGE else rng.choice(" \n\t")
        elif kind == c.BRANCH:
            out += sample(rng.choice(value[1]), rng)
        elif kind == c.SUBPATTERN:
            out += sample(value[3], rng)
        elif kind == c.MAX_REPEAT:
            low, high, inner = value
            out += "".join(sample(inner, rng) for _ in range(rng.randint(low, min(high, low + 1))))
        else:
            assert kind in (c.AT, c.ASSERT_NOT), kind
    return out


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"{r.label}-{r.priority}")
def test_every_match_of_a_rule_passes_its_gate(rule):
    rng = random.Random(rule.label + str(rule.priority))
    tree = parser.parse(rule.pattern.pattern)
    hits = 0
    for _ in range(60):
        text = f" {sample(tree, rng)} "
        if rule.pattern.search(text):
            hits += 1
            assert any(word in text for word in rule.keyword.split("/")), text
            assert licenses.detections(text, RULES), text
    assert hits > 10


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("spdx-license-identifier: gfdl-1.3", "gfdl"), ("spdx-license-identifier: ofl-1.1", "ofl"),
        ("spdx-license-identifier: psf-2.0", "python"), ("licensed under the gfdl", "gfdl"),
        ("released under the sil open\nfont license 1.1", "ofl"), ("released under the server\nside public license", "sspl"),
        ("all rights reserved.", "proprietary"), ("this is in the public domain", "public-domain"),
    ],
)
def test_notices_that_a_gate_once_lost(text, label):
    assert label in {rule.label for *_, rule in licenses.detections(text, RULES)}


def test_suppression_equals_comparing_with_all():
    rng = random.Random(3)
    for _ in range(200):
        spans = [(a, a + rng.randint(1, 9)) for a in (rng.randint(0, 20) for _ in range(rng.randint(0, 30)))]
        plain = []
        for a, b in spans:
            if not any(x <= a and b <= y for x, y in plain):
                plain.append((a, b))
        assert list(licenses.outermost(spans)) == plain


def test_many_notices_are_no_square():
    text = "licensed under the mit license. " * 20_000
    start = time.process_time()
    assert len(licenses.detections(text, RULES)) >= 20_000
    assert time.process_time() - start < 30
