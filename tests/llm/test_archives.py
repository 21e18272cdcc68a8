"""ARC archives, their conversion to WARC and reading back, against hand-made files."""

import base64
import gzip
import hashlib
import re

import pytest

from taskspark.llm import warc
from taskspark.session import scratch_path


def arc(version, *records):
    about = f"{version} 0 someone\n{warc.ARC_FIELDS[version]}\n".encode()
    extra = b"" if version == 1 else b"200 - - 0 old.arc "
    out = b"filedesc://old.arc 1.2.3.4 19970203040506 text/plain " + extra + b"%d\n" % len(about) + about + b"\n"
    for url, date, block in records:
        middle = b"" if version == 1 else b"404 abc - 17 old.arc "
        out += url + b" 9.8.7.6 " + date + b" text/html " + middle + b"%d\n" % len(block) + block + b"\n"
    return out


HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: one\r\n two\r\nX-A: three\r\n\r\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "one.arc").write_bytes(
        arc(
            1,
            (b"http://a/x y", b"19980101", HEAD + b"\xff\x00 same \n\nhttp://z 1.1.1.1 19970101000000 text/plain 3\nabc\n"),
            (b"http://b/", b"not-a-date", HEAD + b"other"),
            (b"dns:c", b"19990203040506", b"c has address 1.2.3.4"),
            (b"http://d/", b"199902", b""),
        )
    )
    members = arc(2, (b"http://e/", b"20010101000000", b"HTTP/1.0 200 OK\n\nother"), (b"http://f/", b"20010101", b""))
    (tmp_path / "two.arc.gz").write_bytes(gzip.compress(members[:200]) + gzip.compress(members[200:]))
    (tmp_path / "empty.arc").write_bytes(b"")
    return tmp_path


def test_versions_lengths_and_dates(spark, folder):
    rows = {r["url"]: r for r in warc.read_arc(spark, str(folder)).collect()}
    assert set(rows) == {"http://a/x y", "http://b/", "dns:c", "http://d/", "http://e/", "http://f/"}
    assert [rows[u]["version"] for u in ("http://a/x y", "http://e/")] == [1, 2]
    assert rows["http://a/x y"]["payload"].startswith(b"\xff\x00 same ") and rows["http://a/x y"]["payload"].endswith(b"abc\n")
    assert rows["http://a/x y"]["http"] == {"content-type": "text/html", "x-a": "one two"}
    assert rows["http://a/x y"]["date"] == "1998-01-01T00:00:00Z"
    assert rows["http://b/"]["date"] == "1997-02-03T04:05:06Z"  # the archive's own
    assert rows["http://d/"]["date"] == "1999-02-01T00:00:00Z"
    assert rows["http://e/"]["status"] == "404" and rows["http://b/"]["status"] is None
    assert rows["dns:c"]["payload"] == b"c has address 1.2.3.4" and rows["dns:c"]["head"] == b""
    assert rows["http://b/"]["payload_digest"] == base64.b32encode(hashlib.sha1(b"other").digest()).decode()
    assert len({r["record_id"] for r in rows.values()}) == 6
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r["record_id"]) for r in rows.values())


@pytest.mark.parametrize("segment", [1, 1 << 20])
def test_converted_archives(spark, folder, segment):
    path = scratch_path(spark, "warc")
    warc.convert(spark, str(folder), path, segment=segment)
    rows = warc.read_warc(spark, path).collect()
    assert all(r["problem"] is None and r["digests_hold"] for r in rows)
    infos, rows = [r for r in rows if r["type"] == "warcinfo"], {r["url"]: r for r in rows if r["type"] != "warcinfo"}
    assert len(infos) == len({r["archive"] for r in [*infos, *rows.values()]})  # one at the start of each file
    assert {r["place"] for r in infos} == {0} and len({r["record_id"] for r in infos}) == len(infos)
    assert {u: r["type"] for u, r in rows.items()} == {
        "http://a/x y": "response", "dns:c": "resource", "http://b/": "revisit", "http://e/": "response",
        "http://d/": "revisit", "http://f/": "resource",
    }
    old = rows["http://b/"]
    assert old["refers_to"] == rows["http://e/"]["record_id"] and old["payload"] is None
    assert old["payload_digest"] == rows["http://e/"]["payload_digest"]
    assert old["fields"]["warc-refers-to-target-uri"] == "http://e/" and old["http"]["x-a"] == "one two"
    assert old["fields"]["warc-profile"] == warc.REVISIT_PROFILE
    originals = {r["url"]: r for r in warc.read_arc(spark, str(folder)).collect()}
    for url in ("http://a/x y", "dns:c", "http://e/"):
        assert rows[url]["payload"] == originals[url]["payload"] and rows[url]["date"] == originals[url]["date"]


@pytest.mark.parametrize(
    ("content", "problem", "whole"),
    [
        (arc(1, (b"http://a/", b"1999", b"abc"))[:-2], "3 bytes declared, 2 there", 0),
        (arc(1, (b"http://a/", b"1999", b"abc")) + b"http://b/ 1999\n", "2 of 5 fields", 1),
        (arc(2, (b"http://a/", b"1999", b"abc")) + b"http://b/ 1.1.1.1 1999 text/html 3\nabc\n", "5 of 10 fields", 1),
        (b"http://a/ 1.1.1.1 1999 text/html 3\nabc\n", "no version block", 0),
        (arc(1).replace(b"1 0 someone", b"7 0 someone"), "unknown version block", 0),
        (gzip.compress(arc(1, (b"http://a/", b"1999", b"abc")))[:-12], "", 0),
    ],
)
def test_broken_archives(spark, tmp_path, content, problem, whole):
    (tmp_path / "x.arc").write_bytes(content)
    rows = warc.read_arc(spark, str(tmp_path)).collect()
    assert len(rows) == whole + 1 and problem in rows[-1]["problem"]
    path = scratch_path(spark, "warc")
    warc.convert(spark, str(tmp_path), path)
    assert warc.read_warc(spark, path).where("type != 'warcinfo'").count() == whole


ODD = [
    (1, "http://a b\n", "same", 1), (2, None, "same", 1), (3, "u", "same", 1), (3, "u", "same", 1), (None, "u", "same", 1),
    (4, "u", None, 1), (5, "", "", 1), (6, "u", "é\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n", 1),
    (7, "u", "x" * 3_000_000, 1), (8, "u", "HTTP/1.0 200 OK\r\n\r\nsame", 1),
]


def test_odd_pages(spark):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string, place int")
    rows = warc.converted_pages(pages).collect()
    assert len(rows) == len(ODD)
    for page, _, html, _ in ODD:
        payload = (html or "").encode()
        same = [r for r in rows if r["page_id"] == page]
        assert len(same) == sum(x[0] == page for x in ODD)
        for r in same:
            assert r["payload_bytes"] == len(payload)
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    told = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in rows)
    assert told == sorted(
        [("1", "revisit", 3), ("2", "revisit", 3), ("3", "response", None), ("3", "revisit", 3), ("None", "revisit", 3),
         ("4", "revisit", 5), ("5", "response", None), ("6", "response", None), ("7", "response", None), ("8", "response", None)]
    )


def test_no_pages(spark):
    assert warc.converted_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
