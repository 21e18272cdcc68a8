"""Legacy ARC archives, their conversion to WARC, and reading both.

An ARC file begins with a version block that names the fields of its header lines: five in version 1, ten in
version 2, the last one the length of what follows. There are no record ids, no digests and no types; conversion
makes them: an id from the place in the archive, a W3C timestamp from up to 14 digits, SHA-1 digests of block and
payload, and ``revisit`` records for payloads that another record holds already.

Archives are files that Spark's own text sink writes, one record per row, and that its binary source reads: any
store that Spark reaches will do, and a lost task writes its files anew. A file can only be read from its start,
as lengths are the one way from record to record; so a file is the work of one task, and writers start a new one
after about ``SEGMENT`` bytes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taskspark.session import scratch_path, store_and_reload

SEGMENT = 32 << 20
GATHER = 1 << 20
LONGEST_LINE = 1 << 20
#: The fields of header lines by ARC version, as their version blocks name them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NO_URL = "about:blank"
RECORDS = {
    "archive": "string", "place": "long", "version": "int", "url": "string", "ip": "string", "date": "string",
    "mime": "string", "status": "string", "http": "map<string,string>", "head": "binary", "payload": "binary",
    "payload_bytes": "long", "record_id": "string", "payload_digest": "string", "block_digest": "string",
    "head_digest": "string", "same": "binary", "problem": "string",
}
WARC_RECORDS = {
    "archive": "string", "place": "long", "record_id": "string", "type": "string", "date": "string", "url": "string",
    "refers_to": "string", "fields": "map<string,string>", "http": "map<string,string>", "payload": "binary",
    "payload_bytes": "long", "payload_digest": "string", "digests_hold": "boolean", "problem": "string",
}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its blank line) and payload of an HTTP response; anything else is payload as a whole."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(at + len(mark), at) for mark in (b"\r\n\r\n", b"\n\n") if (at := block.find(mark)) >= 0]
    end = min(ends, key=lambda x: x[1])[0] if ends else len(block)
    return block[:end], block[end:]


def fields_of(head: bytes) -> list[tuple[str, str]]:
    """Names (in small letters) and values of header lines; folded lines are joined, the first of a name counts."""
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").splitlines()[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        last = name.strip().lower() if colon else None
        if last:
            last = last if last not in out else None
            if last:
                out[last] = value.strip()
    return list(out.items())


def warc_date(date: str, otherwise: str = "19700101000000") -> str:
    """``YYYY-MM-DDThh:mm:ssZ`` of up to 14 digits; missing parts are the first of their kind."""
    from datetime import datetime

    for text in (date, otherwise):
        digits = (text or "").strip()
        if digits.isascii() and digits.isdigit() and 4 <= len(digits) <= 14 and len(digits) % 2 == 0:
            full = digits + "00000101000000"[len(digits) :]
            try:
                return datetime.strptime(full, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
            except ValueError:
                pass
    return "1970-01-01T00:00:00Z"


class Problem(Exception):
    """What makes the rest of an archive unreadable."""


def _stream(content: bytes):
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _line(stream) -> bytes:
    line = stream.readline(LONGEST_LINE)
    if len(line) == LONGEST_LINE:
        raise Problem("header line without an end")
    return line


def _exactly(stream, text: bytes) -> bytes:
    if not text.strip().isdigit():
        raise Problem(f"no length: {text[:40]!r}")
    data = stream.read(int(text))
    if len(data) < int(text):
        raise Problem(f"{int(text)} bytes declared, {len(data)} there")
    return data


def arc_records(stream, archive: str) -> Iterator[dict]:
    """The records of one archive, as named by its version block, without that block itself."""
    names, version, own_date = None, 0, ""
    while True:
        place, line = stream.tell(), _line(stream)
        if not line:
            return
        if not line.strip():
            continue
        header = line.rstrip(b"\r\n")
        if header.startswith(b"filedesc:"):
            parts = header.split(b" ")
            block = _exactly(stream, parts[-1]).split(b"\n")
            number = block[0].split(b" ")[0]
            if number not in (b"1", b"2") or len(parts) < 5:
                raise Problem(f"unknown version block: {block[0][:40]!r}")
            version, own_date = int(number), parts[2].decode("latin-1")
            named = block[1].strip().decode("latin-1") if len(block) > 1 else ""
            names = (named or ARC_FIELDS[version]).lower().split(" ")
            continue
        if names is None:
            raise Problem("no version block")
        parts = header.rsplit(b" ", len(names) - 1)  # a URL may hold blanks
        if len(parts) < len(names):
            raise Problem(f"{len(parts)} of {len(names)} fields: {header[:80]!r}")
        found = {n: p.decode("utf-8", "replace") for n, p in zip(names, parts, strict=True)}
        block = _exactly(stream, parts[-1])
        date = found.get("archive-date", "")
        yield {
            "archive": archive, "place": place, "version": version, "url": found["url"], "ip": found.get("ip-address"),
            "date": warc_date(date, own_date), "mime": found.get("content-type"), "status": found.get("result-code"),
            "block": block, "raw_date": date,
        }


def _told(record: dict, wanted: Sequence[str]) -> dict:
    """The record with what WARC needs and ARC lacks; hashes only where they are wanted."""
    block = record.pop("block")
    head, payload = split_http(block)
    name = f"{record['archive']}#{record['place']} {record['url']} {record.pop('raw_date')}"
    record |= {"head": head, "payload": payload, "payload_bytes": len(payload), "http": fields_of(head)}
    record["record_id"] = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
    for key, data in (("payload_digest", payload), ("block_digest", block), ("head_digest", head)):
        if key in wanted:
            record[key] = base32_sha1(data)
    if "same" in wanted:
        record["same"] = hashlib.sha256(payload).digest()
    return record


def warc_records(stream, archive: str, wanted: Sequence[str]) -> Iterator[dict]:
    while True:
        place, line = stream.tell(), _line(stream)
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise Problem(f"no record here: {line[:40]!r}")
        head = [line]
        while (line := _line(stream)).strip():
            head.append(line)
        fields = dict(fields_of(b"".join(head)))
        block = _exactly(stream, fields.get("content-length", "").encode())
        web = fields.get("content-type", "").startswith("application/http")
        http, payload = split_http(block) if web else (b"", block)
        whole = fields.get("warc-type") != "revisit"
        told = dict(fields_of(http))
        size = told.get("content-length", "")
        declared = {k: fields.get(f"warc-{k}-digest", "").removeprefix("sha1:") or None for k in ("block", "payload")}
        holds = None
        if "digests_hold" in wanted:
            holds = declared["block"] in (None, base32_sha1(block))
            holds = holds and (not whole or declared["payload"] in (None, base32_sha1(payload)))
        yield {
            "archive": archive, "place": place, "record_id": fields.get("warc-record-id"), "type": fields.get("warc-type"),
            "date": fields.get("warc-date"), "url": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
            "fields": list(fields.items()), "http": list(told.items()), "payload": payload if whole else None,
            "payload_bytes": len(payload) if whole else int(size) if size.isdigit() else None,
            "payload_digest": declared["payload"], "digests_hold": holds,
        }


def _read(spark: SparkSession, paths: str | Sequence[str], records, kinds: dict[str, str]) -> DataFrame:
    schema = ", ".join(f"{k} {v}" for k, v in kinds.items())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
        shape = pa.schema([(k, arrow.get(v, pa.map_(pa.string(), pa.string()))) for k, v in kinds.items()])
        held, size = [], 0
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                archive = path.rpartition("/")[2]
                stream = _stream(content.as_buffer().to_pybytes())
                rows = records(stream, archive)
                while True:
                    try:
                        row = next(rows, None)
                    except (Problem, EOFError, OSError, zlib.error) as wrong:
                        row = {"archive": archive, "place": None, "problem": str(wrong) or type(wrong).__name__}
                    if row is None:
                        break
                    held.append({k: row.get(k) for k in kinds})
                    size += len(row.get("payload") or b"") + 1_000
                    if size > GATHER:
                        yield pa.RecordBatch.from_pylist(held, shape)
                        held, size = [], 0
                    if row.get("problem"):
                        break
        yield pa.RecordBatch.from_pylist(held, shape)

    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.where("length > 0").select("path", "content").mapInArrow(parse, schema)


def read_arc(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = tuple(RECORDS)) -> DataFrame:
    """The records of ARC files, plain or gzip, with ``columns`` of ``RECORDS``.

    place is the record's first byte in the unpacked archive; head and payload are the HTTP head and body, or nothing
    and the whole block where the block is no HTTP response; same tells equal payloads. Where a file breaks off or a
    header line cannot be read, one row names the ``problem`` and the rest of that file is not read, as only
    declared lengths lead on. Empty files have no records.
    """
    kinds = {k: RECORDS[k] for k in dict.fromkeys([*columns, "problem"])}
    return _read(spark, paths, lambda s, a: (_told(r, kinds) for r in arc_records(s, a)), kinds)


def read_warc(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = tuple(WARC_RECORDS)) -> DataFrame:
    """The records of WARC files, plain or gzip, with ``columns`` of ``WARC_RECORDS``; problems as in ``read_arc``.

    Of a revisit, payload is null and payload_bytes what its HTTP head declares. digests_hold tells whether the
    declared digests are those of the bytes.
    """
    kinds = {k: WARC_RECORDS[k] for k in dict.fromkeys([*columns, "problem"])}
    return _read(spark, paths, lambda s, a: warc_records(s, a, kinds), kinds)


def _starts_file(each: int) -> Column:
    """Whether a row is the first of a file, if a file takes ``each`` rows of a task."""
    return F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) % each == 0


def _write(rows: DataFrame, path: str, each: int, gap: str) -> None:
    """Every binary ``record`` and ``gap`` behind it, ``each`` to a file."""
    out = rows.select(F.col("record").cast("string").alias("value"))
    out.write.option("maxRecordsPerFile", each).option("compression", "gzip").option("lineSep", gap).text(path)


def _bytes(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p).cast("binary") if isinstance(p, str) else p.cast("binary") for p in parts])


def rows_per_file(rows: DataFrame, size: Column, segment: int = SEGMENT) -> int:
    """How many rows make about ``segment`` bytes."""
    total = rows.agg(F.count("*").alias("n"), F.sum(size.cast("double")).alias("bytes")).first()
    return max(1, int(segment * total["n"] / total["bytes"])) if total["bytes"] else 10_000


def write_arc(rows: DataFrame, path: str, version: int = 1, segment: int = SEGMENT) -> None:
    """ARC files of ``rows`` (url, ip, date, mime, block; status too in version 2).

    Blanks and line breaks in a url are percent-encoded; a null or empty url is ``about:blank``, a null block is
    empty, a null ip ``0.0.0.0``, a null date ``19700101000000``, a null mime or status ``-``. Files end after about
    ``segment`` bytes of blocks by the average record; a single record is never split.
    """
    url = F.coalesce(F.nullif(F.col("url"), F.lit("")), F.lit(NO_URL))
    for sign, code in ((" ", "%20"), ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        url = F.replace(url, F.lit(sign), F.lit(code))
    block = F.coalesce(F.col("block"), F.lit(b""))

    def given(name: str, otherwise: str) -> Column:
        text = F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("")), r"\s+", "")
        return F.coalesce(F.nullif(text, F.lit("")), F.lit(otherwise))

    parts = [url, given("ip", "0.0.0.0"), given("date", "19700101000000"), given("mime", "-")]
    if version == 2:
        parts += [given("status", "-"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("-")]
    line = F.concat_ws(" ", *parts, F.octet_length(block).cast("string"))
    about = f"{version} 0 taskspark\n{ARC_FIELDS[version]}\n"
    extra = "" if version == 1 else "200 - - 0 - "
    first = f"filedesc://pages.arc 0.0.0.0 19700101000000 text/plain {extra}{len(about)}\n{about}\n"
    each = rows_per_file(rows, F.octet_length(block), segment)
    lead = F.when(_starts_file(each), F.lit(first)).otherwise(F.lit(""))
    _write(rows.select(_bytes(lead, line, "\n", block).alias("record")), path, each, "\n")


def convert(spark: SparkSession, arcs: str | Sequence[str], path: str, newest: Column | None = None, segment: int = SEGMENT) -> None:
    """Write the records of ARC files as WARC files.

    Of records with equal payloads the one with the greatest ``newest`` (a column over ``read_arc``; its date unless
    given; null is least) is whole, a ``response`` (``resource`` if its block is no HTTP response). The others are
    ``revisit`` records that keep the HTTP head and refer to it. Ties go to the greatest record id, so exactly one
    is whole. Unreadable rests of archives are left out; ``read_arc`` tells them.

    Payloads are read twice and not moved, unless more of them are repeated than Spark would broadcast.
    """
    newest = F.col("date") if newest is None else newest
    known = read_arc(spark, arcs, ("same", "record_id", "url", "date", "http", "payload_bytes")).where("problem IS NULL")
    known = store_and_reload(
        known.select("same", "payload_bytes", F.struct(newest.alias("rank"), "record_id", "url", "date").alias("own")), "arc"
    )
    several = known.groupBy("same").agg(F.max("own").alias("whole"), F.count("*").alias("n")).where("n > 1")
    several = store_and_reload(several.select("same", "whole.record_id", "whole.url", "whole.date"), "repeated")
    several = several.toDF("same", "whole_id", "whole_url", "whole_date")

    wanted = ("url", "ip", "date", "mime", "head", "payload", "record_id", "payload_digest", "block_digest", "head_digest", "same")
    rows = read_arc(spark, arcs, wanted).where("problem IS NULL").join(several, "same", "left")
    again = F.col("whole_id").isNotNull() & (F.col("whole_id") != F.col("record_id"))
    web = F.octet_length("head") > 0
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    kind = F.when(again, F.lit("revisit")).when(web, F.lit("response")).otherwise(F.lit("resource"))
    end = "\r\n"
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), "date"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-IP-Address: "), "ip"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), F.when(again, F.col("head_digest")).otherwise(F.col("block_digest"))),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), "whole_id")),
        F.when(again, F.concat(F.lit("WARC-Refers-To-Target-URI: "), "whole_url")),
        F.when(again, F.concat(F.lit("WARC-Refers-To-Date: "), "whole_date")),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("Content-Type: "), F.when(web, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    about = "software: taskspark\r\nformat: WARC File Format 1.0\r\n"
    mark = F.md5(F.concat(F.lit("warcinfo "), "record_id"))
    urn = F.concat_ws("-", *[F.substring(mark, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    info = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"), urn, F.lit(">\r\nWARC-Date: "), "date",
        F.lit(f"\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"),
    )
    each = rows_per_file(known, F.col("payload_bytes"), segment)
    lead = F.when(_starts_file(each), info).otherwise(F.lit(""))
    _write(rows.select(_bytes(lead, F.concat_ws(end, *lines), end * 2, block).alias("record")), path, each, end * 2)


def archive_pages(pages: DataFrame, date: str = "20000101000000") -> str:
    """ARC files of ``pages`` (page_id, url, html): the folder they are in, one half in either version.

    The payload is the html in UTF-8 (null: empty) behind an HTTP head that holds the page_id, if there is one.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit("HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string")), F.lit("")),
        F.lit("\r\n\r\n"),
    )
    path = scratch_path(spark, "arc")
    odd = F.coalesce(F.col("page_id") % 2 != 0, F.lit(True))
    for version, half in ((1, ~odd), (2, odd)):
        rows = pages.where(half).select(
            "url", F.lit("0.0.0.0").alias("ip"), F.lit(date).alias("date"), F.lit("text/html").alias("mime"),
            F.lit("200").alias("status"), _bytes(head, body).alias("block"),
        )
        write_arc(rows, f"{path}/{version}", version)
    return path


def converted_pages(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row of ``pages`` (page_id, url,
    html, any other columns), read back from WARC files that were converted from ARC files of the pages.

    Of pages with equal html the one with the largest page_id is the response and the others revisit it; refers_to
    is its page_id. Null html is empty. A null page_id comes last and stays null; of rows that repeat the largest
    page_id one is the response. An empty table gives no rows.
    """
    spark = pages.sparkSession
    arcs, path = archive_pages(pages.select("page_id", "url", "html")), scratch_path(spark, "warc")
    number = F.col("http")["x-page-id"].cast("long")
    convert(spark, [f"{arcs}/1", f"{arcs}/2"], path, newest=number)
    found = read_warc(spark, path, ("record_id", "type", "refers_to", "http", "payload_bytes", "payload_digest"))
    found = found.where("problem IS NULL AND type != 'warcinfo'")
    found = store_and_reload(found.withColumn("page_id", number).drop("http", "problem"), "pages")
    whole = found.where("type != 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"))
    return found.join(whole, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("target").alias("refers_to")
    )
