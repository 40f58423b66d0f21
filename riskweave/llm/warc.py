"""WARC archives: written by Spark, read back sequentially, equal payloads as revisits.

An archive is a run of gzip members, one record each. The reader goes through a file once: it decompresses piece by piece,
takes each block by its stated length, and hashes what passes, so it holds no more than a piece of a record unless payloads
are asked for. The writer hands whole members to Spark's own file writer, whose commit leaves no file of a lost task.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import bounded, table
from riskweave.session import materialize, work_folder

#: Bytes read or decompressed at once.
PIECE = 1 << 18
#: A head longer than this is damage.
LONGEST_HEAD = 1 << 20
#: At most so many payloads with many copies are sent to all tasks; their number is bounded by rows over copies.
BROADCAST_PAYLOADS = 1_000_000
FEW_COPIES = 256
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLANK = b"\r\n\r\n"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"

RECORDS = ("file string, number long, record_type string, record_id string, target_uri string, payload_bytes long, "
           "payload_digest string, refers_to string, problem string")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- writing

def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    # a line end inside a value would end its field
    head = "".join(f"{name}: {re.sub(r'[\r\n]+', ' ', value)}\r\n" for name, value in fields)
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([squeeze.compress(VERSION + b"\r\n" + head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode()),
                     squeeze.compress(block), squeeze.compress(BLANK), squeeze.flush()])


def page_record(record_id: str, uri: str | None, payload: bytes, date: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit with the head of the response alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", uri))
    if refers_to:
        fields += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("Content-Type", "application/http; msgtype=response")]
    return record(fields, block)


def _members_of(id_prefix: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = b"software: riskweave\r\nformat: WARC File Format 1.1\r\n"
        first = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{id_prefix}info>"), ("WARC-Date", date),
                        ("WARC-Block-Digest", f"sha1:{base32_sha1(info)}"), ("Content-Type", "application/warc-fields")], info)
        for batch in batches:
            out = [first] if first else []
            first = b""
            for key, uri, payload, refers in zip(*batch.columns):
                key, refers = key.as_py(), refers.as_py()
                out.append(page_record(f"{id_prefix}{'' if key is None else key}", uri.as_py(), payload.as_py(), date,
                                       None if refers is None else f"{id_prefix}{refers}"))
            # Spark ends every row with a zero byte, so each row leaves the zero byte out that a member ends in: the top
            # byte of its length. A member of 16 MB or more ends in another byte and gets an empty member behind it.
            out = [(m if m[-1] == 0 else m + EMPTY_MEMBER)[:-1] for m in out]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    return run


def first_of_equal(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` (key, uri, payload) with ``refers_to``: the least key of an equal payload of ``least`` bytes or more, null for
    the row with that key and for a payload of its own.

    Payloads are equal when length and SHA-256 are. Only digests move to find the least keys. A payload with many copies would
    send them to one task of a join; such payloads are few (fewer than rows / copies), so their keys are sent to the rows instead.
    """
    marked = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    copies = materialize(
        marked.filter(F.col("size") >= least).groupBy("size", "digest").agg(F.min("key").alias("least_key"), F.count("*").alias("copies"))
        .filter("copies > 1 and least_key is not null"), "equal-payloads")
    rows_in_groups = copies.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    many = max(FEW_COPIES, rows_in_groups // BROADCAST_PAYLOADS)
    often = copies.filter(F.col("copies") > many).select("size", "digest", F.col("least_key").alias("often_key"))
    seldom = copies.filter(F.col("copies") <= many).select(F.col("size").alias("joined_size"), F.col("digest").alias("joined"),
                                                           F.col("least_key").alias("seldom_key"))
    found = marked.join(F.broadcast(often), ["size", "digest"], "left")
    # rows that are settled already are dealt out evenly
    joined = F.when(F.col("often_key").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("key", "uri").cast("string")))
    found = found.withColumn("joined", joined).withColumn("joined_size", F.col("size")).join(seldom, ["joined_size", "joined"], "left")
    least_key = F.coalesce("often_key", "seldom_key")
    return found.select("key", "uri", "payload", F.when(~F.col("key").eqNullSafe(least_key), least_key).alias("refers_to"))


def write_warc(df: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0,
               id_prefix: str = "urn:page:", date: str | None = None) -> None:
    """Write a record per row of ``df`` to archives in ``folder``, which any store that Spark writes may hold.

    The payload is the text in UTF-8 or the bytes; null counts as empty. Of equal payloads of at least ``least`` bytes the row
    with the least key is the response and the others revisit it; rows that repeat that key are responses too, rows without
    a key are never referred to, and a group of them alone has responses only. The record id is ``id_prefix`` and the key, a missing key left out.
    """
    rows = bounded(df).select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"),
                              F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    members = first_of_equal(rows, least).mapInArrow(_members_of(id_prefix, date), "member binary")
    members.select(F.col("member").cast("string")).write.option("lineSep", "\0").text(folder)


# ---- reading

class Truncated(Exception):
    """The file ends inside a member."""


class Members:
    """The gzip members of a stream, one after another, each decompressed piece by piece."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.raw, self.unzip = stream, b"", None

    def next(self) -> bool:
        """Whether another member follows; the rest of the one before is passed over."""
        while self.unzip is not None and self.piece():
            pass
        self.raw = self.raw or self.stream.read(PIECE)
        self.unzip = zlib.decompressobj(31) if self.raw else None
        return self.unzip is not None

    def piece(self) -> bytes:
        """The next bytes of the member, none at its end."""
        while self.unzip is not None:
            if not self.raw:
                self.raw = self.stream.read(PIECE)
                if not self.raw:
                    self.unzip = None
                    raise Truncated
            out = self.unzip.decompress(self.raw, PIECE)
            self.raw = self.unzip.unconsumed_tail
            if self.unzip.eof:
                self.raw, self.unzip = self.unzip.unused_data, None
            if out:
                return out
        return b""

    def skip_damage(self) -> None:
        """Go on at the next gzip head that hasn't been passed."""
        self.unzip, unread = None, self.raw[1:]
        while True:
            at = unread.find(b"\x1f\x8b\x08")
            if at >= 0:
                self.raw = unread[at:]
                return
            more = self.stream.read(PIECE)
            if not more:
                self.raw = b""
                return
            unread = unread[-2:] + more


class Reader:
    """Content of one member, framed by counts: a head up to its blank line, then so many bytes."""

    def __init__(self, members: Members):
        self.members, self.ahead = members, b""

    def head(self) -> bytes | None:
        """What comes before the blank line, or None if none comes."""
        while (at := self.ahead.find(BLANK)) < 0:
            more = self.members.piece() if len(self.ahead) < LONGEST_HEAD else b""
            if not more:
                return None
            self.ahead += more
        found, self.ahead = self.ahead[:at], self.ahead[at + 4:]
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        while n > 0:
            part = self.ahead or self.members.piece()
            if not part:
                raise Truncated
            part, self.ahead = part[:n], part[n:]
            n -= len(part)
            yield part

    def rest(self) -> bytes:
        """What is left after the block, as far as it could be right."""
        while len(self.ahead) <= 4 and (more := self.members.piece()):
            self.ahead += more
        return self.ahead[:5]


def fields_of(head: bytes) -> dict[str, str]:
    """Names in lower case; the first of a repeated name; a line that begins with white space goes on with the value before."""
    found: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last is not None:
            found[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        last = name.strip().lower() if colon and name.strip().lower() not in found else None
        if last is not None:
            found[last] = value.strip()
    return found


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() else None


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def _stated_digest(value: str | None) -> str | None:
    name, _, digest = (value or "").partition(":")
    return digest.upper() if name.lower() == "sha1" and digest else None


def _read_record(reader: Reader, keep: bool) -> dict:
    row = {"record_type": None, "record_id": None, "target_uri": None, "payload_bytes": None, "payload_digest": None,
           "refers_to": None, "problem": None, "payload": None}
    head = reader.head()
    fields = fields_of(head) if head is not None and head.startswith(b"WARC/") else {}
    length = _number(fields.get("content-length"))
    row |= {"record_type": fields.get("warc-type"), "record_id": _bare(fields.get("warc-record-id")),
            "target_uri": _bare(fields.get("warc-target-uri")), "refers_to": _bare(fields.get("warc-refers-to"))}
    if length is None:
        return row | {"problem": "head"}
    block, payload, size, kept = hashlib.sha1(), hashlib.sha1(), 0, []
    http = fields.get("content-type", "").startswith("application/http")
    before = b"" if http else None  # what has come of the inner head
    inner = b""
    for part in reader.pieces(length):
        block.update(part)
        if before is not None:
            before += part
            at = before.find(BLANK)
            if at < 0:
                if len(before) > LONGEST_HEAD:
                    return row | {"problem": "head"}
                continue
            inner, part, before = before[:at], before[at + 4:], None
        payload.update(part)
        size += len(part)
        if keep:
            kept.append(part)
    digest = base64.b32encode(payload.digest()).decode()
    stated = _stated_digest(fields.get("warc-payload-digest"))
    block_stated = _stated_digest(fields.get("warc-block-digest"))
    if block_stated not in (None, base64.b32encode(block.digest()).decode()):
        row["problem"] = "block digest"
    elif row["record_type"] != "revisit" and stated not in (None, digest):
        row["problem"] = "payload digest"
    elif reader.rest() != BLANK:
        row["problem"] = "framing"
    if row["record_type"] == "revisit":  # the payload stands elsewhere; its length and digest are stated here
        return row | {"payload_bytes": _number(fields_of(inner).get("content-length")), "payload_digest": stated}
    return row | {"payload_bytes": size, "payload_digest": digest, "payload": b"".join(kept) if keep else None}


def read_records(stream: BinaryIO, keep_payload: bool = False) -> Iterator[dict]:
    """The records of one archive in order. ``problem`` is null, or says what is wrong: "head", "framing", "block digest",
    "payload digest", "truncated" (the file ends inside the record) or "damaged" (bytes that are no gzip; reading goes on at the next head)."""
    members = Members(stream)
    while True:
        row = None
        try:
            if not members.next():
                return
            reader = Reader(members)
            reader.ahead = members.piece()
            if reader.ahead:  # an empty member holds no record
                row = {"problem": "truncated"}
                row = _read_record(reader, keep_payload)
        except Truncated:
            row = {"problem": "truncated"}
        except zlib.error:
            members.skip_damage()
            row = {"problem": "damaged"}
        if row is not None:
            yield row


def open_archive(path: str, content: bytes | None) -> BinaryIO:
    """A stream of the file: its bytes if Spark has read them, a shared mount, or a store that Arrow opens."""
    if content is not None:
        return io.BytesIO(content)
    if path.startswith(("file:", "/")):
        return open(re.sub("^file:/+", "/", path), "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inner)


def _read(keep: bool):
    columns = [c.split()[0] for c in RECORDS.split(", ")] + ["payload"] * keep
    kinds = [pa.int64() if c in ("number", "payload_bytes") else pa.binary() if c == "payload" else pa.string() for c in columns]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in zip(columns, kinds)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path in enumerate(batch.column(0).to_pylist()):
                content = batch.column(1)[i].as_py() if batch.num_columns > 1 else None
                rows, held = [], 0
                with open_archive(path, content) as stream:
                    for number, row in enumerate(read_records(stream, keep)):
                        rows.append(row | {"file": path, "number": number})
                        held += len(row.get("payload") or b"") + 300
                        if held > 1 << 22:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read_warc(spark: SparkSession, folder: str, payload: bool = False, stream: bool | None = None) -> DataFrame:
    """One row per record of the archives under ``folder``, damaged ones too (see ``read_records``).

    With ``stream`` a task opens the file itself and reads on as it goes, for archives of any size; without it Spark hands
    over each file whole, which any store allows. By default files on a mount that all machines share are streamed.
    """
    files = spark.read.format("binaryFile").load(folder)
    if stream is None:
        scheme = folder.partition(":")[0] if ":/" in folder else spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file")
        stream = scheme.startswith("file")
    files = files.select("path") if stream else files.select("path", "content")
    return files.mapInArrow(_read(payload), RECORDS + (", payload binary" if payload else ""))


def warc_round_trip(df: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Write a record per row to a new folder under the shared one and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, problem. See ``write_warc`` for nulls, empty payloads and repeated rows."""
    folder = work_folder(df.sparkSession, "archives")
    prefix = "urn:page:"
    write_warc(df, folder, key, uri, payload, least, prefix)
    number = lambda c: F.expr(f"try_cast(substr({c}, {len(prefix) + 1}) as long)")
    # damage can't be told from a head record, so it stays and shows
    return read_warc(df.sparkSession, folder).filter("record_type is null or record_type <> 'warcinfo'").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"), "problem")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


OP13_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS least_id FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS BIGINT), 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN least_id IS NULL OR page_id IS NOT DISTINCT FROM least_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM least_id THEN least_id END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM f
"""
