"""Web archives (WARC 1.1): written from rows, read back record by record.

An archive is a file of gzip members, one for each record. Payloads that repeat are
stored once; the other records are revisits that name the record which holds it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import lookup, query, small_batches, table
from gaugeworks.session import materialize, scratch_path

MIN_REVISIT_BYTES = 1000
# Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 32 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# What the reader decompresses at once, and the bytes of records it hands on together.
CHUNK = 1 << 16
OUT_BYTES = 4 << 20
# A header of a record that is longer than this is taken for a broken archive.
MAX_HEAD = 1 << 20
# Closes a member whose size field would not end in a zero byte (see `write_archives`).
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)


def to_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """One record a row: source_id, url, payload, payload_digest (hex), record_id, record_type, refers_id, refers_url.

    Of rows with equal payloads of at least `min_revisit` bytes the one with the
    largest id is the response, the others are revisits of it; of several such
    rows with that id one is the response. Null ids count as smaller than any
    other. A null payload is empty. Other columns are not read. `pages` is read
    twice, so it should be a stored table. Payloads are compared by SHA-1, another
    hash and length; the table of repeated payloads has one narrow row for each,
    and rows of a very frequent payload are spread over several tasks.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("source_id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.monotonically_increasing_id().alias("row_no"),
    ).select(
        "*", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").alias("size"),
        F.xxhash64("payload").alias("other_hash"),
    )
    named = F.md5(F.concat_ws("/", F.coalesce(F.col("source_id").cast("string"), F.lit("")), "payload_digest", "row_no"))
    uuid = F.regexp_replace(named, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "urn:uuid:$1-$2-$3-$4-$5")
    rows = rows.withColumn("record_id", uuid)
    keys = ["payload_digest", "other_hash", "size"]
    narrow = rows.select(*keys, "source_id", "row_no", "record_id", "url")
    repeated = (
        narrow.filter(F.col("size") >= min_revisit)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("source_id", "row_no", "record_id", "url")).alias("first"))
        .filter("n > 1")
    )
    repeated = materialize(repeated, "payloads")
    joined = lookup(rows, repeated, keys, F.col("row_no"))
    revisit = F.col("first").isNotNull() & (F.col("first.row_no") != F.col("row_no"))
    return joined.select(
        "source_id", "url", "payload", "payload_digest", "record_id",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.record_id")).alias("refers_id"),
        F.when(revisit, F.col("first.url")).alias("refers_url"),
    )


def _base32(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def _safe_uri(url: str) -> str:
    """The URL without characters that would end or fold its header line."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def member(row: dict, level: int = LEVEL, date: str = DATE) -> bytes:
    """One record as a gzip member."""
    payload, revisit = row["payload"], row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: {_base32(row['payload_digest'])}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).hexdigest())}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_safe_uri(row['url'])}")
    if row["source_id"] is not None:
        head.append(f"WARC-Source-ID: {row['source_id']}")
    if revisit:
        head += [f"WARC-Refers-To: <{row['refers_id']}>", f"WARC-Profile: {REVISIT_PROFILE}"]
        if row["refers_url"] is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_safe_uri(row['refers_url'])}")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = [packer.compress("\r\n".join(head).encode() + b"\r\n\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n")]
    return b"".join(parts) + packer.flush()


def _write(archive_bytes: int, level: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = filled = 0
        for batch in batches:
            out: list[tuple[int, bytes]] = []
            for i in range(batch.num_rows):
                data = member(batch.slice(i, 1).to_pylist()[0], level, date)
                if data[-1]:
                    data += EMPTY_MEMBER
                if filled and filled + len(data) > archive_bytes:
                    archive, filled = archive + 1, 0
                filled += len(data)
                out.append((archive, data[:-1]))
                if len(data) > OUT_BYTES or i == batch.num_rows - 1:
                    places, members = zip(*out)
                    out = []
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(places, pa.int32()), pa.array(members, pa.binary())], ["archive", "member"]
                    )

    return write


def write_archives(
    records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL, date: str = DATE
) -> None:
    """Write records (see `to_records`) as archives of about `archive_bytes` under `path`.

    Spark's own writer commits the files, so a lost task leaves nothing behind and
    any file system that Spark reaches will do. It writes each row's bytes and a
    line end; the line end is set to the zero byte that ends every member below
    16 MiB (the high byte of its size), and a larger member is followed by an empty
    one, which ends in zeros too. So the files hold gzip members and nothing else.
    """
    small_batches(records.sparkSession)
    members = records.mapInArrow(_write(archive_bytes, level, date), "archive int, member binary")
    members.select("archive", F.col("member").cast("string").alias("value")).write.partitionBy("archive").option(
        "lineSep", "\0"
    ).option("compression", "none").text(path)


class BrokenArchive(ValueError):
    """An archive that is cut, badly framed or fails a digest."""


class _Member:
    """The decompressed bytes of one gzip member, a piece at a time."""

    def __init__(self, data: memoryview, at: int):
        self.data, self.at, self.inflate = data, at, zlib.decompressobj(31)
        self.buffer = bytearray()

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        left = self.inflate.unconsumed_tail
        if not left:
            left = self.data[self.at : self.at + CHUNK]
            self.at += len(left)
            if not left:
                raise BrokenArchive("the archive ends inside a member")
        try:
            self.buffer += self.inflate.decompress(left, CHUNK)
        except zlib.error as e:
            raise BrokenArchive(str(e)) from e
        if self.inflate.eof:
            self.at -= len(self.inflate.unused_data)
        return True

    def empty(self) -> bool:
        while not self.buffer and self._more():
            pass
        return not self.buffer

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (found := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if seen > MAX_HEAD or not self._more():
                raise BrokenArchive("a record has no end of its header")
        out = bytes(self.buffer[:found])
        del self.buffer[: found + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise BrokenArchive("a record is shorter than its content length")
            piece = bytes(self.buffer[:n])
            del self.buffer[: len(piece)]
            n -= len(piece)
            if piece:
                yield piece

    def finish(self) -> int:
        """Check what follows the block; the place of the next member."""
        while self._more():
            if len(self.buffer) > 4:
                break
        if bytes(self.buffer) != b"\r\n\r\n":
            raise BrokenArchive("a record does not end after its content length")
        return self.at


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _same_digest(said: str | None, found: str) -> bool:
    """Whether a named SHA-1 digest, in base 32 or hex, is that one; there may be none."""
    if said is None or not said.lower().startswith("sha1:"):
        return True
    value = said[5:]
    return value.lower() == found if len(value) == 40 else _base32(found)[5:] == value.upper()


def _length(fields: dict[str, str]) -> int:
    try:
        n = int(fields["content-length"])
    except (KeyError, ValueError) as e:
        raise BrokenArchive("a record has no content length") from e
    if n < 0:
        raise BrokenArchive("a content length is negative")
    return n


def read_records(content: bytes, with_payload: bool = True) -> Iterator[dict]:
    """The records of an archive in sequence, each checked for framing and digests.

    Members are decompressed a piece at a time, so that besides the archive itself
    one record is in memory, without payloads only pieces of it.
    """
    data, at = memoryview(content), 0
    while at < len(data):
        m = _Member(data, at)
        if m.empty():
            at = m.at
            continue
        head = m.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise BrokenArchive("a member does not start with a record")
        fields = _fields(head)
        left = _length(fields)
        block, payload_sum = hashlib.sha1(), hashlib.sha1()
        http, kept, size, is_http = b"", [], 0, "application/http" in fields.get("content-type", "")
        in_head = is_http
        for piece in m.pieces(left):
            block.update(piece)
            if in_head:
                http += piece
                head_end = http.find(b"\r\n\r\n")
                if head_end < 0:
                    continue
                http, piece, in_head = http[:head_end], http[head_end + 4 :], False
            payload_sum.update(piece)
            size += len(piece)
            if with_payload:
                kept.append(piece)
        at = m.finish()
        kind = fields.get("warc-type")
        digest = payload_sum.hexdigest()
        if not _same_digest(fields.get("warc-block-digest"), block.hexdigest()):
            raise BrokenArchive(f"block digest of {fields.get('warc-record-id')}")
        said = fields.get("warc-payload-digest")
        if kind == "revisit":
            size = int(_fields(http).get("content-length", 0))
            if said and said.lower().startswith("sha1:"):
                digest = said[5:].lower() if len(said) == 45 else base64.b32decode(said[5:].upper()).hex()
        elif not _same_digest(said, digest):
            raise BrokenArchive(f"payload digest of {fields.get('warc-record-id')}")
        yield {
            "record_id": fields.get("warc-record-id", "").strip("<>"),
            "record_type": kind,
            "source_id": int(fields["warc-source-id"]) if "warc-source-id" in fields else None,
            "url": fields.get("warc-target-uri"),
            "payload_bytes": size,
            "payload_digest": digest,
            "refers_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload": b"".join(kept) if with_payload and kind != "revisit" else None,
        }


RECORD = (
    "record_id string, record_type string, source_id long, url string, payload_bytes long, "
    "payload_digest string, refers_id string, payload binary"
)
_ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("source_id", pa.int64()), ("url", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_id", pa.string()), ("payload", pa.binary())]
)


def _read(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out, held = [], 0
                for record in read_records(content.as_buffer(), with_payload):
                    out.append(record)
                    held += 200 + len(record["payload"] or b"")
                    if held > OUT_BYTES:
                        yield pa.RecordBatch.from_pylist(out, _ARROW)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, _ARROW)

    return read


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under `path`, one row each (`RECORD`).

    A task reads whole archives in sequence, and Spark hands it no more of them at once
    than 64 MB (or one larger one; a file has at most 2 GB). A cut archive, wrong
    framing or a digest that does not fit fails the job with `BrokenArchive`. For a
    revisit, size and digest are those it names; `resolve_revisits` checks them.
    A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(_read(with_payload), RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Add `refers_to`, the source id of the response that a revisit names; null for others.

    A revisit whose response is missing, or has another size or digest, fails the
    job. `records` is read twice, so it should be stored.
    """
    revisits = records.filter("record_type = 'revisit'")
    counts = revisits.groupBy("refers_id").agg(F.count(F.lit(1)).alias("n"))
    named = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("source_id").alias("refers_to"), F.col("payload_bytes").alias("size_there"),
        F.col("payload_digest").alias("digest_there"),
    )
    responses = materialize(counts.join(named, "refers_id"), "responses")
    joined = lookup(revisits, responses, ["refers_id"], F.xxhash64("record_id"))
    same = (F.col("digest_there") == F.col("payload_digest")) & (F.col("size_there") == F.col("payload_bytes"))
    checked = F.when(same, F.col("refers_to")).otherwise(
        F.raise_error(F.concat(F.lit("revisit without its response: "), F.col("record_id"))).cast("long")
    )
    rest = records.filter("record_type is distinct from 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return rest.unionByName(joined.select(*records.columns, checked.alias("refers_to")))


OP13_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS row_no FROM pages),
s AS (SELECT *, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
             row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, row_no DESC) AS place,
             first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, row_no DESC) AS largest
      FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN largest END AS refers_to
FROM s
"""


@query("op13_warc", OP13_SQL)
def op13_warc(spark, folder):
    """Every page written to archives and read back: its type, digest and the response it refers to."""
    path = scratch_path(spark, "warc")
    write_archives(to_records(table(spark, folder, "pages")), path)
    records = materialize(read_archives(spark, path, with_payload=False), "warc-records")
    return resolve_revisits(records).select(
        F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
