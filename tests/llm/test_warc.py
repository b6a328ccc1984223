import gzip
import hashlib
import random
from collections import defaultdict
from pathlib import Path

import pytest
from fixtures import CLASHING
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from gaugeworks.llm import common, warc

LONG = "a page of more than a thousand bytes, with é and \0 and \r\n\r\n in it " * 20


def pages_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in [*CLASHING, "n", "payload", "first", "source_id", "row_no"]})


def round_trip(spark, pages, path, **options):
    pages.write.parquet(f"{path}/pages")
    warc.write_archives(warc.to_records(spark.read.parquet(f"{path}/pages")), f"{path}/warc", **options)
    read = warc.read_archives(spark, f"{path}/warc")
    read.write.parquet(f"{path}/read")
    return warc.resolve_revisits(spark.read.parquet(f"{path}/read")).collect()


def brute(rows):
    """(id, bytes, digest, type, refers_to) sorted; one response for each long payload."""
    groups, out = defaultdict(list), []
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    for html, ids in groups.items():
        data = html.encode()
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            again = len(data) >= 1000 and k < len(ids) - 1
            out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", ids[-1] if again else None))
    return sorted(out, key=str)


def found(records):
    return sorted(
        ((r.source_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str
    )


ROWS = [
    (1, "http://a.example/x", LONG), (2, "http://a.example/y\r\nWARC-Type: x", LONG), (3, None, LONG), (3, None, LONG),
    (4, "http://b.example/", "short"), (5, "http://b.example/", "short"), (6, "", ""), (7, "u", None),
    (None, "u", "z" * 999), (8, "u", "z" * 999), (9, "u", "z" * 1000), (None, None, "z" * 1000), (None, None, None),
    (10, "é", "only " * 300), (11, "u", "w" * 2000), (11, "u", "w" * 2000), (None, "u", "q" * 2000), (None, "u", "q" * 2000),
]


def test_round_trip_of_awkward_rows(spark, tmp_path):
    got = round_trip(spark, pages_of(spark, ROWS), tmp_path)
    assert found(got) == brute(ROWS)
    texts = defaultdict(set)
    for _, _, html in ROWS:
        texts[hashlib.sha1((html or "").encode()).hexdigest()].add((html or "").encode())
    for r in got:
        assert r.payload is None if r.record_type == "revisit" else {bytes(r.payload)} == texts[r.payload_digest]
    assert [r.url for r in got if r.source_id == 2] == ["http://a.example/y%0D%0AWARC-Type:%20x"]


def test_hot_payload_and_small_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "SPREAD_ROWS", 7)
    rows = [(i, "u", LONG) for i in range(100)] + [(100 + i, "u", f"{i % 9} " * 900) for i in range(60)]
    got = round_trip(spark, pages_of(spark, rows), tmp_path, archive_bytes=2000)
    assert found(got) == brute(rows)
    assert len(list(tmp_path.glob("warc/archive=*"))) > 3


def test_archives_are_gzip_members_and_nothing_else(spark, tmp_path):
    noise = random.Random(1).randbytes(9 << 20).hex()  # more than 16 MiB in one record
    rows = [(1, "u", noise), (2, "u", LONG), (3, "u", LONG), (4, "u", "")]
    got = round_trip(spark, pages_of(spark, rows).coalesce(1), tmp_path)
    assert found(got) == brute(rows)
    files = [p for p in Path(tmp_path, "warc").rglob("part-*")]
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in files)
    assert plain.count(b"WARC/1.1\r\n") == 4 and plain.endswith(b"\r\n\r\n")


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, pages_of(spark, [(1, "u", "x")]).filter("page_id < 0"), tmp_path) == []


RECORD = {
    "source_id": 1, "url": "u", "payload": b"some payload " * 500, "record_id": "urn:uuid:1", "record_type": "response",
    "payload_digest": hashlib.sha1(b"some payload " * 500).hexdigest(), "refers_id": None, "refers_url": None,
}


def test_reader_goes_member_by_member():
    data = warc.member(RECORD) + warc.EMPTY_MEMBER + warc.member(RECORD | {"payload": b"", "payload_digest": hashlib.sha1().hexdigest()})
    first, second = warc.read_records(data)
    assert first["payload"] == RECORD["payload"] and second["payload"] == b"" and second["payload_bytes"] == 0
    assert list(warc.read_records(b"")) == []


@pytest.mark.parametrize("broken", ["cut", "digest", "block", "short", "long", "head", "bytes"])
def test_broken_archives_are_found(broken):
    good = gzip.decompress(warc.member(RECORD))
    if broken == "cut":
        data = warc.member(RECORD)[:-20]
    elif broken == "bytes":
        data = b"not a gzip member"
    else:
        change = {
            "digest": (b"sha1:" + warc._base32(RECORD["payload_digest"])[5:].encode(), b"sha1:" + b"A" * 32),
            "block": (b"some payload some", b"some pay1oad some"),
            "short": (b"\r\n\r\n", b"\r\n\r\n", -1),
            "long": (b"Content-Length: 65", b"Content-Length: 75"),
            "head": (b"WARC/1.1", b"WARC?1.1"),
        }[broken]
        data = gzip.compress(good[:-5] if broken == "short" else good.replace(*change[:2], 1))
    with pytest.raises(warc.BrokenArchive):
        list(warc.read_records(data))


def test_revisit_without_its_response_fails(spark, tmp_path):
    rows = [warc.member(RECORD | {"record_type": "revisit", "refers_id": "urn:uuid:9"})]
    Path(tmp_path, "one.warc.gz").write_bytes(rows[0])
    records = warc.read_archives(spark, str(tmp_path))
    with pytest.raises(Exception, match="revisit without its response"):
        warc.resolve_revisits(records).collect()


def test_broken_archive_fails_the_job(spark, tmp_path):
    Path(tmp_path, "one.warc.gz").write_bytes(warc.member(RECORD)[:-9])
    with pytest.raises(PythonException, match="BrokenArchive"):
        warc.read_archives(spark, str(tmp_path)).collect()
