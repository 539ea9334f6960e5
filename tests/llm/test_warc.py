"""Archives: exact round trip over any cut into ranges, revisits, standard gzip."""

import glob
import gzip
import hashlib

import pytest

from shoptide.llm import warc
from shoptide.llm.queries import ORACLES, QUERIES

SCHEMA = "page_id long, url string, html string, payload string"
BIG = "<p>é</p>" * 40
NOISE = "".join(chr(33 + i * i % 90) for i in range(20_000))
PAGES = [(1, "u", None), (2, None, ""), (3, "a b", "x"), (4, "u", "x"), (7, "u", BIG), (5, "u", BIG), (6, None, BIG), (5, "u", BIG), (8, "u", NOISE), (None, "u", "lone")]


def test_query_equals_sql(spark, folder, sql_rows):
    columns, rows = sql_rows(ORACLES["op8_warc"])
    found = QUERIES["op8_warc"](spark, folder)
    assert sorted(found.columns) == columns
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=str) == rows


@pytest.mark.parametrize("range_bytes", [1 << 20, 97, 1000])
def test_round_trip(spark, range_bytes, monkeypatch):
    monkeypatch.setattr(warc, "READ", 64)
    pages = spark.createDataFrame([(*p, "own") for p in PAGES], SCHEMA).repartition(2)
    rows = warc.round_trip(pages, range_bytes=range_bytes).collect()
    assert len(rows) == len(PAGES)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in rows)
    wanted = [(str(i), "revisit" if h == BIG and i != 5 else "response", "5" if h == BIG and i != 5 else None, digest(h), len((h or "").encode())) for i, _, h in PAGES]
    assert got == sorted(wanted)
    assert {r.payload.decode() for r in rows if r.record_type == "response"} == {"", "x", BIG, NOISE, "lone"}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")


def test_false_magic_is_no_record():
    assert not warc.starts_record(warc.MAGIC + b"\0" * 50)
    assert not warc.starts_record(warc.member(b"no record"))
    data = warc.member(warc.record(1, "u", b"p", hashlib.sha256(b"p").hexdigest(), None))
    assert warc.starts_record(data[: warc.PROBE])


def test_archives_are_plain_gzip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "own") for p in PAGES], SCHEMA).coalesce(1)
    archives = warc.write_archives(pages, str(tmp_path))
    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/*.warc.gz"))
    assert text.count(warc.VERSION) == len(PAGES) and archives.count() == 1


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_damaged_members_are_passed_over(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u {i}", chr(97 + i) * 3000 + str(i)) for i in range(5)], "page_id long, url string, html string").coalesce(1)
    path, size = warc.write_archives(pages, str(tmp_path)).first()
    data = bytearray(open(path, "rb").read())
    starts = [i for i in range(len(data)) if warc.starts_record(bytes(data[i : i + warc.PROBE]))]
    assert len(starts) == 5
    for at in (starts[0] + (starts[1] - starts[0]) * 3 // 4, starts[2] - 12):  # inside the first member, and the second one's checksum
        data[at] ^= 0xFF
        data[at + 1] ^= 0xFF
    open(path, "wb").write(data[:-5])  # the last one is cut off
    for range_bytes in (1 << 20, 101):
        rows = warc.read_archives(spark.createDataFrame([(path, size - 5)], "path string, size long"), str(tmp_path), range_bytes).collect()
        assert sorted((r.page_id, r.url) for r in rows if r.record_type == "response") == [("2", "u 2"), ("3", "u 3")]
        assert sorted(r.refers_to for r in rows if r.record_type == "damaged") == sorted(f"{path}:{starts[k]}" for k in (0, 1, 4))


def test_damaged_headers_are_reported(tmp_path):
    members = [warc.member(warc.record(i, f"u {i}", b"p" * 500, hashlib.sha256(b"p" * 500).hexdigest(), None)) for i in range(3)]
    unlike = warc.member(warc.VERSION + b"no field\r\n\r\n")
    second = len(members[0])
    # everywhere behind what the version line inflates from, and a header that is none
    first = next(k for k in range(10, second) if warc.zlib.decompressobj(31).decompress(members[1][:k]).startswith(warc.VERSION)) + 8
    broken = [members[1][:at] + bytes([members[1][at] ^ 0xFF]) + members[1][at + 1 :] for at in range(first, len(members[1]))]
    store, _ = warc.file_system(str(tmp_path))
    for n, middle in enumerate([*broken, unlike]):
        path, data = f"{tmp_path}/{n}.warc.gz", members[0] + middle + members[2]
        open(path, "wb").write(data)
        for step in (len(data), 101):
            rows = [r for at in range(0, len(data), step) for r in warc.records_in(store, path, len(data), at, at + step)]
            assert [(r["record_type"], r["page_id"]) for r in rows] == [("response", "0"), ("damaged", None), ("response", "2")]
            assert rows[1]["refers_to"] == f"{path}:{second}"
