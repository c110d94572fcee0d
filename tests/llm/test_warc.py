import base64
import gzip
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barfold.llm import warc
from barfold.llm.queries import QUERIES, table
from tests.conftest import SMALL

PAGES = "page_id long, url string, html string, key string, offset long"


def expected(rows, least=0):
    """page_id, bytes, digest, type, refers_to by plain Python."""
    groups = defaultdict(list)
    for n, _, html, *_ in rows:
        groups[(html or "").encode()].append(n)
    out = []
    for n, _, html, *_ in rows:
        body = (html or "").encode()
        known = [k for k in groups[body] if k is not None]
        top = max(known) if known and len(groups[body]) > 1 and len(body) >= least else n
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((n, len(body), digest, *(("response", None) if n == top else ("revisit", top))))
    return sorted(out, key=str)


def read_back(spark, path):
    found = warc.records(warc.scan(spark, path))
    return found, sorted(
        [tuple(r) for r in found.select(
            F.col("key").cast("long"), "payload_bytes", "payload_digest", "record_type",
            F.col("refers_to").cast("long")).collect()], key=str)


ROWS = [
    (1, "http://a/ b\r\nWARC-Type: evil", "<p>same</p>", "x", 1),
    (2, None, "<p>same</p>", "x", 1),
    (3, "", "<p>same</p>", "x", 1),
    (4, "u", None, None, None),
    (5, "u", "", "x", 1),
    (None, "u", "", "x", 1),
    (6, "u", "naïve 日本 \U0001f600\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n", "x", 1),
    (7, "u", "long " * 400_000, "x", 1),
    (8, "u", "twice", "x", 1),
    (8, "u", "twice", "x", 1),
    (-9, "u", "\x1f alone \x00", "x", 1),
    (None, "u", "no number", "x", 1),
    (None, "u", "no number", "x", 1),
]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("least", [0, 6])
def test_round_trip_of_odd_rows(spark, tmp_path, compressed, least):
    warc.write(spark.createDataFrame(ROWS, PAGES), f"file://{tmp_path}/w", least_bytes=least, compressed=compressed)
    found, rows = read_back(spark, f"file://{tmp_path}/w")
    assert rows == expected(ROWS, least)
    texts = {(n, (html or "").encode()) for n, _, html, *_ in ROWS}
    stored = {(r.key and int(r.key), bytes(r.payload)) for r in found.where("record_type = 'response'").collect()}
    assert stored <= texts and {t for _, t in stored} == {t for _, t in texts}
    assert warc.gaps(warc.scan(spark, f"file://{tmp_path}/w")).isEmpty()
    assert found.where("key = '1'").first().url == "http://a/%20b%0D%0AWARC-Type:%20evil"


def test_no_rows(spark, tmp_path):
    warc.write(spark.createDataFrame([], PAGES), f"file://{tmp_path}/w")
    assert warc.scan(spark, f"file://{tmp_path}/w").isEmpty()


def test_archives_are_bounded_and_read_by_gzip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 2000)
    rows = [(n, "u", hashlib.sha512(b"%d" % n).hexdigest() * 10) for n in range(400)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    files = list((tmp_path / "w").glob("part-*"))
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 8 * 4000
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC-Type: response\r\n") for f in files) == 400


def records_of(compressed):
    bodies = [f"<p>{n} {'x' * (n * 37)}</p>" for n in range(6)]
    data = [warc._record_bytes(str(n), "u", b, None, "2020-01-01T00:00:00Z") for n, b in enumerate(bodies)]
    return [gzip.compress(d) if compressed else d for d in data]


def keys(found):
    return [f["key"] for _, _, f in found if isinstance(f, dict)]


def covered(found, size):
    at = 0
    for start, end, _ in found:
        assert start == at
        at = end
    assert at == size


@pytest.mark.parametrize("compressed", [True, False])
def test_any_flipped_byte_costs_one_record(compressed):
    parts = records_of(compressed)
    data = b"".join(parts)
    clean = list(warc.salvage(memoryview(data)))
    assert keys(clean) == list("012345")
    covered(clean, len(data))
    bounds = [sum(map(len, parts[:k])) for k in range(7)]
    for place in range(0, len(data), 7):
        bad = bytearray(data)
        bad[place] ^= 0x55
        found = list(warc.salvage(memoryview(bytes(bad))))
        covered(found, len(data))
        hit = next(k for k in range(6) if place < bounds[k + 1])
        lost = [(s, e) for s, e, f in found if isinstance(f, str)]
        if lost:  # a byte that nothing checks, as in the date, may change unseen
            assert keys(found) == [str(k) for k in range(6) if k != hit]
            assert lost == [(bounds[hit], bounds[hit + 1])]


@pytest.mark.parametrize("compressed", [True, False])
def test_cut_removed_and_foreign_bytes(compressed):
    parts = records_of(compressed)
    data = b"".join(parts)
    first, second = len(parts[0]), len(parts[0]) + len(parts[1])
    # Bytes taken out of record 1: later records are found at their new places.
    found = list(warc.salvage(memoryview(data[: first + 40] + data[first + 60 :])))
    assert keys(found) == list("02345")
    covered(found, len(data) - 20)
    # Foreign bytes with false starts between two records.
    foreign = b"\x1f\x8b\x08 no member WARC/1.1\r\nno header"
    found = list(warc.salvage(memoryview(data[:second] + foreign + data[second:])))
    assert keys(found) == list("012345")
    assert [(s, e) for s, e, f in found if isinstance(f, str)] == [(second, second + len(foreign))]
    # The last record is cut short.
    found = list(warc.salvage(memoryview(data[:-9])))
    assert keys(found) == list("01234")
    covered(found, len(data) - 9)


def test_mixed_members_and_plain_records():
    plain, packed = records_of(False), records_of(True)
    data = b"".join([plain[0], packed[1], warc.EMPTY_MEMBER, gzip.compress(plain[2] + plain[3]), plain[4]])
    assert keys(warc.salvage(memoryview(data))) == list("01234")
    half = gzip.compress(plain[2] + plain[3][:-30])
    found = list(warc.salvage(memoryview(half + packed[4])))
    assert keys(found) == list("24") and [f for _, _, f in found if isinstance(f, str)]


def test_gap_log(spark, tmp_path):
    parts = records_of(True)
    bad = bytearray(b"".join(parts))
    bad[len(parts[0]) + 50] ^= 0xFF
    (tmp_path / "a").write_bytes(bytes(bad))
    (tmp_path / "b").write_bytes(b"")
    scanned = warc.scan(spark, f"file://{tmp_path}")
    assert sorted(r.key for r in warc.records(scanned).collect()) == list("02345")
    log = warc.gaps(scanned).collect()
    assert [(r.file.rsplit("/", 1)[1], r.offset, r.length) for r in log] == [("a", len(parts[0]), len(parts[1]))]


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "pages").select("page_id", "url", "html").collect()]
    found = QUERIES["op13_warc"](spark, SMALL)
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
