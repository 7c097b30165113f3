import base64
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import queries, warc
from tidegauge.session import scratch_folder

PAGES = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages, least=0):
    largest = {}
    for page_id, _, html in pages:
        if page_id is not None and len((html or "").encode()) >= least:
            largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    rows = []
    for page_id, _, html in pages:
        last = largest.get(html or "")
        revisit = last is not None and (page_id is None or page_id < last)
        rows.append((page_id, len((html or "").encode()), digest(html),
                     "revisit" if revisit else "response", last if revisit else None))
    return sorted(rows, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


ODD = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "<p>same</p>"),
    (4, "http://a/\r\nX: y", ""), (5, "http://a/5", None), (None, "u", "<p>same</p>"),
    (None, None, "only"), (7, "http://a/7", "long " * 400_000), (8, "http://a/8", "été \x00 漢\r\n\r\nrest"),
    (8, "http://a/8", "été \x00 漢\r\n\r\nrest"), (-3, "http://a/-3", "x"),
]


def test_round_trip(spark):
    folder = scratch_folder(spark, "warc")
    pages = spark.createDataFrame(ODD, PAGES).selectExpr("*", "'extra' AS sha1", "1 AS last", "2 AS bytes")
    warc.write_pages(pages, folder)
    records = warc.read(spark, folder)
    assert found(warc.page_records(records)) == expected(ODD)
    payloads = {r.record_id: bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    for page_id, _, html in ODD:
        name = f"urn:page:{'none' if page_id is None else page_id}"
        if name in payloads and page_id is not None:
            assert payloads[name] == (html or "")
    assert records.where("record_id = 'urn:page:4'").first().target_uri == "http://a/ X: y"


def test_small_payloads_are_all_responses(spark):
    folder = scratch_folder(spark, "warc")
    warc.write_pages(spark.createDataFrame(ODD, PAGES), folder, least=5)
    assert found(warc.page_records(warc.read(spark, folder))) == expected(ODD, 5)


def test_no_pages(spark):
    folder = scratch_folder(spark, "warc")
    warc.write_pages(spark.createDataFrame([], PAGES), folder)
    assert warc.read(spark, folder).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(queries.QUERIES["op7_warc_pages"](spark, sf)) == expected(pages)


def test_predicates_reach_the_headers_and_payloads_stay_packed(spark, monkeypatch):
    folder = scratch_folder(spark, "warc")
    warc.write_pages(spark.createDataFrame(ODD, PAGES), folder)
    records = warc.read(spark, folder)
    some = records.where("record_type = 'revisit' AND target_uri LIKE 'http://a/%'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "") or "isnotnull" not in plan
    assert {r.record_id for r in some.collect()} == {"urn:page:1", "urn:page:2", "urn:page:4"}

    reader = warc.WarcReader(folder, True, warc.FILE_BYTES)
    assert list(reader.pushFilters([warc.EqualTo(("record_id",), "urn:page:7"),
                                    warc.GreaterThan(("payload_length",), 1)])) == [
        warc.GreaterThan(("payload_length",), 1)]
    inflated = []
    original = warc._Members.take
    monkeypatch.setattr(warc._Members, "take", lambda self, n, wanted: (
        inflated.append(n) if n > 100_000 else None) or original(self, n, wanted))
    rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert [r["record_id"] for r in rows] == ["urn:page:7"] and len(inflated) == 1
    without = warc.read(spark, folder, payload=False)
    assert without.where("payload IS NOT NULL").count() == 0 and without.count() == len(ODD)


@pytest.mark.parametrize("condition,value,holds", [
    (warc.IsNull(("target_uri",)), None, True), (warc.IsNotNull(("target_uri",)), None, False),
    (warc.EqualTo(("target_uri",), "a"), None, None), (warc.Not(warc.EqualTo(("target_uri",), "a")), None, None),
    (warc.In(("target_uri",), ("a", "b")), "b", True), (warc.In(("target_uri",), ("a", None)), "c", None),
    (warc.StringEndsWith(("target_uri",), "c"), "abc", True), (warc.StringContains(("target_uri",), "x"), "abc", False),
    (warc.LessThan(("target_uri",), "b"), "a", True), (warc.LessThanOrEqual(("target_uri",), "b"), "c", False),
    (warc.GreaterThanOrEqual(("target_uri",), "b"), "b", True),
])
def test_conditions(condition, value, holds):
    assert warc._holds(condition, {"target_uri": value}) is holds


def record(n, payload, length=None):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}>\r\n"
            f"Content-Type: application/http; msgtype=response\r\n"
            f"Content-Length: {len(block) if length is None else length}\r\n\r\n"
            ).encode() + block + b"\r\n\r\n"


BODIES = [b"a" * 5, b"", bytes(range(256)) * 900, b"end", b"five"]


def one_member():
    return gzip.compress(b"".join(record(i, b) for i, b in enumerate(BODIES)))


def members():
    return [gzip.compress(record(i, b)) for i, b in enumerate(BODIES)]


def told_members():
    row = lambda i, b: {"record_id": f"urn:page:{i}", "target_uri": "u", "refers_to": None, "payload": b}
    return [warc._member(warc.record_bytes(row(i, b), "2020-01-01T00:00:00Z"), 6) for i, b in enumerate(BODIES)]


@pytest.mark.parametrize("name,data", [
    ("a.warc.gz", one_member()),
    ("b.warc.gz", one_member() + b"\0" * 5000),
    ("c.warc.gz", b"".join(members()) + b"\0" * 3),
    ("d.warc.gz", b"\0\0".join(members())),
    ("e.warc.gz", gzip.compress(b"".join(map(record, range(2), BODIES))) + b"".join(members()[2:])),
    ("f.warc", b"".join(map(record, range(5), BODIES)) + b"\0" * 700),
    ("g.warc.gz", b"".join(told_members()) + b"\0"),
    ("h.warc.gz", b"".join(told_members()[:3]) + b"".join(members()[3:])),
])
def test_every_record_of_whole_archives_is_read(spark, tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    rows = warc.read(spark, str(tmp_path)).collect()
    assert [(r.record_id, bytes(r.payload), r.damage) for r in rows] == [
        (f"urn:page:{i}", b, None) for i, b in enumerate(BODIES)]
    heads = warc.read(spark, str(tmp_path), payload=False).where("record_id <> 'urn:page:1'").collect()
    assert [r.record_id for r in heads] == [f"urn:page:{i}" for i in (0, 2, 3, 4)]


PLAIN = b"".join(map(record, range(5), BODIES))
HEAD = len(record(4, BODIES[4]))


@pytest.mark.parametrize("name,data,before", [
    ("a.warc", PLAIN[:-6], 4), ("b.warc", PLAIN[:-HEAD + 30], 4), ("c.warc", PLAIN + b"no record at all", 5),
    ("d.warc", b"".join(map(record, range(2), BODIES)) + record(2, b"x", "ten"), 2),
    ("e.warc", b"".join(map(record, range(2), BODIES)) + record(2, b"more than it says", 20), 2),
    ("f.warc", record(0, b"a", "") + PLAIN, 0), ("g.warc", b"<html>", 0),
    ("h.warc.gz", b"".join(members())[:-9], 4), ("i.warc.gz", b"".join(members()) + b"tail", 5),
    ("j.warc.gz", b"".join(members()[:2]) + members()[2][:50], 2),
    ("k.warc.gz", b"".join(members()[:2]) + b"\x1f\x8b\x08" + b"\xff" * 80, 2),
    ("l.warc.gz", gzip.compress(PLAIN[:-6]), 4), ("m.warc.gz", b"plain text", 0),
    ("n.warc.gz", b"".join(told_members())[:-9], 4), ("o.warc.gz", members()[0][:8], 0),
])
def test_damaged_archives(spark, tmp_path, name, data, before):
    (tmp_path / name).write_bytes(data)
    with pytest.raises(Exception, match=name):
        warc.read(spark, str(tmp_path)).collect()
    rows = warc.read(spark, str(tmp_path), on_damage="tell").collect()
    assert [r.record_id for r in rows if r.damage is None][:before] == [f"urn:page:{i}" for i in range(before)]
    told, = (r for r in rows if r.damage is not None)
    assert name in told.damage and told.record_id is None
    heads = warc.read(spark, str(tmp_path), payload=False, on_damage="tell").collect()
    assert sum(r.damage is not None for r in heads) == 1


def test_empty_archives_have_no_records(spark, tmp_path):
    for name in ("a.warc", "b.warc.gz"):
        (tmp_path / name).write_bytes(b"")
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b""))
    assert warc.read(spark, str(tmp_path)).collect() == []


def test_paths():
    assert warc._filesystem("/a/b")[1] == "/a/b" and warc._filesystem("file:/a/b")[1] == "/a/b"
    assert warc._filesystem("file:///a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="wasbs"):
        warc._filesystem("wasbs://container@account/x")


def test_split_read_pushes_both_predicates(spark):
    folder = scratch_folder(spark, "warc")
    warc.write_pages(spark.createDataFrame(ODD, PAGES), folder)
    split = warc.read_split(spark, folder)
    assert found(warc.page_records(split)) == expected(ODD)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 2


def test_base32(spark):
    texts = ["", "a", "b" * 99, "é"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.base32(F.sha1("t")))
    assert [r[0] for r in rows.collect()] == [digest(t) for t in texts]


def test_foreign_archives(spark, tmp_path):
    """Members that do not tell their length, and archives that are not compressed."""
    bodies = BODIES
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(record(i, b)) for i, b in enumerate(bodies)))
    (tmp_path / "y.warc").write_bytes(b"".join(record(10 + i, b) for i, b in enumerate(bodies)))
    rows = warc.read(spark, str(tmp_path)).collect()
    assert {r.record_id: bytes(r.payload) for r in rows} == {
        f"urn:page:{n + i}": b for n in (0, 10) for i, b in enumerate(bodies)}
    assert all(r.payload_length == len(r.payload) for r in rows)


def test_members_are_plain_gzip():
    row = {"record_id": "r", "target_uri": "u", "refers_to": None, "payload": b"body",
           "payload_digest": None, "payload_length": None}
    data = warc.record_bytes(row, "2020-01-01T00:00:00Z")
    member = warc._member(data, 6)
    assert gzip.decompress(member) == data
    assert int.from_bytes(member[16:20], "little") == len(member) and zlib.crc32(data)


def test_files_of_lost_attempts_are_not_read(spark):
    folder = scratch_folder(spark, "warc")
    warc.write_pages(spark.createDataFrame(ODD[:2], PAGES), folder)
    system, path = warc._filesystem(folder)
    with system.open_output_stream(f"{path}/{'0' * 32}.warc.gz", compression=None) as out:
        out.write(b"half a file")
    assert warc.read(spark, folder).count() == 2
