import base64
import gzip
import hashlib
import io
import random

from pyspark.sql import functions as F

from tidegrain.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, refers_to string"


def brute(rows, least=0):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        keeper = last.get(h or "") if len(p) >= least else i
        same = keeper is None or keeper == i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if same else "revisit", None if same else keeper))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(1)
    bodies = ["", None, "<p>é</p>", "a\r\n\r\nb", "WARC/1.1\r\n", "x" * 200_000, "".join(chr(rng.randrange(32, 0x2000)) for _ in range(50_000))]
    rows = [(i, f"http://h/{i}", rng.choice(bodies)) for i in range(60)] + [(100 + i, "u", "".join(rng.choices("abcdef <>", k=rng.randrange(3000)))) for i in range(80)]
    return rows + [(None, None, "<p>é</p>"), (None, "u\r\nX-Page-Id: 7", "only here"), (500, "u", "twice"), (500, "u", "twice"), (501, "u", "twice")]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "p", "q") for r in rows], SCHEMA).repartition(parts)


def test_equal_to_brute_force(spark):
    for least in (0, 9):
        got = warc.archived(frame(spark, fixture()), min_bytes=least)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(fixture(), least)


def test_any_split_gives_every_record_once(spark, tmp_path):
    archives = warc.write(frame(spark, fixture(), 2), f"file://{tmp_path}/w", archive_bytes=40_000)
    assert archives.count() > 4 and archives.agg(F.sum("records")).first()[0] == len(fixture())
    for n in (97, 1000, 50_000, 1 << 30):
        rows = warc.read(spark, archives, n).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted((tuple(r) for r in rows), key=repr) == brute(fixture())


def test_payloads_round_trip_and_members_are_standard(spark, tmp_path):
    archives = warc.write(frame(spark, fixture()), str(tmp_path / "w"))
    texts = {i: (h or "").encode() for i, _, h in fixture() if i is not None}
    for r in warc.read(spark, archives).where("record_type = 'response' AND page_id IS NOT NULL").collect():
        assert bytes(r["payload"]) == texts[r["page_id"]]
    for a in archives.collect():
        with open(a["path"], "rb") as f:
            assert gzip.decompress(f.read()).count(b"WARC-Record-ID: <urn:uuid:") == a["records"]


def test_false_magic_and_broken_members_are_passed_over():
    good = [warc.member(i, "u", b"p%d" % i, None, False) for i in range(4)]
    noise = warc.MAGIC + b"\x00" * 7 + b"noise" * 9
    data = noise + good[0] + good[1][: len(good[1]) // 2] + good[2] + noise + gzip.compress(b"no record") + good[3] + warc.MAGIC
    for cut in range(1, len(data), 13):
        got = []
        for a in range(0, len(data), cut):
            got += [r["page_id"] for r in warc.records_in(warc.Window(io.BytesIO(data), len(data), 64), a, min(a + cut, len(data)))]
        assert got == [0, 2, 3]


def test_headers_that_are_no_numbers():
    good = warc.member(5, "u", b"body", None, False)
    record = gzip.decompress(good)
    assert warc.parse(record)["page_id"] == 5
    for bad in (b"abc", b"", b"-1", b"1e3", b"9" * 30):
        broken = record.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: " + bad + b"\r\nOld-Length: ", 1)
        assert warc.parse(broken) is None
        data = gzip.compress(broken) + good
        assert [r["page_id"] for r in warc.records_in(warc.Window(io.BytesIO(data), len(data), 64), 0, len(data))] == [5]
    for page in (b"p-1", b"", b"9" * 19, b"1.5", "٣".encode()):
        assert warc.parse(record.replace(b"X-Page-Id: 5", b"X-Page-Id: " + page))["page_id"] is None
    assert warc.parse(record.replace(b"X-Page-Id: 5", b"X-Page-Id: -8"))["page_id"] == -8
    revisit = gzip.decompress(warc.member(6, "u", b"body", 5, True))
    assert (warc.parse(revisit)["payload_bytes"], warc.parse(revisit)["refers_to"]) == (4, 5)
    assert warc.parse(revisit.replace(b"Content-Length: 4", b"Content-Length: x"))["payload_bytes"] == 0


def test_empty_table(spark):
    assert warc.archived(frame(spark, fixture()).limit(0)).collect() == []
