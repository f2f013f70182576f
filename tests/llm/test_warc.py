"""WARC archives: a round trip, an independent reading of the files, damaged archives."""

import base64
import gzip
import hashlib
import io
import random
import re
import zlib

import pytest

from etlkit.llm import warc
from etlkit.llm.queries import QUERIES, SQL
from etlkit.llm.warc import WarcError, check_revisits, read_archives, read_stream, round_trip, write_archives
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.01"
NULL = -(1 << 70)
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def brute(pages):
    out, groups = [], {}
    for i, (page, html) in enumerate(pages):
        groups.setdefault((html or "").encode(), []).append((NULL if page is None else page, i))
    for raw, members in groups.items():
        last = max(members)
        for page, i in members:
            revisit = len(raw) >= 1000 and (page, i) != last
            out.append((pages[i][0], len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response",
                        (None if last[0] == NULL else last[0]) if revisit else None))
    return sorted(out, key=repr)


def odd_pages():
    rng = random.Random(4)
    long = lambda n: "".join(rng.choice("abc <>é\r\n") for _ in range(n))
    twin, other = long(1500), "x" * 1000
    pages = [(1, None), (2, ""), (3, "WARC/1.1\r\n\r\n"), (4, long(300_000)), (5, "x" * 999), (6, "x" * 999), (7, "\x1f\u008b\x08" * 500), (None, twin), (None, None), (-(1 << 63), twin), ((1 << 63) - 1, "z")]
    pages += [(i, twin) for i in range(100, 160)] + [(i, other) for i in (20, 22, 22, 22, 21)] + [(30, long(2000)), (31, "é" * 500), (32, "é" * 500)]
    rng.shuffle(pages)
    return pages


def frame(spark, pages, parts=5):
    return spark.createDataFrame([(i, f"http://a.b/{i}?q=1 2\r\nX: y" if i != 3 else None, h, "clash") for i, h in pages],
                                 "page_id long, url string, html string, record_type string").repartition(parts)


@pytest.mark.parametrize("few", [500_000, 0])
def test_round_trip_against_brute_force(spark, rows, tmp_path, monkeypatch, few):
    monkeypatch.setattr(warc, "SMALL_KEYS", few)
    pages = odd_pages()
    assert rows(round_trip(frame(spark, pages), str(tmp_path / "a")), *COLUMNS) == brute(pages)
    unlike = [p for p in pages if p[0] is not None and p[0] != 22]
    assert rows(round_trip(frame(spark, unlike), f"file://{tmp_path}/b"), *COLUMNS) == brute(unlike)


def test_documents_of_the_tables(spark):
    assert differences(QUERIES["op11_warc_round_trip"](spark, FOLDER), connect(FOLDER), SQL["op11_warc_round_trip"]) == []


def test_files_are_sound_by_other_means(spark, tmp_path):
    """Every member opens by itself, and the whole file by any gzip reader; records are framed as the format says."""
    pages = [p for p in odd_pages() if p[0] is not None]
    archives = write_archives(frame(spark, pages), str(tmp_path / "a"), archive_bytes=20_000).collect()
    assert len(archives) > 5 and sum(a.records for a in archives) == len(pages)
    seen, ids = [], set()
    for a in archives:
        raw = open(a.archive, "rb").read()
        assert len(raw) == a.bytes
        whole, members = gzip.decompress(raw), []
        while raw:
            z = zlib.decompressobj(31)
            members.append(z.decompress(raw))
            raw = z.unused_data
        assert b"".join(members) == whole
        for member in members:
            head, _, rest = member.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            block = rest[:int(fields["Content-Length"])]
            assert head.startswith(b"WARC/1.1\r\n") and rest[len(block):] == b"\r\n\r\n"
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            assert re.fullmatch(r"\S+", fields.get("WARC-Target-URI", "-")) and fields["WARC-Record-ID"] not in ids
            ids.add(fields["WARC-Record-ID"])
            if fields["WARC-Type"] == "response":
                seen.append((int(fields["Page-ID"]), block.partition(b"\r\n\r\n")[2]))
    html = {(i, (h or "").encode()) for i, h in pages}
    assert set(seen) <= html and len(seen) == sum(r[3] == "response" for r in brute(pages))


def test_payloads_come_back(spark, tmp_path):
    pages = [(i, h) for i, h in odd_pages() if i is not None and i < 20]
    archives = write_archives(frame(spark, pages), str(tmp_path / "a"))
    got = read_archives(archives, payloads=True, files=2).where("record_type = 'response'").collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == sorted((i, (h or "").encode()) for i, h in pages)


def test_empty_table(spark, tmp_path):
    assert round_trip(frame(spark, [(1, "x")]).limit(0), str(tmp_path / "a")).collect() == []


def member(fields, block, end=b"\r\n\r\n"):
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return gzip.compress(b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block + end)


def resource(n, **more):
    return member({"WARC-Type": "resource", "WARC-Record-ID": f"<r{n}>", "Content-Length": 5, **more}, b"hello")


def errors(raw):
    return [(r.get("record_id"), r["error"]) for r in read_stream(io.BytesIO(raw), report=True)]


def test_damaged_archives():
    good, digest = resource(1), "sha1:" + hashlib.sha1(b"hello").hexdigest()
    assert errors(good + resource(2, **{"WARC-Block-Digest": digest, "WARC-Payload-Digest": "md5:0"})) == [("<r1>", None), ("<r2>", None)]
    assert errors(b"") == []
    for bad, why in ((resource(3, **{"WARC-Block-Digest": "sha1:" + "0" * 40}), "block digest"), (resource(3, **{"WARC-Payload-Digest": "sha1:" + "0" * 40}), "payload digest"),
                     (resource(3, **{"Content-Length": 4}), "does not end"), (resource(3, **{"Content-Length": 6}), "shorter"), (resource(3, **{"Content-Length": 99}), "shorter"), (resource(3, **{"Content-Length": "-1"}), "content length"),
                     (gzip.compress(b"GET / HTTP/1.1\r\n\r\n"), "no record"), (gzip.compress(b"x" * (3 << 20)), "without an end"), (b"garbage" + MARK, "header")):
        found = errors(good + bad + resource(4))
        assert found[0] == ("<r1>", None) and found[-1] == ("<r4>", None), why
        assert len(found) > 2 and all(e for _, e in found[1:-1]) and (why == "header" or why in found[1][1])
        with pytest.raises(WarcError, match=f"at byte {len(good)}"):
            list(read_stream(io.BytesIO(good + bad)))
    flipped = bytearray(good + good + good)
    flipped[len(good) + 20] ^= 255
    assert errors(bytes(flipped))[0] == errors(bytes(flipped))[-1] == ("<r1>", None)
    for cut in range(1, len(good)):
        found = errors(good + good[:cut])
        assert found[0] == ("<r1>", None) and found[1:] and all(e for _, e in found[1:])


MARK = b"\x1f\x8b\x08\x00broken"


def test_a_record_larger_than_memory_should_hold_is_read_in_pieces():
    block = b"HTTP/1.1 200 OK\r\n\r\n" + bytes(50 << 20)
    raw = member({"WARC-Type": "response", "Content-Type": "application/http", "Content-Length": len(block)}, block)
    stream = io.BytesIO(raw)
    source = warc.Source(stream)
    m = warc.Member(source)
    m.until(b"\r\n\r\n")
    assert max(len(m.ready) for _ in m.pieces(len(block))) <= warc.PIECE
    assert [r["payload_bytes"] for r in read_stream(io.BytesIO(raw))] == [50 << 20]


def test_job_names_the_damaged_archive(spark, tmp_path):
    path = tmp_path / "x.warc.gz"
    path.write_bytes(resource(1) + b"garbage")
    archives = spark.createDataFrame([(str(path),)], "archive string")
    with pytest.raises(Exception, match="x.warc.gz: at byte"):
        read_archives(archives).collect()
    assert [r.error is None for r in read_archives(archives, report=True).collect()] == [True, False]


def test_revisit_without_its_response(spark):
    schema = "record_type string, record_id string, refers_to_record string, page_id long, refers_to long, payload_bytes long, payload_digest string"
    response = ("response", "<a>", None, 9, None, 1000, "d")
    check_revisits(spark.createDataFrame([response, ("revisit", "<b>", "<a>", 1, 9, 1000, "d")], schema))
    for wrong in (("revisit", "<b>", "<c>", 1, 9, 1000, "d"), ("revisit", "<b>", "<a>", 1, 9, 1001, "d"), ("revisit", "<b>", "<a>", 1, None, 1000, "d")):
        with pytest.raises(WarcError):
            check_revisits(spark.createDataFrame([response, wrong], schema))
