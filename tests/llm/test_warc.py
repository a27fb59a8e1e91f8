import gzip
import hashlib
import io

import pytest

from pulsevault.llm import queries, warc


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'clash' AS key", "'clash' AS payload")


ROWS = [
    (1, "http://a.example/1", "x" * 999), (2, "http://a.example/2", "x" * 999), (3, "http://a.example/3", "é" * 500), (4, None, "é" * 500), (5, "http://b.example/", "é" * 500),
    (6, "u v\nw", None), (7, "http://c.example/", ""), (8, "http://d.example/", "WARC/1.0\r\n\r\nfiledesc:\n" + "line\r\n\r\n" * 300), (9, "http://d.example/", "z" * 2_000_000), (10, "http://d.example/", "z" * 2_000_000), (-5, "n", "é" * 500),
]


def brute(rows, least=1000):
    out, best = {}, {}
    for k, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least and k is not None:
            best[b] = max(best.get(b, k), k)
    for k, _, h in rows:
        b = (h or "").encode()
        refers = best.get(b) if best.get(b) != k else None
        out[k] = (len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers is not None else "response", refers)
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    got = {r.record_key: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_pages(pages(spark, ROWS), version=version).collect()}
    assert got == brute(ROWS)


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", "q" * 1000), (3, "u", "q" * 1000), (3, "u", "q" * 1000), (None, None, None)]
    got = sorted((str(r.record_key), r.record_type, str(r.refers_to)) for r in warc.archive_pages(pages(spark, rows)).collect())
    assert got == [("3", "response", "None"), ("3", "response", "None"), ("None", "response", "None"), ("None", "revisit", "3")]


def test_empty(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_ids_hold_their_keys():
    for k in (0, 1, -1, 2**63 - 1, -(2**63), 123456789):
        assert warc.key_of(warc.record_id(k, "ab" * 20)) == k
    assert warc.key_of(warc.record_id(None, "ab" * 20, "u", "s")) is None


def test_arc_versions_and_damage(spark, tmp_path):
    recs = [("http://x/ y", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n"), ("http://z/", "-", "20010203040506", "image/gif", bytes(range(256)))]
    for v in (1, 2):
        data = warc.arc_bytes(recs, v)
        back = list(warc.parse_arc(data))
        assert [(r["URL"], r["content"]) for r in back] == [(r[0], r[4]) for r in recs]
        with pytest.raises(ValueError):
            list(warc.parse_arc(data[:-50]))
        (tmp_path / f"v{v}.arc.gz").write_bytes(gzip.compress(data))
    got = warc.read_arc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted([b"body\n", bytes(range(256))] * 2)
    path = str(tmp_path / "out")
    warc.write_warc(warc.with_revisits(warc.read_arc(spark, str(tmp_path)), 10**9), path)
    back = warc.read_warc(spark, path).collect()
    assert sorted(bytes(r.payload) for r in back) == sorted([b"body\n", bytes(range(256))] * 2)
    assert {r.warc_date for r in back} == {"2001-02-03T04:05:06Z"}


def test_record_is_valid_warc():
    r = {"key": 1, "url": "http://a/", "ip": "1.1.1.1", "stamp": "20240101000000", "mime": "text/html", "head": b"HTTP/1.1 200 OK\r\n\r\n", "payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(), "size": 3, "refers": None}
    headers, block = next(warc.parse_warc(io.BufferedReader(io.BytesIO(warc.warc_record(r) + b"\n"))))
    assert headers["warc-type"] == "response" and block.endswith(b"abc") and headers["content-length"] == str(len(block))


def test_query_has_sql():
    assert "op2_warc_converter" in queries.oracle_sql()


def test_archives_of_other_writers(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:6f2c1f0e-5e1a-4a1b-9d0a-0123456789ab>\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"
    page = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <http://id/1>\r\nWARC-Target-URI: http://x/\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
    (tmp_path / "a.warc").write_bytes(info + page + block + b"\r\n\r\n")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(page + block + b"\r\n\r\n"))
    got = sorted((r.record_type, r.target_uri, r.record_key, bytes(r.payload)) for r in warc.read_warc(spark, str(tmp_path)).collect())
    assert got == [("response", "http://x/", None, b"hello")] * 2 + [("warcinfo", None, None, b"ab\r\n")] * 2


def test_damage_is_reported_on_request(spark, tmp_path):
    recs = [(f"http://x/{i}", "-", "20010203040506", "text/html", b"body %d" % i) for i in range(3)]
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc").write_bytes(warc.arc_bytes(recs)[:-4])
    with pytest.raises(Exception, match="cut off"):
        warc.read_arc(spark, str(tmp_path / "arc")).collect()
    got = warc.read_arc(spark, str(tmp_path / "arc"), strict=False)
    assert sorted((r.url or "", r.problem is not None) for r in got.collect()) == [("", True), ("http://x/0", False), ("http://x/1", False)]
    warc.write_warc(warc.with_revisits(got), str(tmp_path / "out"))
    assert warc.read_warc(spark, str(tmp_path / "out")).count() == 2
    r = {"key": 1, "url": "http://a/", "ip": "1.1.1.1", "stamp": "20240101000000", "mime": "text/html", "head": b"HTTP/1.1 200 OK\r\n\r\n", "payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(), "size": 3, "refers": None}
    good = warc.warc_record(r) + b"\n"
    bad = good.replace(b"abc", b"abd")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(good + bad + good)
    (tmp_path / "w" / "b.warc.gz").write_bytes(gzip.compress(good * 3)[:-9])
    (tmp_path / "w" / "c.warc").write_bytes(good + b"nonsense")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_warc(spark, str(tmp_path / "w" / "a.warc")).collect()
    found = warc.read_warc(spark, str(tmp_path / "w"), strict=False).collect()
    assert sorted(r.problem is None for r in found) == [False] * 3 + [True] * sum(r.problem is None for r in found) and sum(r.problem is None for r in found) >= 3
