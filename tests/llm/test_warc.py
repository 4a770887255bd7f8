"""WARC archives: exact round trips."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest

from ferrytally.llm import warc

SCHEMA = "page_id bigint, url string, html string, start string, payload string, sha string"


def pages():
    rng = random.Random(2)
    big = "".join(rng.choice("abcdefghij<>/ ") for _ in range(300_000))
    rows = [
        (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (7, None, "<p>x</p>"), (3, "http://b\r\nX: y", "é世" * 50),
        (4, "u", None), (5, "u", ""), (6, "u", big), (8, "u", big + "!"), (9, "u", "WARC/1.1\r\n\r\n\x1f\u008b\b"),
        (None, "n", "<p>x</p>"), (None, "n", "only null"), (None, "n", "only null"), (10, "same", "rep"), (10, "same", "rep"),
    ]
    return [(*r, "s", "p", "h") for r in rows]


def expected(rows):
    largest = {}
    for page, _, html, *_ in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        top = largest.get(html or "")
        revisit = top is not None and top != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "out")
    warc.write(spark.createDataFrame(pages(), SCHEMA).repartition(3), path)
    return path


@pytest.mark.parametrize("split", [1 << 20, 1000, 97])
def test_round_trip(spark, archives, split):
    got = warc.read(spark, archives, split).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(pages())


def test_payloads(spark, archives):
    got = {(r["page_id"], r["record_type"]): r for r in warc.read(spark, archives, 4096, with_payload=True).collect()}
    assert got[6, "response"]["payload"] == pages()[6][2].encode()
    assert got[3, "response"]["url"] == "http://b%0D%0AX: y"
    assert got[1, "revisit"]["payload"] is None and got[1, "revisit"]["refers_to"] == 7


def test_files_are_plain_gzip(archives):
    import glob

    for name in glob.glob(f"{archives}/part-*"):
        with gzip.open(name) as f:
            data = f.read()
        assert data.count(b"WARC/1.1\r\nWARC-Type") >= 1


def test_min_bytes(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write(spark.createDataFrame(pages(), SCHEMA), path, min_bytes=100_000)
    assert {r["record_type"] for r in warc.read(spark, path).collect()} == {"response"}


def test_empty(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.read(spark, path).collect() == []


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_false_magic_and_nested_archive():
    """A record stored without compression that holds an archive: its inner records are seen, and told by their place."""
    inner = warc.member(warc.record(5, "u", b"inner", None, False))
    noise = warc.MAGIC * 5 + bytes(range(256))
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = stored.compress(warc.record(6, "u", noise + inner + noise, None, False)) + stored.flush()
    data = outer + warc.member(warc.record(7, "u", b"last", None, False))
    whole = list(warc.Range(Memory(data), 0, len(data)))
    assert [warc._described(d)[0] for _, _, d in whole] == [6, 7]
    parts = [x for at in range(0, len(data), 64) for x in warc.Range(Memory(data), at, min(at + 64, len(data)))]
    assert [warc._described(d)[0] for _, _, d in parts] == [6, 5, 7]
    reach, kept = 0, []
    for at, after, d in parts:
        if at >= reach:
            kept.append(warc._described(d)[0])
        reach = max(reach, after)
    assert kept == [6, 7]


def test_record_whose_size_does_not_end_in_zero():
    data = b"x" * (1 << 24)
    packed = warc.member(data)
    assert packed[-1] == 0 and gzip.decompress(packed) == data


def foreign(kind, block, **headers):
    lines = ["WARC/1.0"] + ([f"WARC-Type: {kind}"] if kind else []) + [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("split", [1 << 20, 150])
def test_archive_of_another_writer(spark, tmp_path, split):
    """Records without digests, ids, types or lengths, and of types that are no pages."""
    page = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hello</p>"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    http = "application/http; msgtype=response"
    given = "sha1:" + warc.base32_sha1(b"abc")
    records = [
        foreign("warcinfo", b"software: x", Content_Type="application/warc-fields", Content_Length=11),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", Content_Type="application/http; msgtype=request", Content_Length=27),
        foreign("response", page, Content_Type=http, Content_Length=len(page), WARC_Target_URI="http://a/"),
        foreign("response", chunked, Content_Type=http, Content_Length=len(chunked), WARC_Payload_Digest=given),
        foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", Content_Type=http, Content_Length=19, WARC_Refers_To="<urn:uuid:1>"),
        foreign("resource", b"plain", Content_Length=5, WARC_Payload_Digest="md5:00"),
        foreign(None, b"no length"),
    ]
    path = tmp_path / "foreign.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r) for r in records))
    got = warc.read(spark, str(path), split, with_payload=True).collect()
    sha = warc.base32_sha1
    assert sorted((tuple(r) for r in got), key=str) == sorted([
        (None, None, 11, sha(b"software: x"), "warcinfo", None, b"software: x"),
        (None, None, 0, sha(b""), "request", None, b""),
        (None, "http://a/", 12, sha(b"<p>hello</p>"), "response", None, b"<p>hello</p>"),
        (None, None, len(b"3\r\nabc\r\n0\r\n\r\n"), given[5:], "response", None, b"3\r\nabc\r\n0\r\n\r\n"),
        (None, None, None, None, "revisit", None, None),
        (None, None, 5, "md5:00", "resource", None, b"plain"),
        (None, None, 9, sha(b"no length"), None, None, b"no length"),
    ], key=str)
    narrow = warc.read(spark, str(path), split).collect()
    assert sorted((tuple(r) for r in narrow), key=str) == sorted((tuple(r)[:-1] for r in got), key=str)


@pytest.mark.parametrize("split", [1 << 20, 64, 50])
def test_nested_archive_in_ranges(spark, tmp_path, split):
    inner = warc.member(warc.record(5, "u", b"inner" * 40, None, False))
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = stored.compress(warc.record(6, "u", inner * 3, None, False)) + stored.flush()
    path = tmp_path / "nested.warc.gz"
    path.write_bytes(outer + warc.member(warc.record(7, "u", b"last", None, False)))
    for with_payload in (False, True):
        assert sorted(r["page_id"] for r in warc.read(spark, str(path), split, with_payload).collect()) == [6, 7]


def test_a_wrong_digest_is_an_error():
    data = foreign("response", b"x", Content_Length=1, WARC_Payload_Digest="sha1:" + warc.base32_sha1(b"y"))
    with pytest.raises(ValueError):
        warc._described(data)
