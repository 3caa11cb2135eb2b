import hashlib
import io

import pytest

from pricelens.llm import warc
from pricelens.session import scratch_path


def record(payload=b"hello", **k):
    return warc.record_bytes("urn:x:1", "http://a/ b", payload, hashlib.sha256(payload).hexdigest(), k.get("refers"))


@pytest.mark.parametrize("chunk", [1, 7, 65536])
def test_stream_round_trip(chunk):
    payloads = [b"", b"\r\n\r\n", b"x" * 200_000, "ünï".encode()]
    archive = io.BytesIO(b"".join(record(p) for p in payloads) + record(b"z" * 300, refers="urn:x:9"))
    found = list(warc.read_records(archive, with_payload=True, chunk=chunk))
    assert [r["payload"] for r in found[:-1]] == payloads
    assert [r["payload_bytes"] for r in found] == [*map(len, payloads), 300]
    assert (found[-1]["record_type"], found[-1]["refers_to"], found[-1]["payload"]) == ("revisit", "urn:x:9", b"")


def test_damage_is_noticed():
    import zlib

    whole = zlib.decompress(record(), wbits=31)
    for bad in (whole.replace(b"hello", b"hullo"), whole.replace(b"\r\n\r\n", b"\r\n\r\nx", 1), whole[:-4], whole + b"more", whole.replace(b"Content-Length: 5\r\n\r\nh", b"Content-Length: 6\r\n\r\nh")):
        packer = zlib.compressobj(wbits=31)
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(packer.compress(bad) + packer.flush())))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(record()[:-9])))


def test_pages_cases(spark):
    long = "p" * 150
    pages = spark.createDataFrame(
        [(3, "http://a", long, 1), (2, "http://b", long, 1), (9, None, long, 1), (4, "u", None, 1), (5, "u", "short", 1), (6, "u", "short", 1), (None, "u", long, 1), (7, "u", "é" * 60, 1), (7, "u", "é" * 60, 1), (8, "u", "v" * 3_000_000, 1)],
        "page_id long, url string, html string, digest int",
    )
    rows = warc.round_trip(pages).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows), key=str)
    want = [(2, 150, "response", None), (3, 150, "revisit", 2), (9, 150, "revisit", 2), (None, 150, "revisit", 2), (4, 0, "response", None)]
    want += [(5, 5, "response", None), (6, 5, "response", None), (7, 120, "response", None), (7, 120, "response", None), (8, 3_000_000, "response", None)]
    assert got == sorted(want, key=str)
    assert {r["payload_digest"] for r in rows if r["payload_bytes"] == 150} == {hashlib.sha256(long.encode()).hexdigest()}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_have_a_bounded_size(spark):
    pages = spark.range(50).selectExpr("id as page_id", "'u' as url", "repeat(sha2(cast(id as string), 256), 40) as html")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.plan_records(pages), folder, archive_bytes=5000)
    assert manifest.count() > 5 and manifest.agg({"records": "sum"}).first()[0] == 50
    assert warc.read_archives(manifest, folder).select("record_id").distinct().count() == 50
