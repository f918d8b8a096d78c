import glob
import gzip
import hashlib
import zlib

import pytest

from tickforge.llm import warc as W

DDL = "page_id long, url string, html string, digest string"


def pages(spark):
    big, other = "<p>" + "same " * 40 + "</p>", "<p>é" + "other " * 40
    rows = [(5, "http://a/5", big), (3, "http://a/3", big), (9, None, big), (1, "http://a/ü b", other), (2, "u", "small"), (4, "u", "small"),
            (6, "u", None), (7, "u", ""), (8, "u\r\nWARC-Type: x", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (3, "http://a/3", big), (None, None, big), (10, "u", "x" * 300_000)]
    return spark.createDataFrame([(*r, "own") for r in rows], DDL)


def expected(rows):
    out = []
    payloads = [((r["html"] or "").encode(), r["page_id"]) for r in rows]
    for data in {p for p, _ in payloads}:
        ids = sorted((i for p, i in payloads if p == data), key=lambda i: (i is None, i or 0))
        for n, i in enumerate(ids):
            again = n > 0 and len(data) >= 100
            out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


def test_round_trip_with_equal_null_and_repeated_payloads(spark, tmp_dir):
    df = pages(spark).repartition(3)
    index = W.archive_pages(spark, df, tmp_dir)
    got = W.read_records(index, f"{tmp_dir}/warc").collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == expected(pages(spark).collect())
    bodies = {r["payload_digest"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert all(hashlib.sha256(b).hexdigest() == d for d, b in bodies.items())


def members(path):
    data, n = open(path, "rb").read(), 0
    while data:
        engine = zlib.decompressobj(31)
        engine.decompress(data)
        data, n = engine.unused_data, n + 1
    return n


def test_one_stream_becomes_a_member_per_record_with_a_sidecar(spark, tmp_dir):
    index = W.archive_pages(spark, pages(spark).coalesce(1), tmp_dir)
    (raw,), (out,) = glob.glob(f"{tmp_dir}/raw/part-*"), glob.glob(f"{tmp_dir}/warc/part-*.gz")
    assert members(raw) == 1 and members(out) == 12
    assert len(open(f"{out}.idx").read().splitlines()) == 12
    one = index.where("page_id = 10").first()
    with open(out, "rb") as f:
        f.seek(one["offset"])
        assert gzip.decompress(f.read(one["length"])).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_truncated_archive_raises(tmp_dir):
    data = gzip.compress(W.record_bytes("response", [], b"x" * 1000))
    path = f"{tmp_dir}/cut.gz"
    open(path, "wb").write(data[: len(data) // 2])
    with open(path, "rb") as f, pytest.raises(ValueError, match="truncated"):
        list(W.inflate(f))
    reader = W.RecordReader()
    whole = gzip.decompress(data)
    assert list(reader.feed(whole[:500])) == []
    with pytest.raises(ValueError, match="inside a record"):
        reader.finish()
    assert len(list(reader.feed(whole[500:]))) == 1


def test_several_members_and_small_pieces(tmp_dir):
    records = [W.record_bytes("response", [("N", str(i))], bytes([65 + i]) * i) for i in range(20)]
    path = f"{tmp_dir}/many.gz"
    open(path, "wb").write(b"".join(map(W.member, records)))
    reader, found = W.RecordReader(), []
    with open(path, "rb") as f:
        for piece in W.inflate(f):
            for i in range(0, len(piece), 7):
                found += list(reader.feed(piece[i : i + 7]))
    reader.finish()
    assert [len(p) for _, p in found] == list(range(20))


def test_empty_table(spark, tmp_dir):
    index = W.archive_pages(spark, spark.createDataFrame([], DDL), tmp_dir)
    assert W.read_records(index, f"{tmp_dir}/warc").count() == 0
