"""WARC archives and the normaliser of monolithic gzip files (method 2).

A crawler may write a whole archive as one gzip stream, in which no record can be
reached without inflating all before it.  The normaliser inflates such a file
once, as a stream, writes every record as a gzip member of its own and
records where it lies in a sidecar index, so that records can then be read one
by one.  Records whose payload another record holds become revisits of it.

Files are written under attempt-specific names and moved into place, so a
task that is run again leaves no torn file; paths go through ``pyarrow.fs``.
"""

from __future__ import annotations

import hashlib
import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, to_workers, work_dir

#: Smallest payload that is worth a revisit record, in bytes.
LEAST_REVISIT = 100
LEVEL = 6
READ = 1 << 20
#: Beyond so many files a task takes several.
MOST_TASKS = 20_000
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_DDL = "file string, ordinal long, offset long, length long, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long"


def _fs(root: str):
    from pyarrow import fs as pafs

    filesystem, base = pafs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
    return filesystem, base.rstrip("/")


def _name(value) -> str:
    """A header value on one line: anything but printable ASCII is percent-encoded."""
    from urllib.parse import quote

    return quote(value or "", safe=":/?#[]@!$&'()*+,;=%-._~")


def record_bytes(kind: str, headers: list[tuple[str, str]], payload: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def page_headers(page_id, ordinal: int, url, digest: str, size: int) -> list[tuple[str, str]]:
    return [
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}:{ordinal}>"),
        ("WARC-Target-URI", _name(url)),
        ("Content-Type", "text/html; charset=utf-8"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Payload-Length", str(size)),
    ]


class RecordReader:
    """Records (headers, payload) from inflated bytes that come in pieces.  Holds one record."""

    def __init__(self):
        self.buffer = bytearray()

    def feed(self, data: bytes):
        self.buffer += data
        at = 0
        while True:
            end = self.buffer.find(b"\r\n\r\n", at)
            if end < 0:
                break
            headers = self._headers(bytes(self.buffer[at:end]))
            size = int(headers["content-length"])
            if len(self.buffer) < end + 8 + size:
                break
            yield headers, bytes(self.buffer[end + 4 : end + 4 + size])
            at = end + 8 + size
        del self.buffer[:at]

    @staticmethod
    def _headers(raw: bytes) -> dict[str, str]:
        first, *lines = raw.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}

    def finish(self) -> None:
        if self.buffer:
            raise ValueError("archive ends inside a record")


def inflate(stream):
    """Bytes of a gzip file piece by piece, however many members it has."""
    engine, open_ = zlib.decompressobj(31), False
    while data := stream.read(READ):
        while data:
            open_ = True
            out = engine.decompress(data, READ)
            if out:
                yield out
            if engine.eof:
                data, engine, open_ = engine.unused_data, zlib.decompressobj(31), False
            else:
                data = engine.unconsumed_tail
    while open_ and (out := engine.decompress(engine.unconsumed_tail, READ)):
        yield out
    if open_ and not engine.eof:
        raise ValueError("truncated gzip stream")


def member(data: bytes) -> bytes:
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def write_monolithic(pages: DataFrame, root: str) -> DataFrame:
    """Writes (page_id, url, html) as response records, one gzip stream per task, and
    returns (file, ordinal, page_id, payload_digest, payload_bytes) of each record.

    Null html is an empty payload; null ids and urls are written empty.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        filesystem, base = _fs(root)
        name = f"part-{task.partitionId():06d}.warc.gz"
        part = f"{base}/.{name}.{task.taskAttemptId()}"
        out = engine = None
        ordinal = 0
        for batch in batches:
            rows: dict = {k: [] for k in ("ordinal", "page_id", "digest", "size")}
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                if out is None:
                    filesystem.create_dir(base, recursive=True)
                    out, engine = filesystem.open_output_stream(part, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                payload = (html or "").encode("utf-8", "replace")
                digest = hashlib.sha256(payload).hexdigest()
                out.write(engine.compress(record_bytes("response", page_headers(page_id, ordinal, url, digest, len(payload)), payload)))
                for k, v in zip(rows, (ordinal, page_id, digest, len(payload)), strict=True):
                    rows[k].append(v)
                ordinal += 1
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows["size"]), pa.string()), *arrays], ["file", "ordinal", "page_id", "payload_digest", "payload_bytes"])
        if out is not None:
            out.write(engine.flush())
            out.close()
            filesystem.move(part, f"{base}/{name}")

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return to_workers(src, run, "file string, ordinal long, page_id long, payload_digest string, payload_bytes long")


def plan_revisits(records: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds ``refers_to`` and ``revisit`` to records.

    Of equal payloads of at least ``least`` bytes the record with the smallest
    page_id (null last, then file and place) is the response.  The least record
    of a digest is found by a partial aggregate, so that copies of one payload
    do not meet in a task before they are few.
    """
    mine = F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("page_id"), F.col("file").alias("file"), F.col("ordinal").alias("ordinal"))
    large = records.where(F.col("payload_bytes") >= least)
    first = large.groupBy("payload_digest").agg(F.min(mine).alias("first"), F.count("*").alias("_n")).where(F.col("_n") > 1).drop("_n")
    joined = records.join(first, "payload_digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("payload_bytes") >= least) & (F.col("first") != mine)
    return joined.select("file", "ordinal", F.coalesce(revisit, F.lit(False)).alias("revisit"), F.when(revisit, F.col("first.page_id")).alias("refers_to"))


def by_file(rows: DataFrame) -> DataFrame:
    """Rows dealt by file into about as many tasks as there are files.  The rows are few bytes
    each but stand for a file's work, so tasks must not be merged by their size."""
    files = rows.select("file").distinct().count()
    return rows.repartition(max(1, min(files, MOST_TASKS)), "file")


def normalise(plan: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites each monolithic file of ``source`` with a gzip member per record, makes the
    records that ``plan`` (file, ordinal, revisit, refers_to) names revisits, writes a
    sidecar index (``<file>.idx``, a JSON object per line) and returns the index.

    A file is one task, as its one stream forces; memory is one record and the file's
    numbers of revisits.  A truncated or broken stream fails the task.
    """

    def run(key, group):
        import pyarrow as pa

        name = key[0].as_py()
        revisit = {o: r for o, v, r in zip(*(group.column(c).to_pylist() for c in ("ordinal", "revisit", "refers_to")), strict=True) if v}
        filesystem, base = _fs(source)
        _, goal = _fs(target)
        from pyspark import TaskContext

        mark = TaskContext.get().taskAttemptId()
        filesystem.create_dir(goal, recursive=True)
        part, side = f"{goal}/.{name}.{mark}", f"{goal}/.{name}.idx.{mark}"
        index, at, ordinal, reader = [], 0, 0, RecordReader()
        with filesystem.open_input_stream(f"{base}/{name}", compression=None) as stream, filesystem.open_output_stream(part, compression=None) as out:
            for piece in inflate(stream):
                for headers, payload in reader.feed(piece):
                    page = headers["warc-record-id"].split(":")[2]
                    kind, refers_to = headers["warc-type"], None
                    kept = [(k, headers[k.lower()]) for k in ("WARC-Record-ID", "WARC-Target-URI", "Content-Type", "WARC-Payload-Digest", "WARC-Payload-Length")]
                    if ordinal in revisit:
                        kind, refers_to, payload = "revisit", revisit[ordinal], b""
                        kept += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
                    data = member(record_bytes(kind, kept, payload))
                    out.write(data)
                    index.append(
                        {
                            "file": name,
                            "ordinal": ordinal,
                            "offset": at,
                            "length": len(data),
                            "page_id": int(page) if page else None,
                            "record_type": kind,
                            "payload_digest": headers["warc-payload-digest"].partition(":")[2],
                            "payload_bytes": int(headers["warc-payload-length"]),
                            "refers_to": refers_to,
                        }
                    )
                    at += len(data)
                    ordinal += 1
        reader.finish()
        with filesystem.open_output_stream(side, compression=None) as out:
            out.write("".join(json.dumps(x) + "\n" for x in index).encode())
        filesystem.move(part, f"{goal}/{name}")
        filesystem.move(side, f"{goal}/{name}.idx")
        kinds = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.int64()]
        names = [x.split(" ")[0] for x in INDEX_DDL.split(", ")]
        return pa.table([pa.array([x[n] for x in index], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return by_file(plan).groupBy("file").applyInArrow(run, INDEX_DDL)


def read_records(index: DataFrame, root: str) -> DataFrame:
    """Reads the records that ``index`` (file, offset, length) names from the archives, each
    by its place alone: page_id, record_type, payload_digest, payload_bytes, refers_to, payload.

    The digest of a response is computed from the bytes read and must be the one in its header.
    """

    def run(batches):
        import pyarrow as pa

        filesystem, base = _fs(root)
        handles: dict = {}
        for batch in batches:
            names = ("page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload")
            rows: dict = {k: [] for k in names}
            held = 0
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            emit = lambda: pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names)
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if name not in handles:
                    handles.clear()
                    handles[name] = filesystem.open_input_file(f"{base}/{name}")
                reader = RecordReader()
                ((headers, payload),) = reader.feed(zlib.decompress(handles[name].read_at(length, offset), 31))
                reader.finish()
                page, digest, size = headers["warc-record-id"].split(":")[2], headers["warc-payload-digest"].partition(":")[2], int(headers["warc-payload-length"])
                refers = headers.get("warc-refers-to", "<urn:page:>")[10:-1]
                if headers["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                    raise ValueError(f"{name} at {offset}: payload does not match its digest")
                values = (int(page) if page else None, headers["warc-type"], digest, size, int(refers) if refers else None, payload)
                for k, v in zip(names, values, strict=True):
                    rows[k].append(v)
                held += len(payload)
                if held > 4 * READ:
                    yield emit()
                    rows, held = {k: [] for k in names}, 0
            yield emit()

    schema = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
    return to_workers(by_file(index.select("file", "offset", "length")).sortWithinPartitions("file", "offset"), run, schema)


def archive_pages(spark: SparkSession, pages: DataFrame, root: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes pages to monolithic archives under ``root``/raw, normalises them into
    ``root``/warc with sidecar indexes, and returns the index (also ``root``/index, Parquet)."""
    records = stored(write_monolithic(pages, f"{root}/raw"), f"{root}/records")
    plan = stored(plan_revisits(records, least), f"{root}/plan")
    return stored(normalise(plan, f"{root}/raw", f"{root}/warc"), f"{root}/index")


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC and read back through the index.  Each row of pages gives one
    record; of rows that repeat id and payload one is the response."""
    root = work_dir(spark, "warc")
    index = archive_pages(spark, table(spark, sf_dir, "pages"), root)
    return read_records(index, f"{root}/warc").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, row_number() OVER w AS rk, first_value(page_id) OVER w AS least FROM p
      WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND rk > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND rk > 1 THEN least END AS refers_to
FROM r"""
