"""Sources over files as objects: landed-file listings, manifest documents,
exchange klines and zipped trade archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..schema import KLINE_VALUE_COLUMNS, MANIFEST_SCHEMA, TRADE_SCHEMA
from ..session import ensure_utc, shared_dir


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modificationTime) of files under ``path``; contents are
    not read because the ``content`` column is never selected."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )


LISTING_DDL = "path string, modificationTime timestamp, length long, content binary"


def update_listing(spark: SparkSession, path: str, ledger: str, glob: str = "*") -> DataFrame:
    """(path, length, modificationTime) of all files that were ever found under ``path``, from a ledger.

    A file-source stream that ends when it has seen what is there finds the files its checkpoint
    does not know and appends them to the ledger, exactly once even if a run is broken off
    and repeated.  Contents are not read.  Files that go stay in the ledger.
    """
    stream = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_DDL)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    root = ledger.rstrip("/")
    writing = stream.writeStream.format("parquet").option("path", f"{root}/files").option("checkpointLocation", f"{root}/checkpoint")
    writing.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("path string, length long, modificationTime timestamp").parquet(f"{root}/files")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest JSON documents (market, start, end, entries[date, symbol, url])."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)


def write_manifest(document: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One file per document, as ``read_manifest`` expects them."""
    document.write.mode(mode).option("maxRecordsPerFile", 1).json(path)
    return path


def read_klines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Exchange kline CSVs (header).  Columns are matched by each file's own header
    names, so files may order them differently or carry more; a file without a
    header line or without a needed column is an error that names it.  The
    symbol is the file name up to the first '-', open_time the epoch-millisecond
    bar start.

    Headers are one small row per file, joined to the lines by file.
    """
    ensure_utc(spark)
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path)
        .select(F.translate("value", '"', "").alias("line"), F.col("_metadata.file_path").alias("file"))
        .where(F.col("line") != "")
    )
    is_header = F.col("line").rlike(r"(^|,)\s*open_time\s*(,|$)")
    names = F.transform(F.split("line", ","), F.trim)
    places = []
    for c in ["open_time", *KLINE_VALUE_COLUMNS]:
        at = F.array_position(names, c).cast("int")
        places.append(F.when(at > 0, at).otherwise(F.raise_error(F.concat(F.lit(f"no column {c} in "), F.col("file"))).cast("int")).alias(c))
    headers = lines.where(is_header).groupBy("file").agg(F.first("line").alias("line")).select("file", F.struct(*places).alias("place"))
    rows = lines.where(~is_header).join(headers, "file", "left")
    place = F.coalesce("place", F.raise_error(F.concat(F.lit("no header line in "), F.col("file"))).cast(headers.schema["place"].dataType))
    rows = rows.select("file", F.split("line", ",").alias("v"), place.alias("place"))
    value = lambda c: F.trim(F.get("v", F.col(f"place.{c}") - 1))
    cols = [F.substring_index(N.file_name(F.col("file")), "-", 1).alias("symbol"), F.timestamp_millis(value("open_time").cast("long")).alias("open_time")]
    for c in KLINE_VALUE_COLUMNS:
        cols.append(F.nullif(value(c), F.lit("")).cast("bigint" if c == "count" else "double").alias(c))
    return rows.select(*cols)


LINES_SCHEMA = "archive string, member string, line_no long, line string, error string"


def archive_lines(spark: SparkSession, path: str, glob: str = "*.zip", chunk_bytes: int = 4 << 20) -> DataFrame:
    """Text lines of every CSV member of the zip archives under ``path``.

    The listing runs in Spark; each task opens its archives through
    ``pyarrow.fs`` (seekable, streamed), reads each once and emits its lines in chunks that
    Arrow splits.  Whether an archive is whole is known only at its end, where a row
    with ``error`` follows if it is not.  What the tasks emit is written to the shared
    folder, and there the lines of broken archives are left out: such an archive yields one
    row with ``error`` set and no lines.  Errors of the storage itself are raised, so
    that Spark tries the task again.  Non-zip files are ignored.
    """
    listing = list_files(spark, path, glob).select("path")

    def unzip(batches):
        import zipfile
        import zlib

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs as pafs

        names = ["archive", "member", "line_no", "line", "error"]

        def rows(archive, member, start, lines, error):
            n = len(lines)
            columns = [
                pa.array([archive] * n, pa.string()),
                pa.array([member] * n, pa.string()),
                pa.array(range(start, start + n), pa.int64()) if error is None else pa.nulls(n, pa.int64()),
                lines,
                pa.array([error] * n, pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        def lines_of(raw):
            """Arrow arrays of whole lines."""
            rest = b""
            while chunk := raw.read(chunk_bytes):
                body, found, tail = (rest + chunk).rpartition(b"\n")
                rest = tail if found else body + tail
                if found:
                    yield pc.utf8_rtrim(pc.list_flatten(pc.split_pattern(pa.array([body], pa.binary()).cast(pa.string()), "\n")), "\r")
            if rest:
                yield pc.utf8_rtrim(pa.array([rest], pa.binary()).cast(pa.string()), "\r")

        def members(fh, archive):
            with zipfile.ZipFile(fh) as zf:
                for member in zf.namelist():
                    start = 0
                    with zf.open(member) as raw:
                        if not member.lower().endswith(".csv"):
                            while raw.read(chunk_bytes):  # for its checksum
                                pass
                            continue
                        for lines in lines_of(raw):
                            yield rows(archive, member, start, lines, None)
                            start += len(lines)

        for batch in batches:
            for archive in batch.column("path").to_pylist():
                filesystem, p = pafs.FileSystem.from_uri(archive)
                with filesystem.open_input_file(p) as fh:
                    try:
                        yield from members(fh, archive)
                    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, pa.ArrowInvalid) as exc:
                        # What the bytes say; a file too short to hold an archive gives ArrowInvalid.
                        yield rows(archive, None, 0, pa.nulls(1, pa.string()), f"{type(exc).__name__}: {exc}")

    out = shared_dir(spark, "archive-lines")
    listing.mapInArrow(unzip, LINES_SCHEMA).write.parquet(out)
    read = spark.read.schema(LINES_SCHEMA).parquet(out)
    broken = read.where(F.col("error").isNotNull())
    return read.join(broken.select("archive"), "archive", "left_anti").unionByName(broken)


def archive_status(lines: DataFrame) -> DataFrame:
    """Per archive: ok flag, error text and number of lines read."""
    return lines.groupBy("archive").agg(
        F.max("error").alias("error"),
        F.count("line").alias("lines"),
    ).select("archive", F.col("error").isNull().alias("ok"), "error", "lines")


def archive_trades(lines: DataFrame, header: bool = True) -> DataFrame:
    """Raw trade rows parsed JVM-side with ``from_csv`` from archive lines.

    With ``header`` the first line of each member is skipped.  A malformed line
    (wrong number of fields, or a field of another type) is dropped, as the CSV
    source does.  ``file_path`` is ``archive/member`` so file-name parsing sees
    the member's name.
    """
    body = lines.where(F.col("line").isNotNull() & (F.col("line") != ""))
    if header:
        body = body.where(F.col("line_no") > 0)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRADE_SCHEMA.fields)
    parsed = body.select(
        F.from_csv("line", f"{fields}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"),
        F.concat(F.col("archive"), F.lit("/"), F.col("member")).alias("file_path"),
    )
    return parsed.where(F.col("r._bad").isNull()).select("r.*", "file_path").drop("_bad")


def ingest_archives(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Zipped trade files -> raw trade rows + file_path (ready for ``prepare_trades``)."""
    return archive_trades(archive_lines(spark, path), header)
