"""Raw trade files as an exchange publishes them: ``{symbol}-trades-{date}.csv``
(optionally zipped).  Used to land test fixtures derived from tables.

Each task streams its Arrow batches into one file per (symbol, date) it sees,
named with the task's partition id, so memory stays at one batch.  A file is
written under an attempt-specific temporary name and moved into place when
complete, so a retried or speculative attempt never leaves a torn file and
the last finished attempt wins.  Paths go through ``pyarrow.fs`` so a shared
filesystem URI works as well as a local folder.
"""

from __future__ import annotations

import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import RAW_TRADE_COLUMNS

FILE_SCHEMA = "file string, rows long"


def _fs(root: str):
    from pyarrow import fs as pafs

    filesystem, base = pafs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    return filesystem, base.rstrip("/")


def write_csv_files(df: DataFrame, root: str, stem: Column, columns: list[str], header: bool = True, archive: bool = False) -> DataFrame:
    """Writes ``columns`` of ``df`` as CSV files named ``{stem}-p{task}.csv``
    (or ``.zip`` holding that CSV), one per stem value per task.

    Rows are clustered by stem (AQE splits a stem that is too large for one
    task), so the number of files does not follow the number of input tasks, and
    sorted by stem inside each task, so one file is open at a time and memory
    stays at one Arrow batch.  Returns a DataFrame (file, rows) listing what was
    written; the write runs when that DataFrame is evaluated (``land`` does).
    """

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part, attempt = ctx.partitionId(), ctx.attemptNumber()
        filesystem, base = _fs(root)
        filesystem.create_dir(base, recursive=True)
        names, rows = [], []
        state = {"key": None, "raw": None, "zip": None, "member": None, "tmp": None, "final": None}

        def close():
            if state["member"] is not None:
                state["member"].close()
                state["zip"].close()
            if state["raw"] is not None:
                state["raw"].close()
                filesystem.move(state["tmp"], state["final"])
            state.update(key=None, raw=None, zip=None, member=None, tmp=None, final=None)

        for pdf in batches:
            for key, grp in pdf.groupby("_stem", sort=False):
                name_stem = f"{key}-p{part:05d}"
                first = state["key"] != name_stem
                if first:
                    close()
                    name = f"{name_stem}.zip" if archive else f"{name_stem}.csv"
                    final = f"{base}/{name}"
                    tmp = f"{base}/.{name}.attempt-{attempt}.tmp"
                    raw = filesystem.open_output_stream(tmp)
                    state.update(key=name_stem, raw=raw, tmp=tmp, final=final)
                    if archive:
                        zf = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                        state.update(zip=zf, member=zf.open(f"{name_stem}.csv", "w"))
                    names.append(name)
                    rows.append(0)
                text = grp[columns].to_csv(index=False, header=header and first, lineterminator="\n").encode()
                (state["member"] or state["raw"]).write(text)
                rows[-1] += len(grp)
        close()
        if names:  # an empty task writes nothing and reports nothing
            yield pd.DataFrame({"file": pd.Series(names, dtype="object"), "rows": pd.Series(rows, dtype="int64")})

    src = df.select(stem.alias("_stem"), *[F.col(c).cast("string").alias(c) for c in columns]).where(F.col("_stem").isNotNull())
    return src.hint("rebalance", "_stem").sortWithinPartitions("_stem").mapInPandas(write, FILE_SCHEMA)


def land(written: DataFrame) -> None:
    """Runs a file write without bringing its listing to the driver."""
    written.write.format("noop").mode("overwrite").save()


def write_trade_files(df: DataFrame, root: str, header: bool = True, archive: bool = False) -> DataFrame:
    """Raw trade rows (``symbol``, ``date`` + raw columns) as ``{symbol}-trades-{date}`` files."""
    stem = F.concat(F.col("symbol"), F.lit("-trades-"), F.col("date").cast("string"))
    return write_csv_files(df, root, stem, RAW_TRADE_COLUMNS, header, archive)


def write_chart_series(series: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Chart payloads as JSON, one directory per symbol (``symbol=...``), one
    record per (symbol, day) with its title, file stem and arrays."""
    series.write.mode(mode).partitionBy("symbol").json(path)
    return path
