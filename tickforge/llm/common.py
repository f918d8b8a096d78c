"""Helpers shared by the operators: tables, stored intermediate results, Arrow text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: ASCII white space, as a character class for Java, RE2 and Python regular expressions.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share."""
    return shared_dir(spark, name)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch: whole texts, sets and vectors are wide rows.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows, for the rest of the session: results are
    lazy, and the size counts when they run."""
    if not 0 < int(spark.conf.get(BATCH)) <= rows:
        spark.conf.set(BATCH, rows)


def to_workers(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` in small batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, and a lost
    executor costs a re-read instead of a recomputation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text column, null counting as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def text_buffers(column):
    """(bytes as uint8 array, int64 offsets) of an Arrow string column, null as empty.  The
    bytes are those of the batch, not a copy."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def row_chunks(offsets, limit: int):
    """(first, end) row ranges of at most ``limit`` bytes each; a longer row is alone."""
    import numpy as np

    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end
        first = end


def worker_cache(key, build):
    """``build()`` once per Python worker process and key, whose first part names the operator.
    Code is shipped by value, so module globals of this package do not outlive a
    task; a module entry does.  What another operator left is dropped."""
    import sys
    import types

    store = sys.modules.setdefault("_tickforge_worker_cache", types.ModuleType("_tickforge_worker_cache"))
    if getattr(store, "owner", None) != key[0]:
        store.owner, store.values = key[0], {}
        _give_back()
    if key not in store.values:
        store.values[key] = build()
    return store.values[key]


def _give_back() -> None:
    """Hands freed memory of a worker back to the system; workers live on between stages."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def key_runs(batches, names: list[str]):
    """For Arrow batches sorted by the named columns: (table, first row of each key), where
    all rows of a key are in one table.  A key that spans batches is held until its end."""
    import numpy as np
    import pyarrow as pa

    def starts(t):
        change = np.zeros(max(0, t.num_rows - 1), bool)
        for c in names:
            values = t.column(c).to_numpy()
            change |= values[1:] != values[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1])

    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        first = starts(held)
        if len(first) > 1:
            yield held.slice(0, int(first[-1])), first[:-1]
            held = held.slice(int(first[-1]))
    if held is not None:
        yield held, starts(held)


def pairs_within(sizes):
    """Index pairs (lesser, greater) within consecutive runs of the given sizes."""
    import numpy as np

    run = np.repeat(np.arange(len(sizes)), sizes)
    after = sizes[run] - 1 - (np.arange(len(run)) - (np.cumsum(sizes) - sizes)[run])
    left = np.repeat(np.arange(len(run)), after)
    return left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
