"""Session helpers.

All time logic in this library follows the trade convention of UTC days: a
bar's day, the gap-fill grid and the ``bucket`` partition column are UTC
calendar days.  ``ensure_utc`` pins the session time zone so that casts
between TIMESTAMP and TIMESTAMP_NTZ and ``to_date`` agree with that.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(
    master: str = "local[*]",
    app_name: str = "tickforge",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and local runs.  On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "GMT", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


_MADE: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is read from the session.  Where
    none is named, a local session gets a folder of its own; on a cluster that would
    leave each executor's files on its own disk, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tickforge-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def remove_shared_dirs(spark: SparkSession) -> int:
    """Deletes the directories that ``shared_dir`` has named in this process, once nothing
    reads them any more; returns how many were there."""
    removed = 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
