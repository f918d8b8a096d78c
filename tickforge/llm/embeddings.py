"""Embedding near-duplicates through a pivot-permutation index (method 5).

A vector is described by its nearest reference points (pivots) in order.  The
inverted lists are kept per pair of pivots among a vector's nearest, so two
vectors meet iff they share at least two of them; how many they share is
counted, and pairs that share enough are verified by cosine.

Equal vectors of a label are one class.  A list is compared block by block, and
only link counts and a spanning forest leave a block, never its pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import key_runs, pairs_within, stored, table, to_workers, work_dir
from .graph import connected_components

THRESHOLD = 0.98
#: Pivots per dimension, and how many sampled classes they are chosen from, which bounds
#: what reaches the driver.  Pivots lie apart: no two with a cosine of APART or more, so
#: that a dense cluster has one and its vectors agree on the others.
PIVOTS, SAMPLE, APART = 128, 1024, 0.9
#: Nearest pivots that describe a vector.
NEAREST = 6
#: A longer list is dealt into blocks of about this many classes.
BLOCK = 512
#: Runs of up to so many rows are compared together.
SHORT = 48


def _classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, class, label, vec) per row; class null if the row can link with nothing."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, vecs = [], []
            column = batch.column("embedding")
            for label, value in zip(batch.column("label").to_pylist(), column, strict=True):
                known = label is not None and value.values is not None and not value.values.null_count
                v = value.values.to_numpy() + 0.0 if known else np.zeros(0)
                if not (v.any() and np.isfinite(v).all()):
                    keys.append(None)
                    vecs.append(None)
                else:
                    keys.append(hashlib.blake2b(v.tobytes() + repr(label).encode(), digest_size=16).digest())
                    vecs.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), batch.column("label"), pa.array(vecs, pa.list_(pa.float64()))], ["vec_id", "class", "label", "vec"]
            )

    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    return to_workers(src, run, "vec_id long, class binary, label string, vec array<double>")


def _unit(rows) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps the squares in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame, pivots: int, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Unit vectors per dimension: of the classes with the smallest keys, which are hashes, the
    first ones that lie apart."""
    sized = classes.select("class", "vec", F.size("vec").alias("dim"))
    first = Window.partitionBy("dim").orderBy("class")
    rows = sized.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= sample).orderBy("dim", "_r").select("dim", "vec").collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(r["dim"], []).append(r["vec"])
    chosen = {}
    for d, rows in by_dim.items():
        units, taken = _unit(rows), []
        for i, u in enumerate(units):
            if len(taken) < pivots and not (taken and (units[taken] @ u >= APART).any()):
                taken.append(i)
        chosen[d] = units[taken]
    return chosen


def describe(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """Adds dim, ``near`` (a bit per pivot among the nearest, in 64-bit words) and ``keys``
    (the pairs of nearest pivots, lesser * count + greater)."""
    fixed = {d: p for d, p in pivots.items()}

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            values = batch.column("vec").to_pylist()
            dims = np.array([len(v) for v in values], np.int32)
            near, keys = [None] * len(values), [None] * len(values)
            for d in np.unique(dims):
                at, p = np.flatnonzero(dims == d), fixed[int(d)]
                k = min(nearest, len(p))
                order = np.argsort(-(_unit([values[i] for i in at]) @ p.T), axis=1, kind="stable")[:, :k]
                order.sort(axis=1)
                bits = np.zeros((len(at), -(-len(p) // 64)), np.uint64)
                for c in range(k):
                    np.bitwise_or.at(bits, (np.arange(len(at)), order[:, c] // 64), np.uint64(1) << (order[:, c] % 64).astype(np.uint64))
                i, j = np.triu_indices(k, 1) if k > 1 else (np.zeros(1, int), np.zeros(1, int))
                pairs = order[:, i] * len(p) + order[:, j]
                for n, row in enumerate(at):
                    near[row], keys[row] = bits[n].view(np.int64), pairs[n].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims), pa.array(near, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], [*batch.schema.names, "dim", "near", "keys"]
            )

    return to_workers(classes.select("class", "label", "n", "vec"), run, "class binary, label string, n long, vec array<double>, dim int, near array<long>, keys array<long>")


def _near_pairs(vec, low, high, own, first_rows, threshold: float):
    """Index pairs (i, j) of rows of the same run that reach the threshold; in a run of two
    blocks, one from each.  Short runs are compared pair by pair together, long ones as matrices."""
    sizes = np.diff(np.append(first_rows, len(vec)))
    short = sizes <= SHORT
    rows = np.flatnonzero(np.repeat(short, sizes))
    left, right = pairs_within(sizes[short])
    for s in range(0, max(1, len(left)), 1 << 13):
        i, j = rows[left[s : s + (1 << 13)]], rows[right[s : s + (1 << 13)]]
        ok = (low[i] == high[i]) | (own[i] != own[j])
        i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", vec[i], vec[j]) >= threshold
        yield i[ok], j[ok]
    for first, size in zip(first_rows[~short], sizes[~short], strict=True):
        run = np.arange(first, first + size)
        a = run[own[run] == low[first]]
        same = low[first] == high[first]
        b = a if same else run[own[run] == high[first]]
        i, j = np.nonzero(vec[a] @ vec[b].T >= threshold)
        if same:
            i, j = i[i < j], j[i < j]
        yield a[i], b[j]


def _linked(lists: DataFrame, pivots: dict[int, int], threshold: float, shared: int) -> DataFrame:
    """(class, n_links, root): per run and class, the vectors linked there and the least
    class that its links in the run reach.  A pair counts in the list of its two least shared pivots."""
    by = ["label", "dim", "key", "low", "high"]

    def links(t, first_rows):
        dim = t.column("dim")[0].as_py()
        cls = t.column("class").to_pylist()
        vec = _unit(t.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim))
        near = t.column("near").combine_chunks().flatten().to_numpy().reshape(len(cls), -1).view(np.uint64)
        low, high, own, key, weight = (t.column(c).to_numpy() for c in ("low", "high", "own", "key", "n"))
        i, j = (np.concatenate(x) for x in zip(*_near_pairs(vec, low, high, own, first_rows, threshold), strict=True))
        # In this list iff no pivot below the list's second one is shared but its first.
        n = pivots[dim]
        below = np.zeros((n + 1, near.shape[1]), np.uint64)
        for x in range(n):
            below[x + 1] = below[x]
            below[x + 1, x // 64] |= np.uint64(1) << np.uint64(x % 64)
        p, q = key[i] // n, key[i] % n
        both = near[i] & near[j]
        earlier = both & below[q]
        at = np.arange(len(i))
        earlier[at, p // 64] &= ~(np.uint64(1) << (p % 64).astype(np.uint64))
        ok = ~earlier.any(axis=1)
        if shared > 2:
            ok &= np.bitwise_count(both).sum(axis=1) >= shared
        i, j = i[ok], j[ok]
        count = np.zeros(len(cls), np.int64)
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        by_rank = sorted(range(len(cls)), key=cls.__getitem__)
        rank = np.empty(len(cls), np.int64)
        rank[by_rank] = np.arange(len(cls))
        while True:  # least rank along links
            least = rank.copy()
            np.minimum.at(least, i, rank[j])
            np.minimum.at(least, j, rank[i])
            if (least == rank).all():
                break
            rank = least
        some = np.flatnonzero(count)
        return [cls[x] for x in some], count[some], [cls[by_rank[rank[x]]] for x in some]

    def run(batches):
        import pyarrow as pa

        for t, first_rows in key_runs(batches, by):
            dims = t.column("dim").to_numpy()
            # Runs of one length of vectors at a time; a table holds several only where labels change.
            cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), t.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                got = links(t.slice(a, b - a), first_rows[(first_rows >= a) & (first_rows < b)] - a)
                if got[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.binary()), pa.array(got[1], pa.int64()), pa.array(got[2], pa.binary())], ["class", "n_links", "root"])

    return to_workers(lists.repartition(*[F.col(c) for c in by]).sortWithinPartitions(*by), run, "class binary, n_links long, root binary")


def near_duplicates(
    spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = 2
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, their lengths are
    equal and their cosine, in double precision, is at least ``threshold``.  Null,
    empty and zero vectors and those with a null or non-finite component link with
    nothing.  Rows with equal label and vector always link, repeated ids
    included.  component_id is the smallest non-null vec_id reachable; kept says
    vec_id = component_id, null-safe.  ``shared`` (2 or more) is the number of
    nearest pivots a pair must share to be verified.
    """
    path = work_dir(spark, "embeddings")
    rows = stored(_classes(vectors), f"{path}/rows")
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec")
    )
    classes = stored(classes, f"{path}/classes")
    points = choose_pivots(classes, pivots)
    index = stored(describe(classes, points, nearest), f"{path}/index")

    spread = index.select("class", "label", "dim", F.explode("keys").alias("key"))
    sizes = spread.groupBy("label", "dim", "key").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    blocks = sizes.select("label", "dim", "key", F.ceil(F.col("_n") / BLOCK).cast("long").alias("blocks"))
    placed = (
        spread.join(blocks, ["label", "dim", "key"])
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("class", "key", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    lists = placed.join(index.drop("keys"), "class")
    found = stored(_linked(lists, {d: len(p) for d, p in points.items()}, threshold, shared), f"{path}/found")

    labels = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b")), f"{path}/graph")
    counts = found.groupBy("class").agg(F.sum("n_links").alias("_links"))
    members = (
        classes.select("class", "vec_id", "n")
        .join(counts, "class", "left")
        .join(labels.select(F.col("node").alias("class"), "component"), "class", "left")
        .select("class", "vec_id", (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "class").alias("component"))
    )
    least = members.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = stored(members.join(least, "component").select("class", "n_links", "component_id"), f"{path}/named")
    linked = rows.where(F.col("class").isNotNull()).select("vec_id", "class").join(named, "class").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("class").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))
