"""Hard-negative mining by a residue-number-system product (method 11).

Components are integers.  Matrices of them are multiplied modulo several small primes
in float32: residues lie about zero and the inner dimension is cut so that each sum
stays below 2**24, where float32 is exact.  As many primes are taken as the product of
the vectors' lengths demands (no score can be greater), and Chinese remaindering with
digits about zero gives the exact signed scores.

Anchors and rows are dealt into blocks, and each pair of blocks is a unit of work: one
group of rows streams past one block of anchors.  A unit keeps the best few rows per
anchor and window of scores, and a window function takes the best of all units.  The
first pass finds the positives, the second the negatives within their windows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, to_workers, work_dir

#: Primes whose residues about zero keep 64 products within float32's exact integers; together
#: they exceed 2**64.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
EXACT = 1 << 24
#: A row's squared length stays below this, so that every score is a long.
LENGTH = 2.0**61
#: Anchors of a block, and rows of a group at most; scores computed at a time.
ANCHORS, ROWS, SCORES = 8192, 1 << 16, 1 << 21


def residue_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of integer matrices (rows are vectors) with scores below 2**62."""
    length = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
    bound, product, primes = 2 * (length(a) * length(b) * (1 + 1e-9) + 1), 1, []
    for p in PRIMES:
        if product > bound:
            break
        primes.append(p)
        product *= p
    digits = []
    for p in primes:
        half, step = p // 2, max(1, (EXACT - 1) // (p // 2) ** 2)
        left, right = (((x % p + half) % p - half).astype(np.float32) for x in (a, b))
        total = np.zeros((len(a), len(b)), np.float32)
        for k in range(0, a.shape[1], step):
            total = np.remainder(total + np.remainder(left[:, k : k + step] @ right[:, k : k + step].T, p), p)
        digits.append(total.astype(np.int64))
    # Mixed radix: score = d0 + d1 p0 + d2 p0 p1 + ..., each digit about zero.  Products wrap at
    # 2**64, but the score itself does not.
    score, weight = np.zeros((len(a), len(b)), np.int64), 1
    for i, p in enumerate(primes):
        digit = (digits[i] - score % p) * pow(weight, -1, p) % p
        digit[digit > p // 2] -= p
        with np.errstate(over="ignore"):
            score += digit * np.int64(weight)
        weight *= p
    return score


def best(slot, score, ids, k: int) -> np.ndarray:
    """Positions of the ``k`` first entries of each slot: greater scores first, then smaller ids."""
    order = np.lexsort((ids, -score, slot))
    slots = slot[order]
    first = np.r_[True, slots[1:] != slots[:-1]] if len(slots) else np.zeros(0, bool)
    rank = np.arange(len(slots)) - np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))
    return order[rank < k]


class Held:
    """The first ``k`` rows of each slot, an anchor and a window [low, high] of scores."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.least = low.copy()
        self.slot = self.score = self.id = np.zeros(0, np.int64)

    def offer(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray, allowed=None) -> None:
        """Scores (slots x rows) against what is held."""
        ok = (score >= self.least[slots][:, None]) & (score <= self.high[slots][:, None])
        if allowed is not None:
            ok &= allowed
        i, j = np.nonzero(ok)
        if not len(i):
            return
        parts = (self.slot, slots[i]), (self.score, score[i, j]), (self.id, ids[j])
        slot, score, ids = (np.concatenate(x) for x in parts)
        keep = best(slot, score, ids, self.k)
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = np.flatnonzero(np.bincount(self.slot, minlength=len(self.low)) == self.k)
        last = np.searchsorted(self.slot, full, "right") - 1
        self.least[full] = self.score[last]


def _component(x: Column, scale: int) -> Column:
    return x.cast("double") * scale


def prepare(vectors: DataFrame, label: Column, anchor: Column, scale: int = 256) -> DataFrame:
    """(id, label, dim, anchor, vec) of the rows that take part: id and label not null, vector not
    null, no null or non-finite component, and a squared length below LENGTH once components are
    floor(scale * x)."""
    src = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col("embedding").alias("e"))
    small = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(_component(x, scale)) < LENGTH)
    src = src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & F.forall("e", small))
    whole = src.withColumn("v", F.transform("e", lambda x: F.floor(_component(x, scale)).cast("double")))
    fits = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) < LENGTH
    return whole.where(fits).select("id", "label", F.size("v").alias("dim"), "anchor", F.transform("v", lambda x: x.cast("long")).alias("vec"))


def _blocks(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, alike: bool) -> DataFrame:
    """Rows and anchors, once per unit (dim, group, block); anchors come first and carry their
    slots.  Rows are dealt by their place in the stored files, so that no key makes a group
    large, and sorted by label within a unit if only equal labels meet."""
    blocks = max(1, -(-n_anchors // ANCHORS))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-n_rows // ROWS), -(-tasks // blocks))
    dealt = F.xxhash64("_file", "_row")
    none = F.array().cast("array<long>")
    left = anchors.select("id", "label", "dim", "vec", "low", "high", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(0).alias("side"))
    right = rows.select("id", "label", "dim", "vec", none.alias("low"), none.alias("high"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(dealt, F.lit(groups)).cast("int").alias("group"), F.lit(1).alias("side"))
    every = left.unionByName(right).repartition(groups * blocks, "dim", "group", "block")
    return every.sortWithinPartitions("dim", "group", "block", "side", *(["label"] if alike else []))


def _search(units: DataFrame, k: int, alike: bool) -> DataFrame:
    """(anchor_id, low, high, score, id): per slot of an anchor, the first ``k`` rows of a unit
    whose label is the anchor's (``alike``) or another, the anchor's own id left out."""

    def run(batches):
        import pyarrow as pa

        def matrix(t, dim):
            return t.column("vec").combine_chunks().flatten().to_numpy().reshape(t.num_rows, dim)

        def emit(anchors, held):
            ids, lows, highs = (anchors[c] for c in ("slot_id", "low", "high"))
            s = held.slot
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[s], lows[s], highs[s], held.score, held.id)], ["anchor_id", "low", "high", "score", "id"])

        def anchors_of(t, dim):
            low = t.column("low").combine_chunks()
            size = np.diff(low.offsets.to_numpy())
            ids = t.column("id").to_numpy()
            own = np.repeat(np.arange(t.num_rows), size)
            names = t.column("label").to_pylist()
            code = {name: i for i, name in enumerate(dict.fromkeys(names))}
            out = {"vec": matrix(t, dim), "id": ids, "own": own, "slot_id": ids[own], "low": low.flatten().to_numpy(), "high": t.column("high").combine_chunks().flatten().to_numpy(), "code": code}
            out["label"] = np.array([code[x] for x in names], np.int64)
            return out, Held(out["low"], out["high"], k)

        def meet(anchors, held, t, dim):
            vec, ids = matrix(t, dim), t.column("id").to_numpy()
            label = np.array([anchors["code"].get(x, -1) for x in t.column("label").to_pylist()], np.int64)
            cells = max(1, SCORES // max(1, len(ids)))
            if alike:
                pairs = [(np.flatnonzero(anchors["label"] == c), np.flatnonzero(label == c)) for c in np.unique(label[label >= 0])]
            else:
                pairs = [(np.arange(len(anchors["id"])), np.arange(len(ids)))]
            for a, b in pairs:
                for s in range(0, len(a), cells):
                    part = a[s : s + cells]
                    score = residue_product(anchors["vec"][part], vec[b])
                    slots = np.flatnonzero((anchors["own"] >= part[0]) & (anchors["own"] <= part[-1]) & np.isin(anchors["own"], part))
                    at = np.searchsorted(part, anchors["own"][slots])
                    other = anchors["id"][part][:, None] != ids[b][None, :]
                    if not alike:
                        other &= anchors["label"][part][:, None] != label[b][None, :]
                    for first in range(0, len(slots), cells):
                        held.offer(slots[first : first + cells], score[at[first : first + cells]], ids[b], other[at[first : first + cells]])

        unit, waiting, state = None, [], None
        for t in _unit_parts(batches):
            key = tuple(t.column(c)[0].as_py() for c in ("dim", "group", "block"))
            if key != unit:
                if state is not None:
                    yield emit(*state)
                unit, waiting, state = key, [], None
            if t.column("side")[0].as_py() == 0:
                waiting.append(t)
                continue
            if waiting:
                state, waiting = anchors_of(pa.concat_tables(waiting), key[0]), []
            if state is not None:
                meet(*state, t, key[0])
        if state is not None:
            yield emit(*state)

    return to_workers(units, run, "anchor_id long, low long, high long, score long, id long")


def _unit_parts(batches):
    """Tables of rows of one unit and side, no more than a batch each."""
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(t.num_rows - 1, bool)
        for c in ("dim", "group", "block", "side"):
            values = t.column(c).to_numpy()
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), t.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield t.slice(a, b - a)


def hard_negatives(
    spark: SparkSession, vectors: DataFrame, label: Column, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    The score of two rows is the inner product of their components floor(scale * x), an
    integer.  An anchor's positives are its first rows of the same label, its
    negatives to a positive the first rows of another label with
    low * positive_score <= 100 * negative_score <= high * positive_score (percentages, 0 to 100).
    Greater scores come first, then smaller ids.

    Rows without id, label or vector, with a null or non-finite component, or so long that a
    score might be no long (squared length of 2**61 and more) take no part.  Only
    vectors of equal length meet; empty ones score 0.  Rows that repeat an id are candidates one
    by one, but never to an anchor of that id; of anchors that repeat an id, the one with the
    least label and vector counts.  An empty table gives no rows.
    """
    path = work_dir(spark, "hard-negatives")
    rows = stored(prepare(vectors, label, anchor, scale), f"{path}/rows")
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    some = rows.where("anchor").groupBy("id").agg(F.min(F.struct("label", "vec", "dim")).alias("r")).select("id", "r.*")
    some = stored(some, f"{path}/anchors")
    n_rows, n_anchors = rows.count(), some.count()

    least, most = -(1 << 62), 1 << 62
    seeking = some.withColumn("low", F.array(F.lit(least))).withColumn("high", F.array(F.lit(most)))
    near = _search(_blocks(rows, seeking, n_rows, n_anchors, True), positives, True)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = near.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= positives)
    near = stored(near.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "_r"), f"{path}/positives")

    windows = near.withColumn("low", -_share(low, -F.col("positive_score"))).withColumn("high", _share(high, F.col("positive_score")))
    windows = windows.where(F.col("low") <= F.col("high"))
    slots = windows.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("w"))
    seeking = some.join(slots, "id").select("*", F.col("w.low").alias("low"), F.col("w.high").alias("high")).drop("w")
    far = _search(_blocks(rows, seeking, n_rows, n_anchors, False), negatives, False)
    first = Window.partitionBy("anchor_id", "low", "high").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    far = far.select("anchor_id", "low", "high", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return windows.join(far, ["anchor_id", "low", "high"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _share(percent: int, score: Column) -> Column:
    """percent * score / 100, rounded down, without leaving a long."""
    rest = F.pmod(score, F.lit(100))
    return percent * F.call_function("div", score - rest, F.lit(100)) + F.call_function("div", percent * rest, F.lit(100))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(spark, table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0)


ORACLE = """
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
