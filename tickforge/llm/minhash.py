"""MinHash near-duplicates with tensored banding (method 4).

A document's set of word shingles is described by ``collections`` small groups
of ``rows`` minhashes each.  The keys of the hash tables are pairs of groups, so
m groups give m(m-1)/2 tables of 2 * rows minhashes while only m * rows
minhashes are computed.  Two sets meet in a table iff at least two of their
groups agree; candidates are then verified on the full sets.

Equal sets are one class throughout, so copies never meet each other.  A pair
of classes is found by a group they share: the classes of one group value are
brought together, the pair keys are formed there from the groups each carries
along, and the pair is taken at the first group it shares.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import NON_SPACE, WordHasher, mix64
from .common import key_runs, pairs_within, row_chunks, stored, table, text_buffers, to_workers, whole_text, work_dir, worker_cache
from .graph import connected_components

WORDS = 5
THRESHOLD = 0.8
COLLECTIONS = 20
#: Largest probability of missing a pair at the threshold that the rows are chosen for.
MISS = 0.004
#: A group value shared by more classes is compared block by block, each pair of blocks apart.
BLOCK = 512
#: A pair is verified unless its matching minhashes are so many standard errors below the threshold.
ERRORS = 3.7
#: Sets of at most so many shingles travel with their class in the last round.
AT_HAND = 512
#: Most slots of the filter that tells which documents to read again (16 MB of bits).
FILTER_BITS = 1 << 27
_U = np.uint64


def miss_probability(similarity: float, rows: int, collections: int) -> float:
    """Fewer than two of the groups agree."""
    p = similarity**rows
    return (1 - p) ** collections + collections * p * (1 - p) ** (collections - 1)


def rows_for(threshold: float, collections: int = COLLECTIONS, miss: float = MISS) -> int:
    """The most minhashes per group that still find pairs at the threshold."""
    return max([1, *(r for r in range(1, 17) if miss_probability(threshold, r, collections) <= miss)])


class Shingler:
    """Distinct word shingles of texts as sorted 64-bit hashes."""

    def __init__(self, words: int):
        rng = np.random.default_rng(11)
        self.hasher, self.words = WordHasher(NON_SPACE), words
        self.factor = rng.integers(1, 1 << 62, words, dtype=np.uint64) * _U(2) + _U(1)

    def sets(self, data, offsets):
        """One sorted array per row; empty for a row without words."""
        words, bounds = self.hasher(data, offsets)
        k, out = self.words, []
        whole = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for i in range(k):
            whole += words[i : len(words) - k + 1 + i] * self.factor[i] if len(whole) else 0
        whole = mix64(whole)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(whole[a : b - k + 1]))
            elif b > a:  # the whole sequence is the one shingle; its length keeps it apart from others
                out.append(mix64((words[a:b] * self.factor[: b - a]).sum(dtype=np.uint64, keepdims=True) + _U(b - a)))
            else:
                out.append(whole[:0])
        return out


class Signer:
    def __init__(self, rows: int, collections: int):
        rng = np.random.default_rng(23)
        n = rows * collections
        self.rows, self.collections = rows, collections
        self.flip = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.factor = rng.integers(1, 1 << 62, n, dtype=np.uint64) * _U(2) + _U(1)
        self.step = rng.integers(1, 1 << 62, rows, dtype=np.uint64) * _U(2) + _U(1)
        self.tag = rng.integers(1, 1 << 63, collections, dtype=np.uint64)

    def __call__(self, sets):
        """Of non-empty sets: group values (sets x collections, int64), minhash bytes (sets x all)."""
        flat = np.concatenate(sets)
        first = np.zeros(len(sets), np.int64)
        np.cumsum([len(s) for s in sets[:-1]], out=first[1:])
        least = np.empty((len(sets), len(self.flip)), np.uint64)
        for i, (x, a) in enumerate(zip(self.flip, self.factor, strict=True)):
            least[:, i] = np.minimum.reduceat((flat ^ x) * a, first)
        groups = least.reshape(len(sets), self.collections, self.rows)
        value = mix64((mix64(groups) * self.step).sum(axis=2, dtype=np.uint64) ^ self.tag)
        return value.view(np.int64), mix64(least).astype(np.uint8)


def set_key(shingles) -> bytes:
    """16 bytes that name a set."""
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _tools(words: int, rows: int, collections: int):
    return worker_cache(("minhash", words, rows, collections), lambda: (Shingler(words), Signer(rows, collections)))


def text_digest():
    """16 bytes that name a text, null counting as empty."""
    return F.unhex(F.md5(whole_text()))


def signatures(docs: DataFrame, words: int, rows: int, collections: int) -> DataFrame:
    """(doc_id, digest, n_shingles, class, groups, marks) per document; digest of the text,
    class null for an empty set."""

    def run(batches):
        import pyarrow as pa

        shingler, signer = _tools(words, rows, collections)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in row_chunks(offsets, 1 << 20):
                sets = shingler.sets(data, offsets[a : b + 1])
                some = [i for i, s in enumerate(sets) if len(s)]
                keys, groups, marks = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if some:
                    value, byte = signer([sets[i] for i in some])
                    for j, i in enumerate(some):
                        keys[i], groups[i], marks[i] = set_key(sets[i]), value[j], byte[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("digest").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(groups, pa.list_(pa.int64())),
                        pa.array(marks, pa.binary()),
                    ],
                    ["doc_id", "digest", "n_shingles", "class", "groups", "marks"],
                )

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), text_digest().alias("digest"))
    return to_workers(src, run, "doc_id long, digest binary, n_shingles long, class binary, groups array<long>, marks binary")


def slot_filter(ids: DataFrame, per_id: int = 16, most: int = FILTER_BITS):
    """(slots, bitmap) of the ids' hashed slots, at least ``per_id`` slots each up to
    ``most`` in all.  The bitmap is what is broadcast; its size is bounded by ``most`` / 8
    bytes, and beyond ids only share slots: more rows pass, none is lost."""
    slots = 1 << 16
    wanted = per_id * ids.count()
    while slots < min(wanted, most):
        slots *= 2
    slot = f"pmod(xxhash64(doc_id), {slots}L)"
    words = ids.select(F.expr(f"{slot} div 64").alias("word"), F.expr(f"shiftleft(1L, cast({slot} % 64 as int))").alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(slots // 64, np.int64)
    bitmap[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return slots, bitmap


def shingle_sets(docs: DataFrame, words: int, ids: DataFrame) -> DataFrame:
    """(class, shingles) of documents whose id may be among ``ids`` (or is null) and whose
    set is not empty; others only pass by, so that no text is shuffled."""
    slots, bitmap = slot_filter(ids.where(F.col("doc_id").isNotNull()))
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        import pyarrow as pa

        shingler, _ = _tools(words, 1, 1)
        for batch in batches:
            slot = batch.column("slot").to_numpy(zero_copy_only=False)
            wanted = np.isnan(slot) if slot.dtype.kind == "f" else np.zeros(len(slot), bool)
            at = np.where(wanted, 0, slot).astype(np.int64)
            wanted |= (bitmap.value[at // 64] >> (at % 64)) & 1 == 1
            column = batch.column("text").take(pa.array(np.flatnonzero(wanted)))
            data, offsets = text_buffers(column)
            for a, b in row_chunks(offsets, 1 << 20):
                sets = [s for s in shingler.sets(data, offsets[a : b + 1]) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["class", "shingles"],
                )

    slot = F.when(F.col("doc_id").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(slots)))
    return to_workers(docs.select("text", slot.alias("slot")), run, "class binary, shingles array<long>")


def _routed(classes: DataFrame) -> DataFrame:
    """Rows of classes at each group value they share with another class.  A value
    with many classes is dealt into blocks, and a class goes to all pairs of its block."""
    spread = classes.select("class", F.explode("groups").alias("value"))
    counts = spread.groupBy("value").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    blocks = F.ceil(F.col("_n") / BLOCK).cast("long")
    mine = spread.join(counts.select("value", blocks.alias("blocks")), "value")
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    return mine.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "class", "value", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )


class _Forest:
    """Union-find over a block, to leave out pairs whose ends are joined already."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[y] = x
        return x != y


def _candidates(rows: DataFrame, threshold: float, best_only: bool) -> DataFrame:
    """Pairs (a, b, sure) of classes from routed rows (value, low, high, own, class, n_shingles,
    groups, marks, label, shingles), each at its first shared group and at most once.

    A pair needs two shared groups (a table key), different labels, sizes that allow
    the threshold and enough equal minhashes.  With ``best_only`` each class of a
    block gives its best pair only.  Without it, a pair whose sets are both at
    hand (``shingles`` not null) is verified here, and only those that join
    parts of the block not joined yet come out, as sure.
    """
    percent = round(threshold * 100, 6)
    names = ["value", "low", "high"]

    def run(batches):
        import pyarrow as pa

        def candidates(t, first_rows):
            value, low, high, own, n = (t.column(c).to_numpy() for c in ("value", "low", "high", "own", "n_shingles"))
            label = np.array(t.column("label").to_pylist(), object)
            groups = t.column("groups").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
            marks = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint8).reshape(len(n), -1)
            left, right = pairs_within(np.diff(np.append(first_rows, len(n))))
            width = marks.shape[1]
            least = width * (threshold - ERRORS * (threshold * (1 - threshold) / width) ** 0.5)
            for s in range(0, max(1, len(left)), 1 << 15):  # once even without pairs
                i, j = left[s : s + (1 << 15)], right[s : s + (1 << 15)]
                ok = (label[i] != label[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
                ok &= np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])
                i, j = i[ok], j[ok]
                equal = groups[i] == groups[j]
                first = groups[i, equal.argmax(axis=1)]
                ok = (equal.sum(axis=1) >= 2) & (first == value[i])
                i, j = i[ok], j[ok]
                same = (marks[i] == marks[j]).sum(axis=1)
                ok = same >= least
                yield i[ok], j[ok], same[ok]

        def best(t, first_rows):
            i, j, same = (np.concatenate(x) for x in zip(*candidates(t, first_rows), strict=True))
            cls = np.array(t.column("class").to_pylist(), object)
            order = np.lexsort((cls[j], cls[i], same)) if len(i) else np.zeros(0, np.int64)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            top = np.full(len(cls), -1, np.int64)
            np.maximum.at(top, i, rank)
            np.maximum.at(top, j, rank)
            take = order[np.unique(top[top >= 0])]
            return [(cls[x], cls[y], False) for x, y in zip(i[take], j[take], strict=True)]

        def rest(t, first_rows):
            cls, label = t.column("class").to_pylist(), t.column("label").to_pylist()
            column = t.column("shingles").combine_chunks()
            have = column.is_valid().to_numpy(zero_copy_only=False)
            flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            forest, out = _Forest(), []
            for i, j, same in candidates(t, first_rows):
                for k in np.argsort(-same, kind="stable").tolist():
                    x, y = int(i[k]), int(j[k])
                    if not (have[x] and have[y]):
                        out.append((cls[x], cls[y], False))
                    elif forest.root(label[x]) != forest.root(label[y]):
                        p, q = flat[offsets[x] : offsets[x + 1]], flat[offsets[y] : offsets[y + 1]]
                        shared = len(p) + len(q) - len(np.unique(np.concatenate([p, q])))
                        if 100 * shared >= percent * (len(p) + len(q) - shared):
                            forest.join(label[x], label[y])
                            out.append((cls[x], cls[y], True))
            return out

        for t, first_rows in key_runs(batches, names):
            if t.num_rows > 1 and (found := (best if best_only else rest)(t, first_rows)):
                a, b, sure = zip(*[(min(x, y), max(x, y), z) for x, y, z in found], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(sure, pa.bool_())], ["a", "b", "sure"])

    dealt = rows.repartition(*[F.col(c) for c in names]).sortWithinPartitions(*names, "class")
    return to_workers(dealt, run, "a binary, b binary, sure boolean")


def _verified(pairs: DataFrame, sets: DataFrame, percent: float) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("_sb"))
    both = pairs.where(~F.col("sure")).join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_sa", "_sb"))
    union = F.size("_sa") + F.size("_sb") - shared
    checked = both.where(100 * shared >= F.lit(float(percent)) * union)
    return checked.select("a", "b").unionByName(pairs.where("sure").select("a", "b"))


def _components(spark: SparkSession, docs: DataFrame, threshold: float, words: int, collections: int, rows: int | None) -> DataFrame:
    """(doc_id, digest, n_shingles, component, component_id) per document; component is
    the smallest class reachable, null for an empty set."""
    percent = round(threshold * 100, 6)
    rows = rows or rows_for(threshold, collections)
    path = work_dir(spark, "minhash")
    signed = stored(signatures(docs, words, rows, collections), f"{path}/signed")
    classes = (
        signed.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("groups").alias("groups"), F.first("marks").alias("marks"))
    )
    # Only classes that share two group values can meet anyone.
    routes = _routed(classes.select("class", "groups"))
    routes = stored(routes, f"{path}/routes")
    meeting = routes.select("class", "value").distinct().groupBy("class").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("class")
    meeting = stored(classes.join(meeting, "class"), f"{path}/meeting")

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    sets = shingle_sets(text, words, meeting.select("doc_id"))
    sets = stored(sets.join(meeting.select("class"), "class", "left_semi").dropDuplicates(["class"]), f"{path}/sets")

    # Best pairs first: they join most of each group.
    about = meeting.select("class", "n_shingles", "groups", "marks")
    carried = routes.join(about.withColumns({"label": F.col("class"), "shingles": F.lit(None).cast("array<long>")}), "class")
    pairs = stored(_candidates(carried, threshold, True), f"{path}/pairs-best")
    first = stored(_verified(pairs, sets, percent), f"{path}/links-best")
    labels = connected_components(first, f"{path}/graph-best")

    # Then all pairs whose ends are still apart, where a group value holds any such.
    # Sets of moderate size go along, so that these pairs are verified where they meet.
    labelled = routes.join(labels.select(F.col("node").alias("class"), F.col("component").alias("label")), "class", "left").withColumn("label", F.coalesce("label", "class"))
    labelled = stored(labelled, f"{path}/labelled")
    open_values = labelled.groupBy("value").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l != _h").select("value")
    at_hand = sets.select("class", F.when(F.size("shingles") <= AT_HAND, F.col("shingles")).alias("shingles"))
    carried = labelled.join(open_values, "value", "left_semi").join(about.join(at_hand, "class"), "class")
    pairs = stored(_candidates(carried, threshold, False), f"{path}/pairs-rest")
    rest = stored(_verified(pairs, sets, percent), f"{path}/links-rest")
    labels = connected_components(first.unionByName(rest), f"{path}/graph-all")

    members = classes.select("class", "doc_id").join(labels.select(F.col("node").alias("class"), "component"), "class", "left")
    members = members.withColumn("component", F.coalesce("component", "class"))
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stored(members.join(least, "component").select("class", "component", "component_id"), f"{path}/named")
    full = signed.where(F.col("class").isNotNull()).select("doc_id", "digest", "n_shingles", "class").join(named, "class").drop("class")
    empty = signed.where(F.col("class").isNull()).select("doc_id", "digest", "n_shingles", F.lit(None).cast("binary").alias("component"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, collections: int = COLLECTIONS, rows: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Links documents whose shingle sets reach the Jaccard ``threshold``; a component
    holds all that links reach.  Null, empty and blank texts have an empty set and
    link with nothing; equal non-empty sets always link.  Rows that repeat an id
    with another text are in the component of their text.  component_id is the
    smallest non-null doc_id reachable (null if there is none); kept says doc_id =
    component_id, null-safe.
    """
    got = _components(spark, docs, threshold, words, collections, rows).select("doc_id", "n_shingles", "component_id")
    return got.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates, and all rows without words.

    The row with the smallest doc_id stays, one without an id only if none of the
    group has one; then the one with the smallest text digest, and one of rows that
    repeat both.
    """
    path = work_dir(spark, "near-keep")
    rows = _components(spark, docs, threshold, WORDS, COLLECTIONS, None)
    blank = rows.where(F.col("component").isNull()).select("doc_id", "digest").distinct().withColumn("n", F.lit(1).cast("long"))
    texts = rows.where(F.col("component").isNotNull()).groupBy("component", "doc_id", "digest").agg(F.count("*").alias("n"))
    least = texts.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "n")).alias("least"))
    kept = least.select("least.doc_id", "least.digest", "least.n").unionByName(blank)
    kept = stored(kept.select(F.col("doc_id").alias("_tf_id"), F.col("digest").alias("_tf_digest"), F.col("n").alias("_tf_n")), f"{path}/kept")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_tf_id")) & (text_digest() == F.col("_tf_digest"))
    once = docs.join(kept.where("_tf_n = 1"), same, "left_semi")
    repeated = kept.where("_tf_n > 1")
    if repeated.isEmpty():
        return once
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_tf_row")
    return once.unionByName(docs.join(repeated, same).groupBy("_tf_id", "_tf_digest").agg(row).select("_tf_row.*"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), threshold=0.85)
