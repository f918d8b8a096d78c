"""Spelling variants by Bloom-guided neighbourhoods (method 13).

Two words are near if one edit (a code point inserted, deleted or replaced) turns one into
the other.  Each word's edits are generated and probed against Bloom filters of the
vocabulary, one shard per word length, in blocks of 64 bits.  The filters are broadcast;
their size has a fixed bound, beyond which they let more through.  Only edits that they
let through are shuffled, to an exact join with the vocabulary, which removes the false ones.

An insertion is a deletion seen from the other word, and a replacement by a lesser code
point one by a greater, so deletions and replacements by greater code points meet every pair once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, to_workers, whole_text, work_dir

#: Bits of the filters per word, and bytes of all filters at most (a bound of what is broadcast).
BITS_PER_WORD, FILTER_BYTES = 24, 32 << 20
#: Bits that a word sets in its block.
SET_BITS = 5
#: Edits that are probed at a time.
PROBED = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _points(words: list[str], length: int) -> np.ndarray:
    """Code points, a row per word of that length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, length - 1), BASE)]), dtype=np.uint64)


class Shards:
    """Blocks of the filters: each length has its own, in proportion to its words."""

    def __init__(self, counts: dict[int, int], bits_per_word: int, most_bytes: int):
        every = sum(counts.values())
        blocks = min(most_bytes // 8, -(-every * bits_per_word // 64))
        self.first, self.blocks, at = {}, {}, 0
        for length, n in sorted(counts.items()):
            self.first[length], self.blocks[length] = at, max(1, blocks * n // every)
            at += self.blocks[length]
        self.size = at

    def place(self, hashes: np.ndarray, length: int):
        """(block, bits) of hashes of words of that length."""
        z = _mixed(hashes + np.uint64(length))
        block = ((z >> np.uint64(32)) * np.uint64(self.blocks[length]) >> np.uint64(32)) + np.uint64(self.first[length])
        bits = np.zeros(z.shape, np.uint64)
        for k in range(SET_BITS):
            bits |= np.uint64(1) << ((z >> np.uint64(6 * k)) & np.uint64(63))
        return block.astype(np.int64), bits


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def build_filters(words: DataFrame, shards: Shards) -> np.ndarray:
    """The blocks: bits are gathered by Spark, and the driver gets one row per block that has any."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            every = batch.column("word").to_pylist()
            for length, at in _by_length(every).items():
                hashes = (_points([every[i] for i in at], length) * _powers(length)).sum(axis=1, dtype=np.uint64)
                block, bits = shards.place(hashes, length)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bits.view(np.int64))], ["block", "bits"])

    got = to_workers(words.select("word"), run, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(max(1, shards.size), np.uint64)
    out[got.column("block").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def edits(words: list[str], length: int, alphabet: np.ndarray, shards: Shards, filters: np.ndarray):
    """(index of the word, edited word) of the deletions and replacements that the filters let through."""
    points, power = _points(words, length), _powers(length)
    terms = points * power
    whole = terms.sum(axis=1, dtype=np.uint64)

    def let_through(hashes, size):
        block, bits = shards.place(hashes, size)
        return filters[block] & bits == bits

    if length - 1 in shards.first:
        # Without the point at i: those after it move down one power.  Of equal points in a row the last goes.
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        without = before - terms + (whole[:, None] - before) * UNBASE
        useful = np.ones(points.shape, bool)
        useful[:, :-1] = points[:, :-1] != points[:, 1:]
        for i, at in zip(*np.nonzero(useful & let_through(without, length - 1)), strict=True):
            yield i, words[i][:at] + words[i][at + 1 :]
    if length in shards.first:
        # A part of the words, and of the places of one long word, at a time.
        rows = max(1, PROBED // max(1, length * len(alphabet)))
        places = max(1, PROBED // (rows * len(alphabet)))
        for r in range(0, len(words), rows):
            for p in range(0, length, places):
                old = points[r : r + rows, p : p + places, None]
                hashes = whole[r : r + rows, None, None] + (alphabet - old) * power[p : p + places, None]
                for i, at, c in zip(*np.nonzero((alphabet > old) & let_through(hashes, length)), strict=True):
                    word = words[r + i]
                    yield r + i, word[: p + at] + chr(alphabet[c]) + word[p + at + 1 :]


def near_pairs(spark: SparkSession, words: DataFrame, path: str, bits_per_word: int = BITS_PER_WORD, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(a, a_n, b, b_n), each pair of near words once, from distinct (word, n)."""
    counts = {r[0]: r[1] for r in words.groupBy(F.char_length("word")).count().collect()}
    shards = Shards(counts, bits_per_word, most_bytes)
    letters = sorted(ord(r[0]) for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c != ''").distinct().collect())
    alphabet = np.array(letters, np.uint64)
    sent = spark.sparkContext.broadcast(build_filters(words, shards))

    def run(batches):
        import pyarrow as pa

        filters = sent.value
        for batch in batches:
            every, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for length, at in _by_length(every).items():
                found = list(edits([every[i] for i in at], length, alphabet, shards, filters))
                own = np.array(at, np.int64)[[i for i, _ in found]] if found else np.zeros(0, np.int64)
                arrays = [pa.array([w for _, w in found], pa.string()), pa.array([every[i] for i in own], pa.string()), pa.array(n[own], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "a", "a_n"])

    # Dealt by word, as a vocabulary of a few files would keep most cores idle.
    dealt = words.select("word", "n").repartition(F.xxhash64("word"))
    let_through = to_workers(dealt, run, "word string, a string, a_n long")
    return stored(let_through.join(words, "word").select("a", "a_n", F.col("word").alias("b"), F.col("n").alias("b_n")), path)


def roots(links: DataFrame, path: str) -> DataFrame:
    """(word, root) from (word, form): each round follows twice as many links, until none goes on."""
    reached, k = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), f"{path}/0"), 0
    while reached.where("moved").limit(1).count():
        k += 1
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = reached.drop("moved").join(further, "root", "left")
        reached = stored(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), f"{path}/{k}")
    return reached.select("word", "root")


def variant_groups(spark: SparkSession, words: DataFrame, ratio: int = 5, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n from (word, n).

    A word's form is its near word of largest n, the least in order of code points among equals, if
    that n is at least ``ratio`` times the word's; else null.  root follows forms to the last, the
    word itself if it has none.  n_near counts near words.  Rows that repeat a word add
    up; null words and words of a null count take no part, and neither does the empty word.
    An empty table gives no rows.  Words may be of any length and of any characters.
    """
    path = work_dir(spark, "spelling")
    words = words.where((F.col("word") != "") & F.col("n").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stored(words, f"{path}/words")
    pairs = near_pairs(spark, words, f"{path}/pairs", most_bytes=most_bytes)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    first = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), first.alias("first"))
    formed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("first.near").alias("form"), (-F.col("first.order")).alias("form_n"))
    has = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    formed = formed.withColumns({"form": F.when(has, F.col("form")), "form_n": F.when(has, F.col("form_n"))})
    formed = stored(formed, f"{path}/formed")
    last = roots(formed.where(F.col("form").isNotNull()), f"{path}/roots")
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def count_words(docs: DataFrame, spelt=lambda word: word, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n) of the whole texts: maximal runs of Latin letters, A-Z lower-cased, then what
    ``spelt`` (a Column function) makes of them, of at least ``least_length`` code points and
    ``least_count`` occurrences.  Shorter runs are left out at once: ``spelt`` may not lengthen
    a word.  Null texts hold no words."""
    run = F.explode(F.regexp_extract_all(whole_text(), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least_length},}}"), 0))
    words = docs.withColumn("_tf_run", run).withColumn("_tf_run", F.translate("_tf_run", UPPER, UPPER.lower()))
    words = words.select(spelt(F.col("_tf_run")).alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    def misspelt(word: Column) -> Column:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), word))
        at = (h % F.char_length(word)).cast("int")
        shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
        return F.when(h % 199 == 0, shorter).otherwise(word)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variant_groups(spark, count_words(docs, misspelt))
