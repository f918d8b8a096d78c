"""Exact length histogram (method 6).

Documents are counted by encoded length once.  With n(l) documents of length l,
suffix sums give for every context limit L what it holds and cuts:
documents longer than L, tokens in all, and tokens left when every document is cut
at L, which is the sum over l of n(l) * min(l, L).
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import SPACES
from .common import stored, table, to_workers, whole_text, work_dir, worker_cache

#: White space that is cut off by hand from this length on: the library's pattern engine keeps a
#: step per blank for the look-ahead and gives up on about a million.
BLANKS, LOOK_AHEAD = 1000, r"\s+(?!\S)|\s+"
#: Lengths of one block of the two-level sums.
SPAN = 1024


def count_tokens(encoding, blanks, text: str) -> int:
    """Tokens of a text.  ``blanks`` finds long white space, or is None.  Of such a run the pattern
    makes one piece, but for the last blank if something follows; what stands before it ends there."""
    at = n = 0
    for m in blanks.finditer(text) if blanks is not None else ():
        end = m.end() if m.end() == len(text) else m.end() - 1
        n += len(encoding.encode_ordinary(text[at : m.start()])) + len(encoding._encode_single_piece(m.group()[: end - m.start()]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:]))


def encoded_lengths(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens): tokens of each whole text by a byte-level BPE given as ranks
    (null: empty, no tokens).  Text that spells a special token is ordinary text.  Texts may be of
    any length; an empty table gives no rows."""
    with open(ranks_path, "rb") as f:
        raw = f.read()
    if len(raw) > 64 << 20:
        raise ValueError("vocabulary file of more than 64 MB")
    ranks = spark.sparkContext.broadcast(raw)

    def build(raw):
        import tiktoken

        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table_, special_tokens={})

    def run(batches):
        import re

        import pyarrow as pa

        blanks = re.compile(f"[{SPACES}]{{{BLANKS},}}") if LOOK_AHEAD in pattern else None
        encoding = worker_cache(("ranks", hashlib.sha256(ranks.value).hexdigest(), pattern), lambda: build(ranks.value))
        for batch in batches:
            counts = [count_tokens(encoding, blanks, t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return to_workers(docs.select("doc_id", whole_text().alias("text")), run, f"doc_id {kind}, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): exact, pre-aggregated in each task."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """One row per encoded length, taken as context limit: n_tokens, n_docs, docs_over,
    tokens_over, docs_in_all, tokens_in_all, quantile, tokens_cut.

    ``docs_over`` and ``tokens_over`` are the documents longer than the limit and
    their tokens; ``quantile`` is the share of documents within it; ``tokens_cut``
    the tokens left when all are cut at it.  Sums run over blocks of lengths
    first, so that no task orders all lengths.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    hist = hist.withColumn("block", F.floor(F.col("n_tokens") / SPAN))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("_d").over(after), zero).alias("_d"),
        F.coalesce(F.sum("_t").over(after), zero).alias("_t"),
        F.sum("_d").over(everything).alias("docs_in_all"),
        F.sum("_t").over(everything).alias("tokens_in_all"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    out = hist.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.col("_d") + F.coalesce(F.sum("n_docs").over(within), zero)).alias("docs_over"),
        (F.col("_t") + F.coalesce(F.sum(tokens).over(within), zero)).alias("tokens_over"),
        "docs_in_all",
        "tokens_in_all",
    )
    return out.withColumn("quantile", 1 - F.col("docs_over") / F.col("docs_in_all")).withColumn(
        "tokens_cut", F.col("tokens_in_all") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")
    )


def at_limits(hist: DataFrame, contexts: DataFrame) -> DataFrame:
    """The rows of ``limits`` for any limits (column ``context``), whether or not a document
    has that length: they enter the histogram with no documents."""
    asked = contexts.select(F.col("context").cast("long").alias("n_tokens")).distinct()
    both = hist.unionByName(asked.withColumn("n_docs", F.lit(0).cast("long"))).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    return limits(both).join(asked, "n_tokens", "left_semi")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct encoded length of ``documents`` as a context limit."""
    import public_tokenizers

    lengths = encoded_lengths(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return limits(stored(histogram(lengths), work_dir(spark, "token-counts") + "/histogram"))
