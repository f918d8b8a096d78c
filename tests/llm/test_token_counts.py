import base64

import numpy as np
import odd
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tickforge.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def lengths(texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return np.array([len(enc.encode_ordinary(t or "")) for t in texts])


def test_histogram_and_sums_match_brute_force(spark):
    data = odd.rows() + [(100 + i, "tok " * (i % 7), None, None, 0) for i in range(60)]
    want = lengths([r[1] for r in data])
    hist = C.histogram(C.encoded_lengths(spark, odd.frame(spark, data), PATH, public_tokenizers.PATTERN))
    got = C.limits(hist).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(set(want.tolist()))
    for r in got:
        n = r["n_tokens"]
        assert (r["n_docs"], r["docs_over"], r["tokens_over"]) == ((want == n).sum(), (want > n).sum(), want[want > n].sum())
        assert (r["docs_in_all"], r["tokens_in_all"], r["tokens_cut"]) == (len(want), want.sum(), np.minimum(want, n).sum())
        assert abs(r["quantile"] - (want <= n).mean()) < 1e-12
    asked = spark.createDataFrame([(0,), (2,), (5,), (4096,), (10**9,)], "context long")
    for r in C.at_limits(hist, asked).collect():
        assert r["tokens_cut"] == np.minimum(want, r["n_tokens"]).sum() and r["docs_over"] == (want > r["n_tokens"]).sum()


def test_empty_table(spark):
    hist = C.histogram(C.encoded_lengths(spark, odd.empty(spark), PATH, public_tokenizers.PATTERN))
    assert C.limits(hist).count() == 0
    assert hist.agg(F.sum("n_docs")).first()[0] is None


def test_very_long_runs(spark):
    """The library gives up on a million blanks; elsewhere the counts are its own."""
    rng = np.random.default_rng(1)
    mixed = ["".join(rng.choice(list(" \n\t\u3000\x1c"), n)) for n in (999, 1000, 1001, 5000)]
    edges = [f"{a}{m}{b}" for m in mixed for a in ("", "x", "1 ") for b in ("", "x", ".", "7", "'s")]
    known = [*edges, "x" * 50_000, "7" * 50_000, "x " * 50_000, " " * 100_000, "a" + " " * 100_000 + "b"]
    ranks = C.encoded_lengths(spark, odd.frame(spark, [(i, t, None, None, 0) for i, t in enumerate(known)]), PATH, public_tokenizers.PATTERN)
    assert [r["n_tokens"] for r in ranks.orderBy("doc_id").collect()] == lengths(known).tolist()
    size = 2_000_000
    long = [" " * size, "x" + "\n" * size + "y", "ab " * (size // 3), "7" * (size // 10), "x" * (size // 10)]
    got = C.encoded_lengths(spark, odd.frame(spark, [(i, t, None, None, 0) for i, t in enumerate(long)]), PATH, public_tokenizers.PATTERN)
    assert got.where("n_tokens > 1000").count() == len(long)
