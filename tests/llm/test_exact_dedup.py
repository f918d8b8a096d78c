import hashlib
import re

import odd
from pyspark.sql import functions as F

from tickforge.llm import exact_dedup as X


def norm(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def expected(rows):
    out = []
    keyed = [(norm(r[1]), -len(r[1] or ""), r[0] is None, r[0] or 0, r[0]) for r in rows]
    for h in {k[0] for k in keyed}:
        group = sorted(k for k in keyed if k[0] == h)
        out += [(k[4], group[0][4], len(group), n == 0, h) for n, k in enumerate(group)]
    return sorted(out, key=str)


def test_every_row_is_decided(spark):
    data = odd.rows()
    got = X.assign(spark, odd.frame(spark, data))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(data)
    assert X.assign(spark, odd.empty(spark)).count() == 0


def test_kept_rows_have_all_columns(spark):
    df = odd.frame(spark)
    kept = X.keep_first(spark, df)
    assert kept.columns == df.columns
    want = sorted((r[0] for r in expected(odd.rows()) if r[3]), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want
    assert X.keep_first(spark, odd.empty(spark)).count() == 0


def test_later_batches_meet_the_stored_index(spark, tmp_dir):
    first = [(i, f"text {i}", None, None, 0) for i in range(20)]
    second = [(100 + i, f"te xt{i}", None, None, 0) for i in range(15, 25)]
    index = X.DigestIndex(spark, f"{tmp_dir}/index", buckets=4)
    assert X.keep_first(spark, odd.frame(spark, first, clash=False), index).count() == 20
    again = X.DigestIndex(spark, f"{tmp_dir}/index", buckets=4)  # as a later session opens it
    assert sorted(r["doc_id"] for r in X.keep_first(spark, odd.frame(spark, second, clash=False), again).collect()) == [120, 121, 122, 123, 124]
    third = X.assign(spark, odd.frame(spark, second, clash=False), X.DigestIndex(spark, f"{tmp_dir}/index", buckets=4)).collect()
    assert {r["doc_id"]: r["keep_id"] for r in third} == {100 + i: i if i < 20 else 100 + i for i in range(15, 25)}
    assert not any(r["kept"] for r in third)
    assert spark.table(again.name).count() == 25


def test_a_batch_that_is_run_again_keeps_its_rows(spark, tmp_dir):
    part = lambda a, b: odd.frame(spark, [(i, f"text {i % 40}", None, None, 0) for i in range(a, b)], clash=False)
    index = X.DigestIndex(spark, f"{tmp_dir}/index", buckets=4)
    keep = lambda docs, batch: sorted(r["doc_id"] for r in X.keep_first(spark, docs, index, batch).collect())
    first, second = part(0, 30), part(20, 60)
    assert keep(first, "one") == list(range(30)) == keep(first, "one")
    assert keep(second, "two") == list(range(30, 40))
    assert keep(first, "one") == list(range(30)) and keep(second, "two") == list(range(30, 40))
    assert index.entries().count() == 40
    # An attempt that was broken off while it entered its digests.
    third = part(100, 140).withColumn("text", F.concat("text", F.lit(" new")))
    half = third.limit(15).select(X.text_digest(F.col("text")).alias("digest"), F.col("doc_id").alias("keep_id"))
    index.append(half, "three")
    assert keep(third, "three") == list(range(100, 140)) and index.entries().count() == 80
    assert [r["kept"] for r in X.assign(spark, first, index, "one").collect()] == [True] * 30


def test_anti_join_reads_the_index_without_a_shuffle(spark, tmp_dir):
    index = X.DigestIndex(spark, f"{tmp_dir}/index", buckets=8)
    docs = odd.frame(spark, [(i, f"text {i}", None, None, 0) for i in range(50)], clash=False)
    X.keep_first(spark, docs, index)
    batch = docs.select(X.text_digest(docs["text"]).alias("digest"))
    plan = index.unseen(batch)._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("SortMergeJoin") :].split("FileScan parquet")[-1]
    assert "SortMergeJoin" in plan and "Bucketed: true" in right
    assert plan.count("Exchange hashpartitioning") == 1
