import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402
import odd  # noqa: E402
import test_exact_dedup  # noqa: E402
import test_minhash  # noqa: E402
import test_mixing  # noqa: E402
import tokenizers  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of each stage, on documents with planted cases."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    long = next(r for r in rows if len(r[1].split()) > 200)
    planted = [(10_000, long[1] + "  ", *long[2:]), (10_001, long[1].replace(" ", "\n"), *long[2:]), (10_002, long[1] + " one more word", *long[2:]),
               (10_003, None, "en", None, 0), (10_004, "12 !!", "en", "s", 0), (10_005, "", None, None, 0)]
    df = spark.createDataFrame(rows + planted, docs.schema)
    out, path = [], tmp_path_factory.mktemp("pipeline")
    for i, (name, f) in enumerate(P.STAGES):
        got = f(spark, df, SF)
        got.write.parquet(f"{path}/{i}")
        nxt = spark.read.parquet(f"{path}/{i}")
        out.append((name, df, nxt))
        df = nxt
    return out, long[0]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_against_brute_force(spark, stages):
    (lang, exact, near, mixing, bpe), long_id = stages
    assert ids(lang[2]) == sorted(set(ids(lang[1])) - {10_003, 10_004, 10_005})
    rows = [(r["doc_id"], r["text"]) for r in exact[1].collect()]
    assert ids(exact[2]) == sorted(r[0] for r in test_exact_dedup.expected(rows) if r[3])
    assert 10_001 not in ids(exact[2]) and 10_000 in ids(exact[2])  # the longer of two equal texts stays
    rows = [(r["doc_id"], r["text"]) for r in near[1].collect()]
    assert ids(near[2]) == sorted({c for _, _, c in test_minhash.brute(rows, 80)})
    assert len({10_000, 10_002, long_id} & set(ids(near[2]))) <= 1
    sizes = Counter()
    for r in mixing[1].collect():
        sizes[r["source"]] += test_mixing.n_words(r["text"])
    taken = Counter()
    for r in mixing[2].collect():
        taken[r["source"]] += test_mixing.n_words(r["text"])
    for s, t in test_mixing.water_fill(sizes).items():
        assert abs(taken[s] - t) <= 0.05 * t + 5
    assert max(Counter(ids(mixing[2])).values()) <= 3
    library = tokenizers.Tokenizer.from_file(P.bpe.default_path())
    texts = {r["doc_id"]: r["text"] for r in bpe[1].collect()}
    for r in bpe[2].collect():
        assert r["token_ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_stages_keep_the_columns_of_documents(spark, stages):
    for name, before, after in stages[0][:-1]:
        assert before.columns == after.columns, name


def test_run_applies_all_stages(spark):
    docs = P.run(spark, SF)
    assert docs.count() > 100 and {"doc_id", "source", "token_ids", "ids_sha256"} <= set(docs.columns)


def test_stages_take_odd_rows(spark):
    for make in (lambda: odd.frame(spark), lambda: odd.empty(spark)):
        df = make()
        for name, f in P.STAGES:
            df = f(spark, df, SF)
        assert df.count() >= 0
