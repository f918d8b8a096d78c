import math
import random
import zlib

import numpy as np
import odd

from tickforge.llm import langid as L

SF = "/root/testdata/sf0.01"


def naive_phrases(text, sample):
    """Phrases of a text, each the longest match in the sample (a lone symbol if there is none)."""
    at = n = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


def test_phrases_match_a_plain_cross_parse(monkeypatch):
    monkeypatch.setattr(L, "STRIDE", 64)
    rng = random.Random(1)
    samples = {"x": "".join(rng.choice("abcd e") for _ in range(400)), "y": "".join(rng.choice("ceg  f") for _ in range(400))}
    model = L.Model(samples)
    clean = {k: "".join(chr(c) if c else " " for c in L.Model._fold(v).tolist()) for k, v in samples.items()}
    texts = ["".join(rng.choice("abcdefgz ") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    raw = [t.encode() for t in texts]
    bits, letters = model.bits(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for j, t in enumerate(texts):
        norm = " ".join(t.split()) + (" " if t.endswith(" ") and t.strip() else "")
        assert letters[j] == sum(c != " " for c in t)
        for i, k in enumerate(model.langs):
            n = sum(naive_phrases(norm[a : a + 64], clean[k]) for a in range(0, len(norm), 64))
            assert abs(bits[i, j] - n * math.log2(len(clean[k]) + 2) / max(1, len(norm))) < 1e-9, (t, k)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert len(held) > 100 and sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_held_out_rows_and_ids_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    a = {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, docs).collect()}
    shuffled = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    assert {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, shuffled).collect()} == a


def test_odd_rows(spark):
    data = odd.rows() + [(100 + i, "der die das und nicht ein Haus", "de", "s", 0) for i in range(8)] + [(200 + i, "the house and a garden with trees", "en", "s", 0) for i in range(8)]
    df = odd.frame(spark, data)
    got = L.identify(spark, df).collect()
    assert len(got) == len(data)
    by_id = {r["doc_id"]: r for r in got}
    for i in (0, 1, 2, 5):  # null, empty, blank, digits
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert all(r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1 for r in got)
    kept = L.drop_unidentified(spark, df)
    assert kept.columns == df.columns and not {0, 1, 2, 5} & {r["doc_id"] for r in kept.collect()}
    assert kept.count() == sum(any(c.isalpha() for c in (r[1] or "")) for r in data)
    assert L.identify(spark, odd.empty(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    df = odd.frame(spark, [(1, "some text", None, "s", 0)], clash=False)
    assert [r["lang_pred"] for r in L.identify(spark, df).collect()] == ["und"]


def test_sample_is_bounded_and_the_same_again(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = L.learn(docs, rows_per_lang=20, chars_per_lang=2000)
    assert set(a) == {"en", "de", "fr", "es"} and all(len(v) <= 2000 + 20 for v in a.values())
    assert a == L.learn(docs.repartition(7), rows_per_lang=20, chars_per_lang=2000)


def test_a_label_with_hardly_a_letter_takes_no_documents(spark):
    """An empty, a digit-only and a two-letter row under a rare label are no cheap parse."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    learnt = [i for i in range(10**6, 10**6 + 99) if zlib.crc32(str(i).encode()) % 4 != 2]
    foreign = "日本語の文章です " * 40 + "the house and a garden with trees " * 5
    for texts in ([""], ["12 34 !!"], ["ok"], ["", "12 34 !!", "ok"], ["the ok of a"]):
        rare = [(i, t, "aa") for i, t in zip(learnt, texts)] + [(learnt[-1], foreign, None)]
        got = L.identify(spark, docs.unionByName(spark.createDataFrame(rare, docs.schema))).join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
        held = [r for r in got if r["held_out"] and r["lang"]]
        assert len(held) > 100 and sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97, texts
        assert next(r for r in got if r["doc_id"] == learnt[-1])["lang_pred"] != "aa", texts


def test_letterless_rows_do_not_use_up_the_sample(spark):
    rows = [(i, "12 34", "de", "s", 0) for i in range(60)] + [(100 + i, f"{'7' * 300} der Garten {i}", "de", "s", 0) for i in range(3)]
    got = L.learn(odd.frame(spark, rows, clash=False), rows_per_lang=3, chars_per_lang=256)
    assert sorted(got["de"].split("\n")) == [f"der Garten {i}" for i in range(3)]
    assert L.learn(odd.frame(spark, rows[:60], clash=False)) == {} and L.Model({"x": "12", "y": "ab"}).langs == ["y"]


def test_documents_with_letters_stay_where_nothing_was_learned(spark):
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2)
    texts = [(100, "some text", None, "s", 0), (101, "日本語", None, "s", 0), (102, "12 !!", None, "s", 0), (103, None, None, "s", 0), (104, "", None, "s", 0)]
    for more in ([], [(held, "a labelled text that is held out", "en", "s", 0)], [(105, "12", "en", "s", 0)]):
        kept = L.drop_unidentified(spark, odd.frame(spark, texts + more, clash=False))
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted([100, 101] + [r[0] for r in more if r[0] == held])
