import random
import re
import zlib
from collections import Counter

import numpy as np
import odd
import pytest

from tickforge.llm import spelling as S


def neighbours(word, alphabet):
    cuts = range(len(word) + 1)
    out = {word[:i] + word[i + 1 :] for i in cuts if i < len(word)}
    out |= {word[:i] + c + word[i + 1 :] for i in cuts if i < len(word) for c in alphabet}
    out |= {word[:i] + c + word[i:] for i in cuts for c in alphabet}
    return out - {word}


def brute(counts, ratio=5):
    alphabet = sorted(set("".join(counts)))
    form, rows = {}, {}
    for w, n in counts.items():
        near = [x for x in neighbours(w, alphabet) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        rows[w] = len(near)
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, rows[w], counts.get(form[w])))
    return sorted(out)


def grouped(spark, counts, **more):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted(map(tuple, S.variant_groups(spark, df, **more).collect()))


def vocabulary(seed, size=400, letters="abé"):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))): rng.choice([1, 2, 5, 25, 130, 700]) for _ in range(size)}


@pytest.mark.parametrize("most_bytes", [S.FILTER_BYTES, 8])  # filters that let everything through change nothing
def test_against_all_edits(spark, most_bytes):
    counts = vocabulary(1)
    got = grouped(spark, counts, most_bytes=most_bytes)
    assert got == brute(counts)
    assert any(r[1] is not None and r[2] != r[1] for r in got)  # chains of forms


def test_long_words_and_other_alphabets(spark, monkeypatch):
    monkeypatch.setattr(S, "PROBED", 64)  # many parts
    long = "word" * 700
    counts = {long: 100, long[:-1]: 2, long + "s": 3, "日本語": 50, "日木語": 4, "日本": 9, "\U0001f642a": 20, "\U0001f643a": 1, "a": 30, "b": 5, "ab": 1, "aab": 1, "aaab": 40}
    assert grouped(spark, counts) == brute(counts)


def test_repeats_nulls_and_empty(spark):
    rows = [("tested", 3), ("tested", 4), ("teste", 1), (None, 5), ("", 9), ("texted", None), ("testes", 1)]
    df = spark.createDataFrame(rows, "word string, n long")
    assert sorted(map(tuple, S.variant_groups(spark, df).collect())) == brute({"tested": 7, "teste": 1, "testes": 1})
    assert S.variant_groups(spark, df.limit(0)).count() == 0
    assert S.variant_groups(spark, S.count_words(odd.empty(spark))).count() == 0


def test_filters_hold_every_word_and_little_else(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcdefghijkl") for _ in range(rng.choice([6, 7]))) for _ in range(20_000)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    shards = S.Shards({n: sum(len(w) == n for w in words) for n in (6, 7)}, S.BITS_PER_WORD, S.FILTER_BYTES)
    filters = S.build_filters(df, shards)
    assert shards.size * 8 <= len(words) * S.BITS_PER_WORD / 8

    def held(some):
        block, bits = shards.place((S._points(some, 6) * S._powers(6)).sum(axis=1, dtype=np.uint64), 6)
        return (filters[block] & bits == bits).mean()

    assert held([w for w in words if len(w) == 6]) == 1
    assert held(["".join(rng.choice("mnopqrst") for _ in range(6)) for _ in range(20_000)]) < 0.02
    assert S.Shards({6: 10**9, 7: 10**9}, S.BITS_PER_WORD, 1 << 20).size * 8 <= 1 << 20


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    return brute({w: n for w, n in counts.items() if n >= 5})


def test_the_query(spark, tmp_path):
    """Whole texts of sf0.001 and odd rows, against the definition."""
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = source.unionByName(odd.frame(spark, clash=False).select(*source.columns))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = S.op13_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == expected(rows) != []
