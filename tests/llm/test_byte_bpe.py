import base64
import hashlib
import random

import odd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickforge.llm import byte_bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_random_long_and_odd_texts(spark, library):
    rng = random.Random(5)
    parts = ["abcdefghijklmnopqrstuvwxyz", "aab", "the in an re er tion ", " \t\n\x0b\x1c\x1f\x85\xa0　​!?.,'’'s't're'll",
             "éèüßÉñİΣςσǅ́123²Ⅷ½٣日本語한", "\U0001f642\U0001f44d‍\U00010000\U0010ffff\x00"]
    texts = ["".join(rng.choice(rng.choice(parts)) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    runs = ["x" * 40_000, "!" * 3000, " " * 20_000, " " * 300 + "a", "ab" * 3000, "aaab" * 2000, "é" * 2000, "日本" * 1500, "7" * 999, "".join(rng.choice("etaoin") for _ in range(60_000))]
    runs += ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in range(58, 70)]
    rows = odd.rows() + [(100 + i, t, None, None, None) for i, t in enumerate(texts + runs)]
    got = B.round_trip(spark, odd.frame(spark, rows), PATH, PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((r[0], *digests(library, r[1])) for r in rows), key=str)


def test_every_code_point(spark, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"a{chr(c)}b {chr(c)}1" for c in points[i : i + 4096]) for i in range(0, len(points), 4096)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    got = {r[0]: tuple(r)[1:] for r in B.round_trip(spark, docs, PATH, PATTERN).collect()}
    assert [i for i, t in enumerate(texts) if got[i] != digests(library, t)] == []


def test_documents_and_back(spark, library):
    df = odd.frame(spark)
    full = B.encode_documents(spark, df, PATH, PATTERN)
    assert full.columns == [c for c in df.columns if c not in ("text", "n_tokens")] + ["n_tokens", "token_ids"]
    want = {r[0]: library.encode_ordinary(r[1] or "") for r in odd.rows() if r[0] is not None}
    stored = full.where(F.col("doc_id").isNotNull())
    assert all(r["token_ids"] == want[r["doc_id"]] and r["n_tokens"] == len(want[r["doc_id"]]) for r in stored.collect())
    back = {r["doc_id"]: r["text"] for r in B.decode_documents(spark, stored, PATH).collect()}
    assert all(back[i] == (odd.TEXTS[i] or "") for i in back)
    cut = spark.createDataFrame([(1, want[6][:1] + [int(B.read_ranks(PATH)[b"\xc3"])]), (2, None)], "doc_id long, token_ids array<int>")
    assert [r["text"][-1:] for r in B.decode_documents(spark, cut, PATH).orderBy("doc_id").collect()] == ["�", ""]
    assert B.round_trip(spark, odd.empty(spark), PATH, PATTERN).count() == 0


def test_the_dictionary_changes_nothing(spark, monkeypatch):
    df = odd.frame(spark)
    rows = lambda: sorted(map(tuple, B.round_trip(spark, df, PATH, PATTERN).collect()), key=str)
    with_words = rows()
    monkeypatch.setattr(B.ByteBpe, "dictionary", lambda self, docs: {})
    monkeypatch.setattr(B, "FOLDED", 20)
    # Without a dictionary, a token that its own merges do not make would differ.
    assert rows() == with_words


def test_heap_and_fold_agree(library):
    ranks = B.read_ranks(PATH)
    rng = random.Random(8)
    for n in (1, 2, 3, 63, 64, 65, 500):
        word = "".join(rng.choice("etaoinsh") for _ in range(n))
        assert [ord(c) - B.FIRST for c in B.merge_long(word.encode(), ranks)] == library.encode_ordinary(word)


def test_plans_hold_no_tables(spark):
    """Ranks and dictionary are broadcast: as literals they were in every plan that the driver keeps."""
    plan = B.round_trip(spark, odd.frame(spark), PATH, PATTERN)._jdf.queryExecution().toString()
    assert len(plan) < 200_000


@pytest.mark.parametrize("tokens", [["abc", "bc", " a", "xyz"], ["ab", "bc", "abc", " a", "xyz", "aa", "aaa", "é"]])
def test_tokens_that_merges_make_late_or_never(spark, tmp_path, monkeypatch, tokens):
    """abc is made of a later token in the first list; xyz by no merge, so it is a token as a whole word alone."""
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
    path = tmp_path / "own.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items()))
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["abc xyz", "xyz", "abcabc aabc wxyz xyzabc", "aaaa aaaaa aaabc", "caféé bcab", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert B.Vocabulary(B.read_ranks(str(path))).in_order == (tokens[0] == "ab")
    rows = lambda: sorted(map(tuple, B.round_trip(spark, docs, str(path), PATTERN).collect()))
    assert rows() == [(i, *digests(own, t)) for i, t in enumerate(texts)]
    monkeypatch.setattr(B.ByteBpe, "dictionary", lambda self, docs, f=B.ByteBpe.dictionary: f(self, docs, words=1))
    assert rows() == [(i, *digests(own, t)) for i, t in enumerate(texts)]


def test_pieces_change_nothing(spark, monkeypatch):
    df = odd.frame(spark)
    rows = lambda: sorted(map(tuple, B.round_trip(spark, df, PATH, PATTERN).collect()), key=str)
    whole = rows()
    monkeypatch.setattr(B, "PIECE", 3)
    assert rows() == whole


def test_decoding_skips_ids_of_no_token(spark):
    own = spark.createDataFrame([(1, [B.read_ranks(PATH)[b"a"], None, -1, 1 << 20, B.read_ranks(PATH)[b"b"]]), (2, [])], "doc_id long, token_ids array<int>")
    assert [r["text"] for r in B.decode_documents(spark, own, PATH).orderBy("doc_id").collect()] == ["ab", ""]
