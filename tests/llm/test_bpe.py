import hashlib
import random

import numpy as np
import odd
import pytest
import tokenizers

from tickforge.llm import bpe as B

PATH = B.default_path()


@pytest.fixture(scope="module")
def own():
    return B.Tokenizer(open(PATH, "rb").read())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def check(own, library, texts):
    for text, (ids, decoded) in zip(texts, own.encode_batch(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert decoded.decode() == library.decode(want, skip_special_tokens=False)


def test_random_texts_match_the_library(own, library):
    rng = random.Random(3)
    parts = ["abcdefghijklmnopqrstuvwxyz", "aab", "the in an re er tion ", " \t\n\x0b\x1c\x1f\x85\xa0　​!?.,'’'s't're'll",
             "éèüßÉñİΣςσǅ́123²Ⅷ½٣日本語한", "\U0001f642\U0001f44d‍"]
    texts = ["".join(rng.choice(rng.choice(parts)) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>x<|startoftext|> a<|endoftext|>", "a<|endoftext", "'s 'S it's", "ΑΣ Σ", "a\x1cb", "﻿x", ""]
    check(own, library, texts)


def test_every_code_point(own, library):
    """Between two letters all of the first planes, assigned or not; before and after others, those
    on which the versions of Unicode differ."""
    points = [chr(c) for c in range(0x32000) if not 0xD800 <= c <= 0xDFFF] + [chr(c) for c in range(0xE0000, 0xE0200)]
    for i in range(0, len(points), 8192):
        check(own, library, [" ".join(f"a{c}b" for c in points[i : i + 8192])])
    check(own, library, [" ".join(f"{c}1 .{c} {c}{c}" for c in sorted(own.differing)[:4000])])


def test_long_runs_are_encoded_in_windows(own, library):
    rng = random.Random(4)
    texts = ["x" * 5000, "!" * 3000, "ab" * 3000, "aaab" * 2000, "the" * 2000, "é" * 2000, "日本" * 1500]
    texts += ["".join(rng.choice("etaoin") for _ in range(6000)) for _ in range(4)]
    check(own, library, texts)
    run = b"the" * 3000
    parts = list(own.stream(run))
    assert len(parts) > 3 and all(len(p) for p in parts)
    assert max(own.merges.width[p].sum() for p in parts) <= own.merges.window


def test_lookahead_settles_tokens(own):
    """Whatever follows, tokens that end the lookahead before the end stay as they are."""
    rng = random.Random(6)
    m = own.merges
    for _ in range(10):
        head = bytes(rng.choice(b"aeinrst") for _ in range(m.lookahead + 60))
        seen = set()
        for _ in range(4):
            lane = own.first[np.frombuffer(head + bytes(rng.choice(b"aeinrst") for _ in range(rng.randint(0, 40))), np.uint8)]
            tokens, _ = m.merge(lane, np.array([len(lane)]))
            ends = np.cumsum(m.width[tokens])
            seen.add(tuple(tokens[: np.searchsorted(ends, len(head) - m.lookahead, "right")].tolist()))
        assert len(seen) == 1


def test_decoding_in_pieces(own):
    text = "café 日本語 ok"
    (ids, _), = own.encode_batch([text])
    ids = np.frombuffer(ids, "<u4").tolist()
    stream = B.StreamDecoder(own)
    out = "".join(stream.feed([i]) for i in ids) + stream.finish()
    assert out.rstrip() == own.decode(ids).rstrip() == text
    cut = B.StreamDecoder(own)
    assert cut.feed([int(own.first["é".encode()[0]])]) == "" and cut.finish() == "�"


def test_decoded_bytes_come_from_the_finished_ids(own, library, monkeypatch):
    monkeypatch.setattr(B, "DECODED", 3)
    texts = ["some words of a text, café 日本語", "<|endoftext|>x<|startoftext|> a", ""]
    check(own, library, texts)
    whole = B.Tokenizer.encode_ids
    monkeypatch.setattr(B.Tokenizer, "encode_ids", lambda self, texts: (ids[4:] for ids in whole(self, texts)))  # a slip
    for text, (ids, decoded) in zip(texts, own.encode_batch(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids[1:]
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == library.decode(want, skip_special_tokens=False)


def test_small_cache_gives_the_same(own, library, monkeypatch):
    monkeypatch.setattr(B, "CACHE", 3)
    fresh = B.Tokenizer(open(PATH, "rb").read())
    for _ in range(3):
        check(fresh, library, ["some words come again some words", "others do not", "some words"])


def test_odd_rows(spark, library):
    df = odd.frame(spark)
    want = []
    for r in odd.rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want.append((r[0], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((tuple(r) for r in B.round_trip(spark, df.fillna({"text": ""}), PATH).collect()), key=str) == sorted(want, key=str)
    full = B.encode_documents(spark, df, PATH)
    assert full.columns == [c for c in df.columns if c not in ("text", "n_tokens")] + ["n_tokens", "token_ids", "ids_sha256", "decoded_sha256"]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in full.collect()), key=str) == sorted(want, key=str)
    back = {r["doc_id"]: r["text"] for r in B.decode_documents(spark, full, PATH).collect()}
    assert back[10] == odd.TEXTS[10] and back[1] == ""
    assert B.round_trip(spark, odd.empty(spark), PATH).count() == 0
