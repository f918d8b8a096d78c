import random
import re

import odd

from tickforge.llm import licenses as L

BASE = [(t.label, t.text) for t in L.TEMPLATES if t.base]


def brute(text):
    words = L.split_words(text or "")
    hits = [(i, label) for label, phrase in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in hits]
    return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def results(spark, df):
    return {r["doc_id"]: r for r in L.scan(df).collect()}


def test_base_phrases_match_a_scan_of_every_place(spark):
    random.seed(5)
    parts = ["gnu", "general", "public", "license", "GNU General Public License", "Apache License,", "cc", "by", "CC-BY", "mit license", "é", "x\x00y", "0", "und"]
    texts = [" ".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(300)]
    texts += ["mit license mit license", "gnu general\npublic   license", "cc by cc by nc", "mit licenses", "xmit license", "cc_by"]
    got = results(spark, odd.frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)], clash=False))
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_notices_are_found_by_their_place_and_key_phrases(spark):
    mit = next(t for t in L.TEMPLATES if t.label == "mit" and t.keys)
    changed = re.sub("obtaining a copy", "who obtains one copy", mit.text)
    without_key = re.sub("without restriction", "with care", mit.text)
    texts = ["noise before " * 40 + mit.text + " and after", changed, without_key, " ".join(reversed(mit.text.split()))]
    got = results(spark, odd.frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)], clash=False))
    assert got[0]["labels"] == "mit" and got[0]["score"] > 0.99 and got[0]["base_labels"] == ""
    assert got[0]["spans"][0]["start"] == 80
    assert got[1]["labels"] == "mit" and 0.5 < got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[3]["labels"] == ""


def test_odd_rows(spark):
    df = odd.frame(spark)
    got = L.scan(df).collect()
    assert len(got) == df.count()
    for r, (n, base, first, last, labels) in ((r, brute(t)) for r in got for t in [dict((x[0], x[1]) for x in odd.rows() if x[0] is not None).get(r["doc_id"])] if r["doc_id"] is not None):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, base, first, last, labels)
    assert L.scan(odd.empty(spark)).count() == 0


def test_notices_of_a_family_are_told_apart(spark):
    """Each notice, wrapped and in capitals, gives its own label: an LGPL or AGPL notice is no GPL one."""
    notices = [t for t in L.TEMPLATES if t.keys]
    texts = [f"Copyright 2020 somebody\n\n{t.text.upper()}\n\nand more words" for t in notices]
    got = results(spark, odd.frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)], clash=False))
    found = {t.label: {x for x in got[i]["labels"].split(",") if x in {n.label for n in notices}} for i, t in enumerate(notices)}
    assert {k: v for k, v in found.items() if k in ("lgpl", "agpl", "boost", "zlib", "bsd", "bsd-3-clause", "mit", "isc")} == {
        k: {k} for k in ("lgpl", "agpl", "boost", "zlib", "bsd", "bsd-3-clause", "mit", "isc")}
    assert "gpl" in found["gpl"] and not {"lgpl", "agpl"} & found["gpl"]
