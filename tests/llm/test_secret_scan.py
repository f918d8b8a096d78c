import hashlib
import random
import re
import time

import odd
from pyspark.sql import functions as F

from tickforge.llm import secret_scan as S


def brute(text, rules=S.RULES):
    """(start, order, end, kind) by the definition: all leftmost matches, short ones dropped after."""
    out = []
    for order, (kind, pattern, group, least) in enumerate(rules):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


#: Written from the definition, with least lengths apart from the patterns.
PLAIN = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[opsur]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1),
    ("pem", "-----BEGIN ([A-Z]| )*PRIVATE KEY-----", 0, 1),
]


def spans(spark, rows, **options):
    df = odd.frame(spark, rows)
    got = S.scan_documents(spark, df, **options).collect()
    return [(r["doc_id"], r["blob"], [tuple(s) for s in r["spans"]]) for r in got]


def texts():
    rng = random.Random(8)
    parts = ["password", "Token", "API_KEY", "apikey", "secret", '"', "'", " ", ":", "=", "abc", "abcdef1234", "AKIA", "AKIA" + "Z" * 16, "AKIA" + "Z" * 15,
             "0123456789abcdef" * 2, "0123456789abcdef", "é", "🙂", "ghp_" + "a1" * 18, "xoxb-123456789012", "\n", "secret: token: abcdefgh", "eyJ", "eyJa", ".", ".eyJb.", "x.", "-----BEGIN ", "RSA ", "PRIVATE KEY-----"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]


def test_spans_match_the_definition(spark):
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts())]
    assert [r.kind for r in S.RULES] == [p[0] for p in PLAIN]
    got = {i: s for i, _, s in spans(spark, rows)}
    assert {kind for s in got.values() for *_, kind in s} == {p[0] for p in PLAIN}
    assert any(got.values())
    for i, t, *_ in rows:
        assert got[i] == brute(t, PLAIN), t


def test_odd_rows(spark):
    rows = odd.rows()
    got = spans(spark, rows)
    assert sorted((i, b.hex()) for i, b, _ in got if i is not None) == sorted((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows if r[0] is not None)
    assert len(got) == len(rows) and spans(spark, []) == []
    assert next(s for i, _, s in got if i == 13) == [(2, 0, 24, "assign")]


def test_long_runs_neither_crash_nor_take_long(spark, tmp_dir):
    """Runs of the rules' own alphabets: no recursion, no scan that starts again at each place."""
    runs = ["AB ", "eyJ", "eyJa.", "eyJa.eyJb ", "A", " ", "0123456789abcdef", "-----BEGIN ", "AKIA", "ghp_", "xoxb", "token ", "token=", "a-", "é"]
    parts = spark.createDataFrame([(i, run, 500_000 // len(run)) for i, run in enumerate(runs)], "doc_id long, run string, n int")
    S.stored(parts.select("doc_id", F.concat(F.lit("-----BEGIN "), F.expr("repeat(run, n)")).alias("text")), f"{tmp_dir}/long")
    began = time.monotonic()
    assert S.scan_documents(spark, spark.read.parquet(f"{tmp_dir}/long").repartition(8)).count() == len(runs)
    assert time.monotonic() - began < 60


def test_concurrent_scans_count_once(spark, tmp_dir):
    a, b = (S.BlobLedger(spark, f"{tmp_dir}/{x}") for x in "ab")
    rows = [(1, "token = abcdefgh", None, None, 0)]
    want = spans(spark, rows, ledger=a)
    spans(spark, rows, ledger=b)
    b.entries().write.mode("append").parquet(a.path)
    assert spans(spark, rows, ledger=a) == want


def test_ledger_scans_only_unseen_pairs(spark, tmp_dir):
    ledger = S.BlobLedger(spark, f"{tmp_dir}/ledger")
    first = [(1, "token = abcdefgh", None, None, 0), (2, "nothing", None, None, 0), (3, "token = abcdefgh", None, None, 0)]
    rules = S.RULES[:1]
    got = dict((i, s) for i, _, s in spans(spark, first, rules=rules, ledger=ledger))
    assert got[1] == got[3] == [(0, 0, 16, "assign")] and got[2] == []
    assert ledger.entries().count() == 2
    # Another version of a path, and the same text under another path: one new blob.
    second = [(1, "token = abcdefgh2", None, None, 0), (9, "nothing", None, None, 0)]
    spans(spark, second, rules=rules, ledger=ledger)
    assert ledger.entries().count() == 3
    spans(spark, second, rules=rules, ledger=ledger)
    assert ledger.entries().count() == 3
    # A new rule is run over blobs of the batch, the old one is not run again.
    both = (*rules, S.Rule("digits", "[0-9]{1,}"))
    got = dict((i, s) for i, _, s in spans(spark, second, rules=both, ledger=ledger))
    assert got[1] == [(0, 0, 17, "assign"), (16, 1, 17, "digits")] and got[9] == []
    new = [r["versions"] for r in ledger.entries().collect() if both[1].version in r["versions"]]
    assert new == [[both[1].version]] * 2
    # A changed pattern is another version.
    assert S.Rule("digits", "[0-9]{2,}").version != both[1].version


def test_no_python_in_the_plan(spark):
    plan = S.scan_documents(spark, odd.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
