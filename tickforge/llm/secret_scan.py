"""Secret scans over an incremental blob ledger (method 8), in Spark expressions only.

A text is addressed by its SHA-256, so every version of every path is a blob and
a blob is scanned once, however many paths hold it.  The ledger records which
(blob, rule version) pairs were scanned and what they gave; a run scans only
unseen pairs and joins the findings back to all paths.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import stored, table, whole_text, work_dir


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is
    shorter than ``least`` characters are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:12]}"


#: Fixed patterns: the first three are the base kinds, the others are added spans.
#: A run of one class that must have a least length is written with that length in
#: the pattern, which gives the same spans: a run too short has no longer part.
#: No pattern repeats a group, which Java matches by recursion, and none reads a run of
#: characters again from each place in it: jwt takes any run and drops those that do not go on.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+(\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)?", 1),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")
SPAN = "array<struct<kind:string,ord:int,at:int,gap:int,len:int,ok:boolean>>"
LEDGER_DDL = "blob binary, versions array<string>, spans array<struct<start:bigint,ord:int,end:bigint,kind:string,version:string>>"


def _pieces(text: Column, rule: Rule, order: int, due: Column) -> Column:
    """Per match: characters before it since the last one, its length, whether it counts."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    inner = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    rows = F.transform(
        F.arrays_zip(found.alias("m"), inner.alias("g"), F.slice(gaps, 1, F.size(found)).alias("s")),
        lambda x, i: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(order).alias("ord"),
            i.alias("at"),
            F.length(x["s"]).alias("gap"),
            F.length(x["m"]).alias("len"),
            (F.length(x["g"]) >= rule.least).alias("ok"),
        ),
    )
    return F.when(due & text.rlike(rule.pattern), rows).otherwise(F.array().cast(SPAN))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of blobs (blob, text, seen): one row per blob, spans sorted by
    (start, order of the rule).  Rules whose version is in ``seen`` are skipped."""
    due = [~F.array_contains("seen", rule.version) for rule in rules]
    arrays = [_pieces(F.col("text"), rule, i, d) for i, (rule, d) in enumerate(zip(rules, due, strict=True))]
    pieces = blobs.select("blob", F.explode_outer(F.concat(*arrays)).alias("p")).select("blob", "p.*")
    # One blob's matches of one rule: a start is the sum of all gaps and matches before it.
    run = Window.partitionBy("blob", "ord").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("len")).over(run)
    version = F.element_at(F.array(*[F.lit(r.version) for r in rules]), F.col("ord") + 1)
    spans = pieces.withColumn("end", end).withColumn(
        "span", F.when(F.col("ok"), F.struct((F.col("end") - F.col("len")).alias("start"), "ord", "end", "kind", version.alias("version")))
    )
    return spans.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings, as Parquet under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LEDGER_DDL).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def scan(self, paths: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans the texts of ``paths`` (blob, text) for all unseen pairs and records them."""
        # Copies thin out in each task before the shuffle; a blob held by a third of all paths is one row.
        blobs = paths.groupBy("blob").agg(F.first("text").alias("text"))
        known = self.entries()
        none = F.array().cast("array<string>")
        if known is None:
            blobs = blobs.withColumn("seen", none)
        else:
            seen = known.groupBy("blob").agg(F.flatten(F.collect_list("versions")).alias("seen"))
            blobs = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", none))
        wanted = F.array(*[F.lit(r.version) for r in rules])
        blobs = blobs.where(F.size(F.array_except(wanted, F.col("seen"))) > 0)
        fresh = scan_blobs(blobs, rules)
        if known is None:
            fresh = fresh.withColumn("versions", wanted)
        else:
            fresh = fresh.join(seen, "blob", "left").withColumn("versions", F.array_except(wanted, F.coalesce("seen", none)))
        fresh.select("blob", "versions", "spans").write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans) of the given rules for blobs with any; one row per blob.  Spans
        that two scans at a time recorded twice count once."""
        wanted = F.array(*[F.lit(r.version) for r in rules])
        order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))])
        found = self.entries().where(F.size("spans") > 0)
        spans = F.flatten(F.collect_list("spans"))
        mine = F.transform(
            F.filter(spans, lambda s: F.array_contains(wanted, s["version"])),
            lambda s: F.struct(s["start"].alias("start"), order[s["version"]].alias("ord"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
        return found.groupBy("blob").agg(F.array_sort(F.array_distinct(mine)).alias("spans")).where(F.size("spans") > 0)


def scan_documents(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: BlobLedger | None = None) -> DataFrame:
    """One row per document: doc_id, blob, spans (start, ord, end, kind; code points, end exclusive).

    Null text is the empty blob.  Null and repeated ids are plain paths: each row
    of ``docs`` gives one row, with the findings of its text.
    """
    path = work_dir(spark, "secrets")
    ledger = ledger or BlobLedger(spark, f"{path}/ledger")
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("blob", F.unhex(F.sha2("text", 256)))
    ledger.scan(rows.select("blob", "text"), rules)
    paths = stored(rows.select("doc_id", "blob"), f"{path}/paths")
    out = paths.join(ledger.findings(rules), "blob", "left")
    empty = F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>")
    return out.select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan_documents(spark, table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return got.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(_text(base), 256).alias("base_sha256"),
        _text(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """The same spans in SQL: text between matches from a split, matches by extraction."""

    def rule(i: int, r: Rule) -> str:
        p = r.pattern.replace("'", "''")
        return f"""SELECT rid, {i} AS ord, '{r.kind}' AS kind, i, length(m) AS len, length(g) >= {r.least} AS ok,
      sum(length(s) + length(m)) OVER (PARTITION BY rid ORDER BY i) AS fin
      FROM (SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs) AS g, unnest(ss[1:len(ms)]) AS s
            FROM (SELECT rid, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {r.group}) AS gs,
                         string_split_regex(t, '{p}') AS ss FROM d WHERE regexp_matches(t, '{p}')))"""

    parts = "\nUNION ALL\n".join(rule(i, r) for i, r in enumerate(RULES))
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({parts}),
k AS (SELECT rid, kind, ord, fin - len AS start, kind || ':' || (fin - len) || ':' || fin AS span FROM f WHERE ok),
a AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{x}') AS n_{x}" for x in BASE_KINDS)},
      string_agg(span, ',' ORDER BY start, ord) FILTER (kind IN ({base})) AS base, string_agg(span, ',' ORDER BY start, ord) AS spans
      FROM k GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{x}, 0) AS n_{x}' for x in BASE_KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)"""


ORACLE = _oracle()
