"""Mixing sources to target weights by entropy balancing (method 9).

Each document gets a rate r = cap / (1 + (cap - 1) * exp(-lambda_s * x)), its size
x tilted exponentially in the odds: of all rates between 0 and cap that meet
the token targets, these stay closest to one copy each in relative entropy.
The dual is convex with one variable per source and is solved by distributed
Newton iterations over the exact (source, size) histogram; the rates are then
rounded into copies by systematic sampling along (size, hash of the document),
and the words that rounding leaves are made up from single documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, stored, table, whole_text, work_dir

#: Rates are kept in millionths, so that running sums are exact integers.
UNIT = 1_000_000
#: Hash salts per (source, size) cell, so that no cell is ranked in one task.
SALTS = 1024
TOLERANCE = 1e-9
MAX_ITERATIONS = 60
#: Steps that make up what rounding leaves.
REPAIRS = 12
#: Part of its target by which a source may still be off before another step.
NEAR = 0.001


def n_words(text: Column) -> Column:
    """Maximal runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def targets(sources: DataFrame, cap: float, weights: tuple[float, ...]) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn.  The total size
    is shared by weight; a target stops at cap * source_size and the excess goes
    to the others by weight.  Sorting by cap * size / weight makes the capped
    sources a prefix, so the level of the rest follows from running sums.
    Sorting all sources takes one row each, whatever the number of documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    df = sources.withColumn("w", w).withColumn("ceiling", F.lit(float(cap)) * F.col("source_size")).withColumn("ratio", F.col("ceiling") / F.col("w"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("ratio").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn(
        "tau", (F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    )
    level = F.max(F.when(F.col("tau") <= F.col("ratio"), F.col("tau"))).over(everything)
    return df.withColumn("target", F.least("ceiling", F.coalesce(level * F.col("w"), F.col("ceiling")))).drop("w", "ceiling", "ratio", "tau")


def _rate(tilt: Column, cap: float) -> Column:
    return F.lit(float(cap)) / (F.lit(1.0) + F.lit(cap - 1.0) * F.exp(-F.least(F.greatest(tilt, F.lit(-700.0)), F.lit(700.0))))


def solve(spark: SparkSession, cells: DataFrame, sources: DataFrame, cap: float, path: str) -> DataFrame:
    """(skey, lambda) by Newton steps on the dual, one aggregate of the histogram each.

    A step that leaves the bracket known so far is replaced by its middle.  A
    target at its ceiling needs rate cap everywhere (lambda = infinity), one of
    zero needs none.
    """
    goal = F.col("target")
    full = F.lit(float(cap)) * F.col("source_size")
    state = sources.select(
        "skey",
        "target",
        F.col("scale"),
        F.when(goal <= 0, F.lit(float("-inf"))).when(goal >= full * (1 - 1e-12), F.lit(float("inf"))).otherwise(F.lit(0.0)).alias("lam"),
        F.lit(-1e6).alias("lo"),
        F.lit(1e6).alias("hi"),
        F.lit(1.0).alias("err"),
    )
    state = stored(state, f"{path}/state-0")
    free = ~F.col("lam").isin(float("inf"), float("-inf"))
    for i in range(1, MAX_ITERATIONS + 1):
        x = F.col("size") / F.col("scale")
        r = _rate(F.col("lam") * x, cap)
        tokens = F.col("n") * F.col("size")
        sums = (
            cells.where("size > 0")
            .join(state.where(free).select("skey", "lam", "scale"), "skey")
            .groupBy("skey")
            .agg(F.sum(tokens * r).alias("g"), F.sum(tokens * x * r * (1 - r / cap)).alias("h"))
        )
        gap = F.col("g") - F.col("target")
        step = F.col("lam") - gap / F.col("h")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        near = F.greatest(lo, F.col("lam") - 8), F.least(hi, F.col("lam") + 8)
        new = F.when((step > near[0]) & (step < near[1]), step).otherwise((near[0] + near[1]) / 2)
        done = F.abs(gap) <= TOLERANCE * F.col("target")
        state = stored(
            state.join(sums, "skey", "left").select(
                "skey",
                "target",
                "scale",
                F.when(free & F.col("g").isNotNull() & ~done, new).otherwise(F.col("lam")).alias("lam"),
                F.when(F.col("g").isNotNull(), lo).otherwise(F.col("lo")).alias("lo"),
                F.when(F.col("g").isNotNull(), hi).otherwise(F.col("hi")).alias("hi"),
                F.when(free & F.col("g").isNotNull(), F.abs(gap) / F.col("target")).otherwise(F.lit(0.0)).alias("err"),
            ),
            f"{path}/state-{i}",
        )
        worst = state.agg(F.max("err")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("skey", F.col("lam").alias("lambda"))


def _cell_copies(cells: DataFrame, path: str, cap: int) -> DataFrame:
    """Adds ``copies`` per cell (skey, size, n, units, target, ...).

    Systematic sampling along the sizes of a source: the k-th copy falls where the
    running sum of rates passes k - 1/2.  The words this leaves over or under
    the target, at most about one document, are then made up from the largest
    cells that fit, in a few distributed steps of falling size.
    """
    by_size = Window.partitionBy("skey").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda x: F.expr(f"({x} + {UNIT // 2}) div {UNIT}")
    cells = (
        cells.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("units")).over(by_size), F.lit(0).cast("long")))
        .withColumn("copies", upto("before + n * units") - upto("before"))
        .drop("before")
    )
    cells = stored(cells, f"{path}/copies-0")
    state = cells.groupBy("skey").agg(
        (F.round(F.first("target")).cast("long") - F.sum(F.col("copies") * F.col("size"))).alias("left"), F.max("size").alias("last")
    ).withColumn("last", F.col("last") + 1)
    for i in range(1, REPAIRS + 1):
        room = F.when(F.col("left") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") < F.col("last")) & (F.col("size") <= F.abs("left")) & (room > 0)
        pick = cells.join(state, "skey").where(fits).groupBy("skey").agg(F.max("size").alias("_size"))
        change = F.when(F.col("size") == F.col("_size"), F.least(room, F.expr("abs(left) div size")) * F.signum("left").cast("long")).otherwise(F.lit(0).cast("long"))
        joined = cells.join(state.join(pick, "skey", "left"), "skey").withColumn("_change", F.coalesce(change, F.lit(0).cast("long")))
        cells = stored(
            joined.select(*[c for c in cells.columns if c != "copies"], (F.col("copies") + F.col("_change")).alias("copies"), "left", "last", "_size"),
            f"{path}/copies-{i}",
        )
        state = cells.groupBy("skey").agg(
            (F.round(F.first("target")).cast("long") - F.sum(F.col("copies") * F.col("size"))).alias("left"),
            F.coalesce(F.first("_size"), F.lit(0).cast("long")).alias("last"),
        )
        cells = cells.drop("left", "last", "_size")
        goal = F.first("target").alias("goal")
        off = cells.groupBy("skey").agg(goal, F.sum(F.col("copies") * F.col("size")).alias("words")).agg(F.max(F.abs(F.col("goal") - F.col("words")) / F.greatest("goal", F.lit(1.0)))).first()[0]
        if off is None or off <= NEAR:
            break
    return cells


def mix(spark: SparkSession, docs: DataFrame, cap: int = 3, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """One row per document: doc_id, text_key, source, size, source_size, target, rate, copies.

    ``copies`` is at most ``cap``.  Null text has size 0; documents of size 0
    keep one copy, which adds no words.  Null is a source of its own, sorted
    last.  Equal rows share their copies in any order.  Reruns agree: all
    order comes from hashes of the id and the text.
    """
    path = work_dir(spark, "mixing")
    text = whole_text()
    sizes = stored(
        docs.select("doc_id", F.xxhash64(text).alias("text_key"), "source", _source_key(F.col("source")).alias("skey"), n_words(text).alias("size")),
        f"{path}/sizes",
    )
    cells = stored(sizes.groupBy("skey", "size").agg(F.count("*").alias("n"), F.first("source").alias("source")), f"{path}/cells")
    per_source = cells.groupBy("skey").agg(
        F.first("source").alias("source"),
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.try_divide(F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")), F.sum(F.col("n") * F.col("size"))).alias("scale"),
    )
    sources = stored(targets(per_source, cap, weights), f"{path}/sources")
    lam = solve(spark, cells, sources, cap, path)

    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.when(F.col("lambda") == float("inf"), F.lit(float(cap)))
        .when(F.col("lambda") == float("-inf"), F.lit(0.0))
        .otherwise(_rate(F.col("lambda") * F.col("size") / F.col("scale"), cap))
    )
    rated = (
        cells.drop("source")
        .join(sources.select("skey", "scale", "source_size", "target"), "skey")
        .join(lam, "skey")
        .select("skey", "size", "n", "source_size", "target", F.round(rate * UNIT).cast("long").alias("units"))
    )
    rated = _cell_copies(rated, path, cap)

    # Within a cell the copies go round evenly in the order of salt and hash, so that
    # a document has the cell's mean number, rounded up or down.
    key = [F.col("doc_id"), F.col("text_key")]
    salted = sizes.withColumn("order", F.xxhash64(F.lit("mix"), *key)).withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), *key), F.lit(SALTS)))
    in_cell = Window.partitionBy("skey", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("skey", "size", "salt")
        .agg(F.count("*").alias("m"))
        .withColumn("offset", F.coalesce(F.sum("m").over(in_cell), F.lit(0).cast("long")))
        .join(rated.withColumnRenamed("copies", "in_cell"), ["skey", "size"])
        .select("skey", "size", "salt", "source_size", "target", "units", "n", "in_cell", "offset")
    )
    offsets = stored(offsets, f"{path}/offsets")
    within = Window.partitionBy("skey", "size", "salt").orderBy("order", "doc_id", "text_key")
    ranked = salted.withColumn("j", F.row_number().over(within).cast("long")).join(offsets, ["skey", "size", "salt"])
    # copies of the first k of n documents are k * q + (k * rest) div n, q and rest from in_cell / n.
    upto = lambda k: F.expr(f"({k}) * (in_cell div n) + (cast(({k}) as decimal(38,0)) * (in_cell % n)) div n")
    return ranked.select(
        "doc_id",
        "text_key",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("units") / F.lit(float(UNIT))).alias("rate"),
        (upto("offset + j") - upto("offset + j - 1")).cast("long").alias("copies"),
    )


def repeat(spark: SparkSession, docs: DataFrame, cap: int = 3, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it has copies, all columns kept.

    Rows that repeat id, text and source lie in one cell, so their copies differ by one at
    most: all get the least, and the first few of them one more.  The texts are
    shuffled once, by the key that numbers such rows and meets their copies.
    """
    path = work_dir(spark, "mix-rows")
    key = ["_tf_id", "_tf_text", "_tf_source"]
    an_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))  # no null, which a join would not match
    mine = mix(spark, docs, cap, weights).select(an_id.alias("_tf_id"), F.col("text_key").alias("_tf_text"), _source_key(F.col("source")).alias("_tf_source"), "copies")
    least = F.min("copies")
    copies = mine.groupBy(*key).agg(least.alias("_tf_least"), (F.sum("copies") - F.count("*") * least).alias("_tf_more"))
    copies = stored(copies, f"{path}/copies")
    rows = docs.withColumns({"_tf_id": an_id, "_tf_text": F.xxhash64(whole_text()), "_tf_source": _source_key(F.col("source"))})
    rows = rows.withColumn("_tf_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1))))
    times = F.col("_tf_least") + (F.col("_tf_n") <= F.col("_tf_more")).cast("long")
    joined = rows.join(copies, key).withColumn("_tf_times", times.cast("int")).where("_tf_times > 0")
    return joined.withColumn("_tf_copy", F.explode(F.sequence(F.lit(1), F.col("_tf_times")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mix(spark, table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")
