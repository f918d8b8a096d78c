"""Comparison of generated bars with reference bars (e.g. exchange klines).

Everything is one set of DataFrames over all symbols - no per-symbol loops.
Rows are aligned on (symbol, open_time) by default, or by position within a
symbol (``align="position"``) for references that carry no time column.
Compared columns: the 8 doubles rounded to 5 places and ``count`` as bigint;
a difference is abs(generated - reference) > tolerance with both sides
non-null.  Null-versus-value on aligned rows is reported separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KLINE_VALUE_COLUMNS
from ..session import shared_dir

DEFAULT_TOLERANCE = 1e-5
ROUND_DIGITS = 5
DOUBLE_COLUMNS = [c for c in KLINE_VALUE_COLUMNS if c != "count"]


def comparison_projection(df: DataFrame, keep=("symbol", "open_time"), index: bool = False) -> DataFrame:
    """The compared columns: doubles rounded to 5 places, count as bigint.  A column
    that ``df`` lacks is null (``schema_mismatch`` names it)."""
    have = set(df.columns)
    cols = [F.col(c) for c in keep]
    for c in KLINE_VALUE_COLUMNS:
        value = F.col(c) if c in have else F.lit(None)
        cols.append((value.cast("bigint") if c == "count" else F.round(value.cast("double"), ROUND_DIGITS)).alias(c))
    out = df.select(*cols)
    return with_bar_index(out) if index else out


def with_bar_index(df: DataFrame, series: str = "symbol", order: str = "open_time", name: str = "idx") -> DataFrame:
    """0-based position of each row within its series, ordered by ``order``.

    Two levels, so no window ever holds a whole series: rows per (series,
    day) are counted, a window over the small per-day table turns counts into
    offsets, and ``row_number`` runs within (series, day).  The offsets table
    has one row per series-day; AQE broadcasts it when its measured size is
    small and sort-merge joins it otherwise.
    """
    day = F.to_date(F.col(order))
    tagged = df.withColumn("_day", day)
    counts = tagged.groupBy(series, "_day").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(series).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(series, "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    in_day = Window.partitionBy(series, "_day").orderBy(order)
    joined = tagged.join(offsets, [series, "_day"])
    return joined.withColumn(name, (F.row_number().over(in_day) - 1 + F.col("_off")).cast("bigint")).drop("_day", "_off")


def schema_mismatch(generated: DataFrame, reference: DataFrame) -> list[str]:
    """Compared columns that a side lacks or holds in a type no number can be read from
    (driver-side, metadata only)."""
    out = []
    for side, df in (("generated", generated), ("reference", reference)):
        kinds = {f.name: f.dataType for f in df.schema.fields}
        for c in KLINE_VALUE_COLUMNS:
            if c not in kinds:
                out.append(f"{c}: missing in {side}")
            elif not isinstance(kinds[c], (T.NumericType, T.StringType)):
                out.append(f"{c}: {kinds[c].simpleString()} in {side}")
    return out


def _projected(generated: DataFrame, reference: DataFrame, align: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The compared columns of both sides with ``chunk``, the part of a series that has a digest:
    a day, or 4,096 positions."""
    by_place = align == "position"
    chunk = F.floor(F.col("idx") / 4096) if by_place else F.to_date("open_time")
    sides = [comparison_projection(df, index=by_place).withColumn("chunk", chunk) for df in (generated, reference)]
    return *sides, ["symbol", "idx"] if by_place else ["symbol", "open_time"]


def _paired(generated: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, gen, ref): rows of both sides as structs, null where a side has none.

    Each side is grouped by key first, so a bar that a side holds twice meets
    only as many rows as the other side has; the rest is missing there.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*KLINE_VALUE_COLUMNS))).alias(name))

    joined = side(generated, "gen").join(side(reference, "ref"), keys, "full_outer")
    none = F.array().cast(joined.schema["gen"].dataType)
    pairs = F.arrays_zip(F.coalesce("gen", none).alias("gen"), F.coalesce("ref", none).alias("ref"))
    return joined.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.gen", "p.ref")


def _aligned(generated: DataFrame, reference: DataFrame, align: str) -> tuple[DataFrame, list[str]]:
    gen, ref, keys = _projected(generated, reference, align)
    return _paired(gen, ref, keys), keys


def digests(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per (symbol, chunk): rows ``n``, an order-free checksum of the rounded rows (sums of the halves of
    a 64-bit hash, so that a row held twice counts twice) and ``odd``, rows that are no equal even to
    themselves: a null key, or a value that is no finite number.

    Hashing passes over nulls, so which values are null is hashed beside them.
    """
    nulls = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(KLINE_VALUE_COLUMNS)), F.lit(0))
    h = F.xxhash64(*keys[1:], *KLINE_VALUE_COLUMNS, nulls)
    odd = F.col(keys[0]).isNull() | F.col(keys[1]).isNull()
    for c in DOUBLE_COLUMNS:
        odd = odd | F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))
    return rows.groupBy("symbol", "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftright(h, 32)).alias("high"),
        F.count_if(odd).alias("odd"),
    )


def _differing(generated: DataFrame, reference: DataFrame, align: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(alike, joined, keys): the chunks whose digests agree (symbol, chunk, n), and the aligned rows of
    all others.  The digests, a row per symbol and chunk, are written to the shared folder;
    rows of chunks that agree are read once, hashed and never shuffled."""
    spark = generated.sparkSession
    gen, ref, keys = _projected(generated, reference, align)
    columns = ["n", "low", "high", "odd"]
    a, b = (digests(x, keys).select("symbol", "chunk", F.struct(*columns).alias(name)) for x, name in ((gen, "a"), (ref, "b")))
    same = F.coalesce((F.col("a") == F.col("b")) & (F.col("a.odd") == 0), F.lit(False))
    both = a.join(b, ["symbol", "chunk"], "full_outer").select("symbol", "chunk", F.col("a.n").alias("n"), same.alias("same"))
    path = shared_dir(spark, "digests")
    both.write.parquet(path)
    both = spark.read.schema(both.schema).parquet(path)
    others = both.where(~F.col("same")).select(F.col("symbol").alias("_s"), F.col("chunk").alias("_c")).distinct()

    def of_others(rows: DataFrame) -> DataFrame:
        return rows.join(others, F.col("symbol").eqNullSafe(F.col("_s")) & F.col("chunk").eqNullSafe(F.col("_c")), "left_semi")

    return both.where("same"), _paired(of_others(gen), of_others(ref), keys), keys


def full_outer(generated: DataFrame, reference: DataFrame, align: str = "time") -> DataFrame:
    """Aligned rows, generated columns suffixed ``_gen`` and reference ``_ref``."""
    joined, keys = _aligned(generated, reference, align)
    values = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in ("gen", "ref") for c in KLINE_VALUE_COLUMNS]
    return joined.select(*keys, *values)


def row_counts(generated: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows per symbol on each side (two partial aggregates, one small join)."""
    g = generated.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_generated"))
    r = reference.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_reference"))
    j = g.join(r, "symbol", "full_outer")
    gen, ref = F.coalesce("rows_generated", F.lit(0)), F.coalesce("rows_reference", F.lit(0))
    return j.select("symbol", gen.alias("rows_generated"), ref.alias("rows_reference"), (gen == ref).alias("same_count"))


def _missing_rows(joined: DataFrame, keys: list[str]) -> DataFrame:
    row = F.coalesce("gen", "ref")
    lacking = F.when(F.col("gen").isNull(), "generated").otherwise("reference")
    one_sided = joined.where(F.col("gen").isNull() | F.col("ref").isNull())
    return one_sided.select(lacking.alias("missing_in"), *keys, *[row.getField(c).alias(c) for c in ("open", "close", "volume")])


def missing_rows(generated: DataFrame, reference: DataFrame, align: str = "time") -> DataFrame:
    """Rows present on one side only; ``missing_in`` names the side lacking them."""
    return _missing_rows(*_differing(generated, reference, align)[1:])


def _cells(joined: DataFrame, keys: list[str], wanted) -> DataFrame:
    """(keys, column, generated, reference) of aligned cells that ``wanted`` accepts; the
    others are filtered out before rows are multiplied."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(f"gen.{c}").cast("double").alias("generated"), F.col(f"ref.{c}").cast("double").alias("reference")
            )
            for c in KLINE_VALUE_COLUMNS
        ]
    )
    both = joined.where(F.col("gen").isNotNull() & F.col("ref").isNotNull())
    return both.select(*keys, F.explode(F.filter(cells, lambda x: wanted(x["generated"], x["reference"]))).alias("d")).select(*keys, "d.*")


def _differs(tolerance: float):
    return lambda g, r: g.isNotNull() & r.isNotNull() & (F.abs(g - r) > F.lit(tolerance))


def _one_null(g, r):
    return g.isNull() != r.isNull()


def value_diffs(generated: DataFrame, reference: DataFrame, tolerance: float = DEFAULT_TOLERANCE, align: str = "time") -> DataFrame:
    """(keys, column, generated, reference) where both are non-null and differ by more than ``tolerance``."""
    return _cells(*_differing(generated, reference, align)[1:], _differs(tolerance))


def null_mismatches(generated: DataFrame, reference: DataFrame, align: str = "time") -> DataFrame:
    """Aligned cells where exactly one side is null."""
    return _cells(*_differing(generated, reference, align)[1:], _one_null)


def first_diffs(diffs: DataFrame, n: int = 10, order: str = "open_time") -> DataFrame:
    """First ``n`` differences per (symbol, column) - a report limit by design.

    Two phases so no window holds a symbol's whole history: the first ``n``
    per (symbol, column, day) survive a window bounded by one day of bars,
    then the first ``n`` of those survivors per (symbol, column) are kept.
    Both orders are the same, so the result equals a single ranking.
    """
    is_time = dict(diffs.dtypes)[order].startswith("timestamp")
    chunk = F.to_date(F.col(order)) if is_time else F.floor(F.col(order) / F.lit(86_400))
    local = Window.partitionBy("symbol", "column", "_chunk").orderBy(order)
    survivors = diffs.withColumn("_chunk", chunk).withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= n)
    w = Window.partitionBy("symbol", "column").orderBy(order)
    ranked = survivors.drop("_chunk", "_r").withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.where(F.col("rank") <= n)


def _verdict(alike: DataFrame, joined: DataFrame, same_schema: bool, tolerance: float) -> DataFrame:
    has_gen, has_ref = F.col("gen").isNotNull(), F.col("ref").isNotNull()
    pairs = [(F.col(f"gen.{c}").cast("double"), F.col(f"ref.{c}").cast("double")) for c in KLINE_VALUE_COLUMNS]
    cells = lambda test: F.sum(F.when(has_gen & has_ref, sum((F.when(test(g, r), 1).otherwise(0) for g, r in pairs), F.lit(0))).otherwise(0)).cast("bigint")
    rows = joined.groupBy("symbol").agg(
        F.count_if(has_gen).alias("rows_generated"),
        F.count_if(has_ref).alias("rows_reference"),
        F.count_if(~has_gen).alias("missing_in_generated"),
        F.count_if(~has_ref).alias("missing_in_reference"),
        cells(_differs(tolerance)).alias("differing_cells"),
        cells(_one_null).alias("null_cells"),
        F.bool_and(F.coalesce(F.col("gen").eqNullSafe(F.col("ref")), F.lit(False))).alias("exact"),
    )
    none = [F.lit(0).cast("bigint").alias(c) for c in rows.columns[3:7]]
    whole = alike.groupBy("symbol").agg(F.sum("n").alias("n")).select("symbol", F.col("n").alias("rows_generated"), F.col("n").alias("rows_reference"), *none, F.lit(True).alias("exact"))
    per = rows.unionByName(whole).groupBy("symbol").agg(*[F.sum(c).alias(c) for c in rows.columns[1:7]], F.bool_and("exact").alias("_exact"))
    per = per.select("symbol", *rows.columns[1:7], F.lit(same_schema).alias("same_schema"), (F.lit(same_schema) & F.col("_exact")).alias("exact"))
    faults = F.col("missing_in_generated") + F.col("missing_in_reference") + F.col("differing_cells") + F.col("null_cells")
    equal = F.col("same_schema") & (faults == 0)
    return per.select("*", equal.alias("equal"), F.when(equal, 0).otherwise(1).alias("status"))


def verdict(generated: DataFrame, reference: DataFrame, tolerance: float = DEFAULT_TOLERANCE, align: str = "time") -> DataFrame:
    """Per symbol: rows on each side, rows missing on either side, cells that differ,
    cells null on one side only, ``same_schema``, ``exact`` (every compared value the
    same, nulls included), ``equal`` (no fault within the tolerance) and
    ``status`` 0 (pass) / 1 (fail).  A bar held twice is missing once on the other side.

    Days of a symbol whose digests agree are settled by them; only the rows of the others
    are joined (one full outer join) and counted.
    """
    alike, joined, _ = _differing(generated, reference, align)
    return _verdict(alike, joined, not schema_mismatch(generated, reference), tolerance)


def compare_bars(generated: DataFrame, reference: DataFrame, tolerance: float = DEFAULT_TOLERANCE, align: str = "time") -> dict[str, DataFrame]:
    """All comparison frames.  The days whose digests differ are joined once, their aligned rows
    are written to the shared folder, and every frame derives from them."""
    spark = generated.sparkSession
    alike, joined, keys = _differing(generated, reference, align)
    path = shared_dir(spark, "aligned")
    joined.write.parquet(path)
    joined = spark.read.schema(joined.schema).parquet(path)
    diffs = _cells(joined, keys, _differs(tolerance))
    return {
        "counts": row_counts(generated, reference),
        "missing": _missing_rows(joined, keys),
        "diffs": diffs,
        "nulls": _cells(joined, keys, _one_null),
        "first_diffs": first_diffs(diffs, order=keys[1]),
        "verdict": _verdict(alike, joined, not schema_mismatch(generated, reference), tolerance),
    }
