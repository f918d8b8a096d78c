"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import functions as F

DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; they must survive as plain columns.
CLASHES = ["size", "target", "digest", "class", "label", "copies", "text_key", "spans", "blob", "score", "n_tokens"]

LONG = " ".join(f"word{i % 977} und" for i in range(30_000))
TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "a", "A", "12 34", "¡Él está aquí!", "日本語 テキスト", "été été", LONG,
    "the quick brown fox jumps over the lazy dog and runs", "the quick brown fox jumps over the lazy dog and runs",
    "The  quick brown fox\njumps over the lazy dog and runs ", 'x secret = "abcdef123456" y', "Licensed under the MIT License.",
]


def rows(texts=TEXTS):
    out = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    out.append((None, "a text without an id", "en", "s1", 20))
    out.append((None, None, None, None, None))
    out += [out[3], out[10], out[10]]  # rows that repeat
    return out


def frame(spark, data=None, clash=True):
    df = spark.createDataFrame(rows() if data is None else data, DDL)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}) if clash else df


def empty(spark):
    return spark.createDataFrame([], DDL)
