"""Language identification by cross-parsing entropy (method 10).

A bounded sample of labelled text per language is held as a suffix automaton.  A
text is cut into phrases, each the longest match in the language's sample; the
more phrases, the less the text resembles it.  Phrases weigh log2 of the sample
length, which is the cost of naming a place in it, so

    bits(language) = phrases * log2(sample length) / text length

estimates the cross entropy, and the language with the fewest bits wins.  A phrase
weighs no less than a symbol spelt out, and a symbol that the language's sample lacks
weighs the same in all languages, so that a label with little text is no cheap parse.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_chunks, table, text_buffers, to_workers, worker_cache

UND = "und"
#: Bounds of the training sample: rows and symbols per language, symbols in all.
ROWS_PER_LANG = 256
CHARS_PER_LANG = 30_000
CHARS_IN_ALL = 3_000_000
#: Letters with a symbol of their own; others share HASHED symbols.
OWN_LETTERS, HASHED = 120, 64
#: A text is parsed in strides of so many symbols, each from the automaton's root.
STRIDE = 256
LANES = 4096
#: Bits of a symbol spelt out.
SPELT = math.log2(OWN_LETTERS + HASHED + 1)


def _letters():
    """Folded code point of each letter or mark, 0 for all else; and which are letters."""
    import sys
    import unicodedata

    import numpy as np

    fold = np.zeros(sys.maxunicode + 1, np.uint32)
    letter = np.zeros(sys.maxunicode + 1, bool)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            fold[c] = ord(chr(c).lower()[0])
            letter[c] = kind == "L"
    return fold, letter


def letter_tables():
    return worker_cache(("langid", "letters"), _letters)


def code_points(data, offsets):
    """Code points of rows of UTF-8 bytes, and the rows' offsets among them."""
    import numpy as np

    data = data[int(offsets[0]) : int(offsets[-1])]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return points, heads[offsets - offsets[0]]


def normalise(points, bounds):
    """Folded letters with one 0 between words, none at a row's start; new bounds; letters per row."""
    import numpy as np

    fold, letter = letter_tables()
    folded = fold[points]
    before = np.zeros(len(folded), np.uint32)
    before[1:] = folded[:-1]
    first = bounds[:-1][bounds[:-1] < len(folded)]
    before[first] = 0
    keep = (folded != 0) | (before != 0)
    total = np.zeros(len(folded) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    seen = np.zeros(len(folded) + 1, np.int64)
    np.cumsum(letter[points], out=seen[1:])
    return folded[keep], total[bounds], np.diff(seen[bounds])


class SuffixAutomaton:
    """All substrings of a sequence of symbols, built online."""

    def __init__(self, symbols):
        self.next, self.link, self.length = [{}], [-1], [0]
        last = 0
        for c in symbols:
            new = self._state({}, 0, self.length[last] + 1)
            p = last
            while p != -1 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][c]
                if self.length[q] == self.length[p] + 1:
                    self.link[new] = q
                else:
                    twin = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
                    while p != -1 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = self.link[p]
                    self.link[q] = self.link[new] = twin
            last = new

    def _state(self, following, link, length):
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def parser(self, width: int):
        """Flat table: entry state * width + symbol holds twice the next row's start, plus 1
        where a new phrase begins with the symbol.  Symbol 0 pads.  The last state has
        no phrase open: it is the first one, and follows a symbol that the sample lacks."""
        import numpy as np

        n = len(self.next)
        kind = np.int32 if (n + 1) * width < 1 << 29 else np.int64
        begin = np.full(width, n, kind)
        for c, t in self.next[0].items():
            begin[c] = t
        out = np.empty((n + 1, width), kind)
        out[:] = begin * (width * 2) + 1
        for s, following in enumerate(self.next):
            if following:
                out[s, list(following)] = np.fromiter(following.values(), kind, len(following)) * (width * 2)
        out[:, 0] = np.arange(n + 1, dtype=kind) * (width * 2)
        return out.ravel()


class Model:
    """Parsers of all languages over one alphabet.  Symbols: 0 pads, 1 is a gap between words."""

    def __init__(self, samples: dict[str, str]):
        import numpy as np

        from collections import Counter

        texts = {k: self._fold(samples[k]) for k in sorted(samples)}
        # A label without any letter is no language.
        letter = letter_tables()[1]
        self.langs = [k for k in texts if letter[texts[k]].any()]
        texts = {k: texts[k] for k in self.langs}
        seen = Counter(c for t in texts.values() for c in t.tolist() if c)
        own = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:OWN_LETTERS]]
        others = HASHED if len(seen) > len(own) else 1
        self.width = 2 + len(own) + others
        self.symbol = (2 + len(own) + np.arange(0x110000) % others).astype(np.uint8)
        self.symbol[0] = 1
        self.symbol[own] = np.arange(2, 2 + len(own))
        self.parsers, self.cost = [], []
        self.lacks = np.ones((len(self.langs), self.width))
        for i, k in enumerate(self.langs):
            symbols = self.symbol[texts[k]].tolist()
            self.parsers.append(SuffixAutomaton(symbols).parser(self.width))
            self.cost.append(max(SPELT, math.log2(len(symbols) + 2)))
            self.lacks[i, symbols] = 0
        self.lacks[:, 0] = 0
        # What a lacking symbol weighs beyond a phrase, for the same weight in all languages.
        self.lacks *= np.array([max(self.cost) - c for c in self.cost])[:, None] if self.cost else 0

    @staticmethod
    def _fold(text: str):
        import numpy as np

        raw = np.frombuffer(text.encode(), np.uint8)
        return normalise(*code_points(raw, np.array([0, len(raw)], np.int64)))[0]

    def phrases(self, symbols):
        """Phrases of each row of a (rows, STRIDE) array of symbols, by language."""
        import numpy as np

        out = np.zeros((len(self.langs), len(symbols)), np.int64)
        for a in range(0, len(symbols), LANES):
            block = np.ascontiguousarray(symbols[a : a + LANES].T)
            longest = int((block != 0).any(axis=1).sum())
            for i, parser in enumerate(self.parsers):
                at = np.full(block.shape[1], len(parser) - self.width, parser.dtype)
                count = np.zeros(block.shape[1], parser.dtype)
                for row in block[:longest]:
                    step = parser.take(at + row)
                    count += step & 1
                    at = step >> 1
                out[i, a : a + LANES] = count
        return out

    def bits(self, data, offsets, level: bool = False):
        """(bits per symbol as languages x rows, letters per row) of UTF-8 rows; ``level``
        weighs the symbols that a sample lacks the same in all languages."""
        import numpy as np

        folded, bounds, letters = normalise(*code_points(data, offsets))
        size = np.diff(bounds)
        strides = -(-size // STRIDE)
        first = np.zeros(len(size) + 1, np.int64)
        np.cumsum(strides, out=first[1:])
        total, beyond = np.zeros((len(self.langs), len(size))), 0.0
        if first[-1]:
            grid = np.zeros((first[-1], STRIDE), np.uint8)
            row = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(folded)) - bounds[row]
            grid[first[row] + place // STRIDE, place % STRIDE] = self.symbol[folded]
            found = self.phrases(grid)
            some = np.flatnonzero(strides)
            total[:, some] = np.add.reduceat(found, first[some], axis=1)
            if level and self.lacks.any():
                cells = np.bincount(row * self.width + self.symbol[folded], minlength=len(size) * self.width)
                beyond = self.lacks @ cells.reshape(len(size), self.width).T
        return (total * np.array(self.cost)[:, None] + beyond) / np.maximum(size, 1), letters

    def predict(self, data, offsets):
        """Per row: language, score, bits, letters.  Ties go to the first language by name."""
        import numpy as np

        bits, letters = self.bits(data, offsets, level=True)
        if not self.langs:
            n = len(letters)
            return [UND] * n, np.zeros(n), np.zeros(n), letters
        best = bits.argmin(axis=0)
        least = bits.min(axis=0)
        if len(self.langs) > 1:
            second = np.partition(bits, 1, axis=0)[1]
            score = second / np.maximum(least + second, 1e-12)
        else:
            score = np.ones(len(best))
        known = letters > 0
        return [self.langs[b] if k else UND for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0), np.where(known, least, 0.0), letters


def learn(labelled: DataFrame, rows_per_lang: int = ROWS_PER_LANG, chars_per_lang: int = CHARS_PER_LANG, chars_in_all: int = CHARS_IN_ALL) -> dict[str, str]:
    """Sample text per language from labelled rows (doc_id, text, lang), null labels and
    texts without a letter left out; a text counts from its first letter.

    The rows with the smallest hashes, at most ``rows_per_lang`` distinct ones for
    each language, ranked within hash buckets first so that a language with most
    rows is not sorted in one task.  Only this bounded sample reaches the driver.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64(F.lit("lang"), "doc_id", "text").alias("h"))
    keys = rows.select("lang", "h").distinct().withColumn("bucket", F.pmod(F.col("h"), F.lit(64)))
    part = keys.withColumn("r", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("h"))).where(F.col("r") <= rows_per_lang)
    top = part.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= rows_per_lang)
    cuts = {r["lang"]: r["cut"] for r in top.groupBy("lang").agg(F.max("h").alias("cut")).collect()}
    if not cuts:
        return {}
    cut = F.create_map(*[F.lit(x) for pair in sorted(cuts.items()) for x in pair])
    limit = max(256, min(chars_per_lang, chars_in_all // len(cuts)))
    chosen = rows.where(F.col("h") <= cut[F.col("lang")]).groupBy("lang", "h").agg(F.first("text").alias("text"))
    samples: dict[str, list[str]] = {}
    room = dict.fromkeys(cuts, limit)
    # A row gives at most a fifth of the sample, so that one very long text is not all of it.
    for r in chosen.select("lang", "h", F.substring(F.regexp_replace("text", r"^\P{L}++", ""), 1, limit // 5).alias("text")).orderBy("lang", "h").toLocalIterator():
        if room[r["lang"]] > 0:
            samples.setdefault(r["lang"], []).append(r["text"][: room[r["lang"]]])
            room[r["lang"]] -= len(r["text"])
    return {k: "\n".join(v) for k, v in samples.items()}


def predict(docs: DataFrame, samples: dict[str, str], keep_columns: bool = False) -> DataFrame:
    """Adds _tf_lang, _tf_score, _tf_bits and _tf_letters to doc_id, or to all columns of ``docs``.

    ``und`` with score 0 where the text is null or has no letter, and where no
    language was learned.  ``score`` is second / (best + second) of the bits per
    symbol: 0.5 for a tie, 1 with a single language.
    """
    key = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        model = worker_cache(("langid", key), lambda: Model(samples))
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in row_chunks(offsets, 1 << 19):
                lang, score, bits, letters = model.predict(data, offsets[a : b + 1])
                part = batch.slice(a, b - a)
                columns = part.columns if keep_columns else [part.column("doc_id")]
                names = part.schema.names if keep_columns else ["doc_id"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lang, pa.string()), pa.array(np.asarray(score, np.float64)), pa.array(np.asarray(bits, np.float64)), pa.array(letters, pa.int64())],
                    [*names, "_tf_lang", "_tf_score", "_tf_bits", "_tf_letters"],
                )

    src = docs if keep_columns else docs.select("doc_id", "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema) if keep_columns else f"doc_id {src.schema['doc_id'].dataType.simpleString()}"
    return to_workers(src, run, f"{fields}, _tf_lang string, _tf_score double, _tf_bits double, _tf_letters long")


def held_out(doc_id):
    """Rows that take no part in learning: crc32 of the id as text, mod 4, is 2.  A null id does."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits; learned from
    the rows that are not held out."""
    known = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    got = predict(docs, learn(known))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_tf_lang").alias("lang_pred"), F.col("_tf_score").alias("score"), F.col("_tf_bits").alias("bits"))


def drop_unidentified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents whose text has no language (null, or without a letter) go.
    The others stay, also where no language was learned."""
    known = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    got = predict(docs, learn(known), keep_columns=True)
    return got.where(F.col("_tf_letters") > 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "documents"))
