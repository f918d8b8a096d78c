"""BPE encoding and decoding as bounded-lookahead streaming transducers (method 7).

Encoding: how far text to the right can change a token is bounded by the merge
list alone.  If the segmentation left of a point is settled up to a boundary, a
merge (u, v) moves that boundary left by |u| only if v starts at it; and a later
merge can move it again only if its v begins with the token that moved it.  The
longest such chain is the sufficient lookahead.  A window is encoded,
tokens that end at least the lookahead before its end are stable and emitted,
and the window moves on, so memory stays constant however long a run is.

Many runs are windows of one array and are merged in lockstep.  Text between
white space is encoded once per batch and kept in a bounded cache.

Decoding: ids are fed to a state machine that holds at most one unfinished
UTF-8 sequence.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, to_workers, whole_text, worker_cache

#: White space of the vocabulary's patterns, code points spelt out.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries of one generation of the cache of encoded chunks, and longest chunk kept.
CACHE, LONGEST = 100_000, 128
#: Ids that are decoded at a time.
DECODED = 1 << 16
NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else one from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Merges:
    """A merge list: ranks of symbol pairs, lookahead, and lockstep merging of windows."""

    def __init__(self, pairs: list[tuple[int, int]], results: list[int], width: list[int], n_symbols: int):
        """``pairs`` by rank; ``width`` is the length of each symbol in bytes."""
        self.result = np.array(results, np.int32)
        self.width = np.array(width, np.int64)
        self.longest = int(max(width))
        bits = 1
        while 1 << bits < 8 * len(pairs) + 8:
            bits += 1
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.key = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.probes = 1
        for r, (a, b) in enumerate(pairs):
            k = (a << 32) | b
            at, probe = self._slot(np.array([k], np.int64))[0], 1
            while self.key[at] not in (-1, k):
                at, probe = (at + 1) & self.mask, probe + 1
            if self.key[at] == -1:
                self.key[at], self.rank[at] = k, r
            self.probes = max(self.probes, probe)
        self.lookahead = self._sufficient_lookahead(pairs, results, n_symbols)
        self.window = 2 * (self.lookahead + self.longest) if self.lookahead is not None else None

    def _slot(self, keys):
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _sufficient_lookahead(self, pairs, results, n_symbols):
        """Bytes after a token's end that settle it, or None if the list is not in order of
        dependence (a merge that uses a symbol made by a later one)."""
        made = {}
        for r, s in enumerate(results):
            made.setdefault(s, []).append(r)
        left_of = {}
        for r, (a, b) in enumerate(pairs):
            if any(m >= r for x in (a, b) for m in made.get(x, ())):
                return None
            left_of.setdefault(results[r], []).append(a)
        reach = [0] * n_symbols  # farthest move of a boundary that ended with this symbol right of it
        best = 0
        for a, b in pairs:
            todo, seen, move = [b], {b}, 0
            while todo:  # b and all it begins with
                x = todo.pop()
                move = max(move, reach[x])
                for y in left_of.get(x, ()):
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
            reach[a] = max(reach[a], move + int(self.width[a]))
            best = max(best, reach[a])
        return best

    def ranks(self, a, b):
        keys = (a.astype(np.int64) << 32) | b
        at = self._slot(keys)
        out = np.where(self.key[at] == keys, self.rank[at], NONE)
        open_ = np.flatnonzero((self.key[at] != keys) & (self.key[at] != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            found = self.key[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.rank[at[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def merge(self, symbols: np.ndarray, size: np.ndarray):
        """Merges consecutive lanes of the given sizes to the end, lowest rank first and
        leftmost of equals.  Returns the tokens of all lanes and their numbers."""
        start = np.cumsum(size) - size
        out, count = symbols.copy(), size.copy()
        order = np.argsort(size, kind="stable")
        at = int(np.searchsorted(size[order], 2))
        while at < len(order):  # lanes of like length together, so that little is padding
            least = int(size[order[at]])
            end = int(np.searchsorted(size[order], least + 1 + least // 4, "right"))
            lanes = order[at : min(end, at + max(1, (1 << 18) // (least + 1)))]
            self._lockstep(symbols, start[lanes], size[lanes], lanes, out, count, start)
            at += len(lanes)
        row = np.repeat(np.arange(len(size)), size)
        return out[np.arange(len(symbols)) - start[row] < count[row]], count

    def _lockstep(self, symbols, begin, size, lanes, out, count, start):
        wide = int(size.max())
        column = np.arange(wide)
        inside = column < size[:, None]
        grid = symbols[np.minimum(begin[:, None] + column, len(symbols) - 1)]
        rank = np.full(grid.shape, NONE, np.int32)
        both = inside[:, 1:]
        rank[:, :-1][both] = self.ranks(grid[:, :-1][both], grid[:, 1:][both])
        live, size = np.arange(len(lanes)), size.copy()
        while len(live):
            where = rank.argmin(axis=1)
            low = rank[np.arange(len(live)), where]
            go = low != NONE
            if not go.all():
                over = live[~go]
                count[lanes[over]] = size[over]
                keep = np.arange(grid.shape[1]) < size[over][:, None]
                out[(start[lanes[over]][:, None] + np.arange(grid.shape[1]))[keep]] = grid[~go][keep]
                live, grid, rank, where, low = live[go], grid[go], rank[go], where[go], low[go]
                if not len(live):
                    break
            rows = np.arange(len(live))
            size[live] -= 1
            wide = int(size[live].max())
            source = np.arange(wide) + (np.arange(wide) > where[:, None])
            grid[rows, where] = self.result[low]
            grid = np.take_along_axis(grid, source, 1)
            rank = np.take_along_axis(rank, source, 1)
            for place in (where - 1, where):  # the pairs that hold the new symbol
                ok = (place >= 0) & (place + 1 < size[live])
                fresh = np.full(len(live), NONE, np.int32)
                fresh[ok] = self.ranks(grid[rows[ok], place[ok]], grid[rows[ok], place[ok] + 1])
                here = place >= 0
                rank[rows[here], np.minimum(place[here], wide - 1)] = fresh[here]


#: A class of characters in a pattern.
ATOM = r"\[\^[^\]]*\]|\[\\p\{\w+\}\]|\\[sS]"


def ranges(points: list[int]) -> str:
    """Sorted code points as ranges of a character class."""
    points = np.array(points, np.int64)
    runs = np.split(points, np.flatnonzero(np.diff(points) != 1) + 1) if len(points) else []
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


@functools.cache
def unicode_differences(raw: bytes) -> dict:
    """Where the library's version of Unicode is not this Python's: ``classes``, code points (added,
    dropped) per class of the pattern, and ``normal``, what the normaliser makes of a character."""
    import regex
    import tokenizers

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF], "<u4")
    every = points.tobytes().decode("utf-32-le")
    as_points = lambda runs: np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")
    classes = {}
    for atom in dict.fromkeys(regex.findall(ATOM, json.loads(raw)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])):
        split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(f"{atom}+"), "removed", invert=True)
        library = as_points(run for run, _ in split.pre_tokenize_str(every))
        own = as_points(regex.findall(f"{atom}+".replace(r"\s", SPACES), every))
        classes[atom] = (np.setdiff1d(library, own).tolist(), np.setdiff1d(own, library).tolist())
    # A character at a time, behind a mark that neither joins it nor changes.
    normal = {}
    theirs = tokenizers.Tokenizer.from_buffer(raw).normalizer.normalize_str("|".join(every.replace("|", "/")))
    for c, got in zip(every, theirs.split("|"), strict=True):
        if not c.isascii() and not c.isspace() and got != plain_normal(c):
            normal[c] = got
    return {"classes": classes, "normal": normal}


def plain_normal(text: str) -> str:
    """NFC, then lower case one character at a time, by this Python's version of Unicode."""
    if not text.isascii():
        import unicodedata

        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")  # lower-cased one by one, without the final form
    return text.lower()


class Tokenizer:
    """Encoder and decoder of a vocabulary file (BPE over bytes with an end-of-word suffix)."""

    def __init__(self, raw: bytes, differences: dict | None = None):
        import regex

        spec = json.loads(raw)
        differences = differences or unicode_differences(raw)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("this vocabulary needs steps that are not built")
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        chars = byte_symbols()
        back = {c: bytes([b]) for b, c in enumerate(chars)}
        self.suffix = suffix
        self.token = {i: t for t, i in vocab.items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.spelt = {i: t.encode() for i, t in self.token.items()}
        width = [0] * (max(self.token) + 1)
        self.raw = {}
        for t, i in vocab.items():
            body = t.removesuffix(suffix) if suffix and t != suffix else t
            self.raw[i] = b"".join(back.get(c, c.encode()) for c in body) + (b" " if suffix and body != t else b"")
            width[i] = len(body)
        for t, i in self.special.items():
            self.raw[i] = t.encode()
        self.first = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int32)
        self.merges = Merges([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs], width, len(width))
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACES))
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.odd = regex.compile("[\x1c-\x1f]")
        # Texts with characters on which the versions of Unicode differ take the longer way.
        written = split["pattern"]["Regex"]
        for atom, (add, drop) in differences["classes"].items():
            listed = [ranges(x) for x in (add, drop)]
            own = atom.replace(r"\s", SPACES)
            own = f"[{own}{listed[0]}]" if listed[0] else own
            written = written.replace(atom, f"[{own}--[{listed[1]}]]" if listed[1] else own)
        self.exact = regex.compile(written, regex.V1)
        self.normal = str.maketrans(differences["normal"])
        self.differing = frozenset(differences["normal"]) | {chr(c) for both in differences["classes"].values() for x in both for c in x}
        self.young: dict = {}
        self.old: dict = {}

    def normalise(self, text: str) -> str:
        if self.normal and not text.isascii() and not self.differing.isdisjoint(text):
            text = text.translate(self.normal)
        return plain_normal(text)

    def chunks(self, text: str) -> list[str]:
        """Parts between white space; no token spans two."""
        text = self.normalise(text)
        if self.odd.search(text):  # str.split would also split at these
            import regex

            return [x for x in regex.split(f"[{SPACES}]+", text) if x]
        return text.split()

    def encode_runs(self, runs: list[bytes]):
        """Ids of all runs of bytes in turn, and how many each has."""
        m = self.merges
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        short = size <= (m.window or size.max(initial=0))
        raw = np.frombuffer(b"".join(runs if short.all() else [r for r, s in zip(runs, short, strict=True) if s]), np.uint8)
        symbols, ends = self.first[raw], np.cumsum(size[short])
        symbols[ends - 1] = self.last[raw[ends - 1]]
        tokens, count = m.merge(symbols, size[short])
        if short.all():
            return tokens, count
        parts = iter(np.split(tokens, np.cumsum(count)[:-1]) if len(count) else ())
        every = [next(parts) if s else self.encode_long(r) for r, s in zip(runs, short.tolist(), strict=True)]
        return np.concatenate(every), np.fromiter(map(len, every), np.int64, len(every))

    def encode_long(self, run: bytes) -> np.ndarray:
        """Ids of a run longer than a window, window by window."""
        return np.concatenate(list(self.stream(run)))

    def stream(self, run: bytes):
        """Yields ids as they become stable."""
        m, at, size = self.merges, 0, self.merges.window
        while True:
            part = np.frombuffer(run, np.uint8, min(size, len(run) - at), at)
            lane, last = self.first[part], at + size >= len(run)
            if last:
                lane[-1] = self.last[part[-1]]
            tokens, _ = m.merge(lane, np.array([len(lane)]))
            if last:
                yield tokens
                return
            ends = np.cumsum(m.width[tokens])
            stable = int(np.searchsorted(ends, size - m.lookahead, "right"))
            yield tokens[:stable]
            at += int(ends[stable - 1])

    def encode_chunks(self, chunks) -> dict:
        """Ids as bytes of each distinct chunk, through the cache."""
        ids_of, new, young, old = {}, [], self.young, self.old
        for c in chunks:
            hit = young.get(c)
            if hit is None:
                hit = old.get(c)
                if hit is None:
                    new.append(c)
                    continue
                young[c] = hit
            ids_of[c] = hit
        runs, number = [], []
        for c in new:
            if c.isalpha() and c.isascii():
                runs.append(c.encode())
                number.append(1)
            else:
                found = (self.pattern if c.isascii() or self.differing.isdisjoint(c) else self.exact).findall(c)
                runs += [x.encode("utf-8", "replace") for x in found]
                number.append(len(found))
        if new:
            flat, count = self.encode_runs(runs)
            ends = np.zeros(len(count) + 1, np.int64)
            np.cumsum(count, out=ends[1:])
            ends = ends[np.concatenate([[0], np.cumsum(number)])].tolist()
            raw = flat.astype("<u4").tobytes()
            for c, a, b in zip(new, ends[:-1], ends[1:], strict=True):
                hit = ids_of[c] = raw[4 * a : 4 * b]
                if len(c) <= LONGEST:
                    young[c] = hit
        if len(young) > CACHE:
            self.old, self.young = young, {}
        return ids_of

    def segments(self, text: str):
        """Alternating (chunks of ordinary text, special token or None)."""
        if self.specials is None or "<" not in text:
            yield self.chunks(text), None
            return
        at = 0
        for m in self.specials.finditer(text):
            yield self.chunks(text[at : m.start()]), m.group()
            at = m.end()
        yield self.chunks(text[at:]), None

    def encode_ids(self, texts: list[str]):
        """Per text: ids as little-endian unsigned 32-bit integers."""
        rows = [list(self.segments(t)) for t in texts]
        every: set = set()
        for row in rows:
            for chunks, _ in row:
                every.update(chunks)
        ids_of = self.encode_chunks(every)
        for row in rows:
            ids = []
            for chunks, special in row:
                if chunks:
                    ids.append(b"".join(map(ids_of.__getitem__, chunks)))
                if special is not None:
                    ids.append(self.special[special].to_bytes(4, "little"))
            yield b"".join(ids)

    def decoded(self, ids: bytes):
        """Yields the decoded bytes of a document's finished ids, piece by piece."""
        decoder, every = StreamDecoder(self, listing=True), np.frombuffer(ids, "<u4")
        for a in range(0, len(every), DECODED):
            yield decoder.feed(every[a : a + DECODED].tolist()).encode()
        yield decoder.finish().encode()

    def encode_batch(self, texts: list[str]):
        """Per text: (ids as in ``encode_ids``, the bytes they decode to)."""
        for ids in self.encode_ids(texts):
            yield ids, b"".join(self.decoded(ids))

    def listing(self, ids) -> bytes:
        """Tokens as the vocabulary spells them, a space between: decoding for a file that
        names no decoder.  Tokens are whole characters, so no state is left over."""
        return b" ".join([self.spelt[i] for i in ids])

    def decode(self, ids) -> str:
        """Text: bytes of the tokens, a space where a word ends."""
        return StreamDecoder(self).all(ids)


class StreamDecoder:
    """Turns ids into text as they come.  State: an unfinished UTF-8 sequence, and whether
    anything came before.  Bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, tokenizer: Tokenizer, listing: bool = False):
        self.tokenizer, self.names, self.begun = tokenizer, listing, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        if self.names:
            out = (b" " if self.begun and len(ids) else b"") + self.tokenizer.listing(ids)
        else:
            out = b"".join([self.tokenizer.raw[i] for i in ids])
        self.begun |= len(ids) > 0
        return self.utf8.decode(out)

    def finish(self) -> str:
        return self.utf8.decode(b"", True)

    def all(self, ids) -> str:
        return self.feed(ids) + self.finish()


def tokenizer_of(vocabulary) -> Tokenizer:
    """In a task: the tokenizer of a broadcast vocabulary file, built once per worker."""
    raw, differences = vocabulary.value
    return worker_cache(("bpe", hashlib.sha256(raw).hexdigest()), lambda: Tokenizer(raw, differences))


def load_vocabulary(spark: SparkSession, path: str):
    """Broadcast of a vocabulary file that the driver reads (a few MB, fixed) and of its ``unicode_differences``."""
    with open(path, "rb") as f:
        raw = f.read()
    if len(raw) > 64 << 20:
        raise ValueError("vocabulary file of more than 64 MB")
    return spark.sparkContext.broadcast((raw, unicode_differences(raw)))


def _rows(batch, limit: int = 1 << 21):
    """Lists of (row number, text) of about ``limit`` characters."""
    part, size = [], 0
    for i, value in enumerate(batch.column("text")):
        text = value.as_py() or ""
        part.append((i, text))
        size += len(text)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def _encoded(docs: DataFrame, vocabulary, with_ids: bool) -> DataFrame:
    """All columns of ``docs`` (text not null), and _tf_n, _tf_ids, _tf_ids_sha, _tf_text_sha."""

    def run(batches):
        import pyarrow as pa

        tokenizer = tokenizer_of(vocabulary)
        for batch in batches:
            for part in _rows(batch):
                n, ids_list, ids_sha, text_sha = [], [], [], []
                for ids in tokenizer.encode_ids([t for _, t in part]):
                    n.append(len(ids) // 4)
                    ids_list.append(np.frombuffer(ids, "<u4").astype(np.int32) if with_ids else None)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text = hashlib.sha256()
                    for piece in tokenizer.decoded(ids):
                        text.update(piece)
                    text_sha.append(text.hexdigest())
                rows = batch.slice(part[0][0], len(part))
                columns = rows.columns if with_ids else [rows.column("doc_id")]
                names = rows.schema.names if with_ids else ["doc_id"]
                arrays = [pa.array(n, pa.int64()), pa.array(ids_list, pa.list_(pa.int32())), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *arrays], [*names, "_tf_n", "_tf_ids", "_tf_ids_sha", "_tf_text_sha"])

    keep = docs.schema.names if with_ids else ["doc_id"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return to_workers(docs, run, f"{fields}, _tf_n long, _tf_ids array<int>, _tf_ids_sha string, _tf_text_sha string")


def round_trip(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens.  Ids and repeated rows are carried as they come.
    """
    got = _encoded(docs.select("doc_id", "text"), load_vocabulary(spark, path), False)
    return got.select("doc_id", F.col("_tf_n").alias("n_tokens"), F.col("_tf_ids_sha").alias("ids_sha256"), F.col("_tf_text_sha").alias("decoded_sha256"))


def encode_documents(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` but text, and n_tokens, token_ids, ids_sha256, decoded_sha256
    (which replace columns of those names)."""
    got = _encoded(docs, load_vocabulary(spark, path), True)
    new = {"n_tokens": "_tf_n", "token_ids": "_tf_ids", "ids_sha256": "_tf_ids_sha", "decoded_sha256": "_tf_text_sha"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*new, "text")]
    return got.select(*rest, *[F.col(v).alias(k) for k, v in new.items()])


def decode_documents(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, token_ids): lower-cased text, words apart by one space."""
    vocabulary = load_vocabulary(spark, path)

    def run(batches):
        import pyarrow as pa

        tokenizer = tokenizer_of(vocabulary)
        for batch in batches:
            texts = [tokenizer.decode(x or ()).rstrip(" ") for x in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return to_workers(encoded.select("doc_id", "token_ids"), run, f"doc_id {kind}, text string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    return round_trip(spark, docs, default_path())
