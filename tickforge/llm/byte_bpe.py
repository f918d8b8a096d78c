"""Byte-level BPE by higher-order functions (method 12).

A token is written as one character, FIRST + rank.

Encoding: a text is cut into words by the pattern.  A word's merges are a fold over its
merge list: the tokens that its bytes spell somewhere, by rank, each as the two
tokens that make it and the token made.  A step writes the token over the pair, wherever
the pair stands.  That is what the library does, least rank first and leftmost, if a
token's own bytes always end in the same pair, by merges of lesser rank (``Vocabulary``).

A dictionary of frequent words, folded in the same way, is broadcast; an Arrow function looks words up
in it and lists the merges of the others, which are folded where they stand.
Decoding joins the bytes of the ids.

The dictionary saves time and never changes a result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_chunks, small_batches, stored, table, text_buffers, whole_text, work_dir, worker_cache

#: Character of rank 0.  It and the 65,535 that follow take four bytes each in UTF-8.
FIRST = 0x10000
#: Longest word, in bytes, that is folded: a fold's work grows with the square of the word.  Longer ones
#: are merged by a heap instead.
FOLDED = 64
#: Words of the dictionary, and how many documents they are counted in: bounds of what
#: reaches the driver.  Both decide the speed alone.
WORDS, DOCUMENTS = 1 << 19, 20_000
#: Rows of an Arrow batch, as their words take several times the texts' bytes; words, or ids, that an
#: Arrow function works on at a time.
ROWS, PIECE = 1000, 1 << 17
#: A class of characters in a pattern.
ATOM = re.compile(r"\[\^[^\]]*\]|\\[pP]\{\w+\}|\\[sS]")


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank by token of a file of lines (token in base64, rank)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if len(ranks) > 1 << 16:
        raise ValueError("vocabulary of more than 65,536 tokens")
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0 to the number of tokens and hold every byte")
    return ranks


def _ranges(points: np.ndarray) -> str:
    runs = np.split(points, np.flatnonzero(np.diff(points) != 1) + 1) if len(points) else []
    return "".join(f"\\x{{{r[0]:X}}}" if len(r) == 1 else f"\\x{{{r[0]:X}}}-\\x{{{r[-1]:X}}}" for r in runs)


def java_pattern(spark: SparkSession, pattern: str) -> str:
    """``pattern`` with each class of characters as the library has it.  The two engines know
    different versions of Unicode, so both are asked which characters a class holds and
    the differences are written out."""
    import tiktoken

    atoms = list(dict.fromkeys(ATOM.findall(pattern)))
    # A letter goes first, as U+FEFF at the start of UTF-32 would be a byte order mark.
    char = F.substring(F.decode(F.unhex(F.concat(F.lit("00000061"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32"), 2, 1)
    points = spark.range(0x110000).where(~F.col("id").between(0xD800, 0xDFFF)).select("id", char.alias("c"))
    here = points.select("id", *[F.col("c").rlike(atom).alias(f"m{i}") for i, atom in enumerate(atoms)]).toArrow()
    known = here["id"].to_numpy()
    single = {bytes([b]): b for b in range(256)}
    written = {}
    for i, atom in enumerate(atoms):
        asked = tiktoken.Encoding("class", pat_str=f"{atom}+", mergeable_ranks=single, special_tokens={})
        library = []
        for block in np.array_split(np.sort(known), 64):  # few at a time, as ids are Python's integers
            text = block.astype("<u4").tobytes().decode("utf-32-le")
            library.append(np.frombuffer(asked.decode_bytes(asked.encode_ordinary(text)).decode().encode("utf-32-le"), "<u4").astype(np.int64))
        library, java = np.concatenate(library), known[here[f"m{i}"].to_numpy()]
        add, drop = np.setdiff1d(library, java), np.setdiff1d(java, library)
        if min(add.min(initial=128), drop.min(initial=128)) < 128:
            raise ValueError(f"the engines differ on ASCII characters of {atom}")
        # ASCII is settled first: the ranges that differ are many and lie above it.
        more = f"[[^\\x00-\\x7F]&&[{_ranges(add)}]]" if len(add) else ""
        kept = f"&&[[\\x00-\\x7F][^{_ranges(drop)}]]" if len(drop) else ""
        written[atom] = f"[{atom}{more}{kept}]"
    return ATOM.sub(lambda m: written[m.group()], pattern)


def token_char(rank: int) -> str:
    return chr(FIRST + rank)


def as_chars(ids: np.ndarray) -> bytes:
    """Tokens written as characters, in UTF-8."""
    return (FIRST + ids).astype("<u4").tobytes().decode("utf-32-le").encode()


def merge_long(word: bytes, ranks: dict[bytes, int]) -> str:
    """Tokens of a word of any length: the same merges with a heap, in n log n steps."""
    if word in ranks:
        return token_char(ranks[word])
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        b = end[a]
        if b < n and (rank := ranks.get(word[a : end[b]])) is not None:
            heap.append((rank, a, end[b])) if not ready else heapq.heappush(heap, (rank, a, end[b]))

    ready = False
    for a in range(n - 1):
        offer(a)
    heapq.heapify(heap)
    ready = True
    while heap:
        _, a, stop = heapq.heappop(heap)
        b = end[a]
        if b is None or b >= n or end[b] != stop:  # one of the two is no more
            continue
        end[a], end[b] = stop, None
        if stop < n:
            before[stop] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out, a = [], 0
    while a < n:
        out.append(token_char(ranks[word[a : end[a]]]))
        a = end[a]
    return "".join(out)


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The ranks of the two tokens that a token's bytes are merged to before they are the token;
    None if merges do not make it, so that it stands for a whole word alone."""
    parts, rank, none = [token[i : i + 1] for i in range(len(token))], ranks[token], len(ranks)
    late = False
    while len(parts) > 2:
        least, at = min((ranks.get(parts[i] + parts[i + 1], none), i) for i in range(len(parts) - 1))
        if least == none:
            return None
        late |= least > rank
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    if late:
        raise ValueError("a token is made by merges of greater rank")
    return (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None


class Vocabulary:
    """A rank file as arrays, for the workers.

    Attributes: pieces (bytes by rank, and no bytes at last), merges (by rank, the pair and the token that it makes, null
    if none), bytes_ (rank by byte), keys and ranks (a prefix tree of the tokens: node * 256 + byte
    leads to the node whose number is one more than the key's place; rank by node or -1),
    in_order (whether a fold by rank makes what the library makes).
    """

    def __init__(self, ranks: dict[bytes, int]):
        import pyarrow as pa

        tokens = [t for _, t in sorted((r, t) for t, r in ranks.items())]
        self.pieces = pa.array([*tokens, b""], pa.binary())
        self.bytes_ = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        places, ends = {}, {}
        for token in tokens:
            node = 0
            for b in token:
                node = places.setdefault(node << 8 | b, len(places) + 1)
            ends[node] = ranks[token]
        self.keys = pa.array(places, pa.int64())
        self.ranks = np.full(len(places) + 1, -1, np.int32)
        self.ranks[list(ends)] = list(ends.values())
        try:
            pairs, self.in_order = [last_pair(t, ranks) for t in tokens], True
        except ValueError:
            pairs, self.in_order = [None] * len(tokens), False
        self.merges = pa.array([p and token_char(p[0]) + token_char(p[1]) + token_char(r) for r, p in enumerate(pairs)], pa.string())
        self.made = np.array([p is not None for p in pairs])
        self.name = uuid.uuid4().hex

    def share(self, spark: SparkSession):
        """A broadcast of the arrays alone: workers need not know this class by its module."""
        return spark.sparkContext.broadcast(vars(self))

    @classmethod
    def of(cls, shared) -> Vocabulary:
        """The vocabulary of a broadcast, in a worker."""
        own = cls.__new__(cls)
        vars(own).update(shared.value)
        return own

    def by_bytes(self) -> dict[bytes, int]:
        return worker_cache(("byte_bpe", self.name), lambda: {t: r for r, t in enumerate(self.pieces.to_pylist()[:-1])})

    def merge_lists(self, words):
        """Per word of an Arrow array: its bytes as tokens, and its merges by rank, as Arrow arrays."""
        import pyarrow as pa
        import pyarrow.compute as pc

        raw, off = text_buffers(words)
        base, n = off[0], np.diff(off)
        raw = raw[base : off[-1]]
        owner = np.repeat(np.arange(len(n)), n)
        end = (off[1:] - base)[owner]
        at, node, found = np.arange(len(raw)), np.zeros(len(raw), np.int64), [np.zeros(0, np.int64)]
        while len(at):
            place = pc.fill_null(pc.index_in(pa.array(node << 8 | raw[at]), self.keys), -1).to_numpy()
            on = place >= 0
            at, owner, end, node = at[on] + 1, owner[on], end[on], place[on].astype(np.int64) + 1
            rank = self.ranks[node]
            is_made = (rank >= 0) & self.made[rank]
            found.append(owner[is_made] << 32 | rank[is_made])
            more = at < end
            at, owner, end, node = at[more], owner[more], end[more], node[more]
        found = np.sort(np.concatenate(found))
        found = found[np.diff(found, prepend=-1) != 0]
        lists = np.searchsorted(found, np.arange(len(n) + 1) << 32).astype(np.int32)
        merges = pa.ListArray.from_arrays(pa.array(lists), self.merges.take(pa.array(found & 0xFFFFFFFF)))
        starts = pa.py_buffer((4 * (off - base)).astype(np.int32))
        return pa.StringArray.from_buffers(len(n), starts, pa.py_buffer(as_chars(self.bytes_[raw]))), merges

    def spelled(self, ids: np.ndarray):
        """(offset of each id, and the end; bytes joined); ids that are none of the ranks have no bytes."""
        import pyarrow as pa

        known = (ids >= 0) & (ids < len(self.pieces) - 1)
        raw, off = text_buffers(self.pieces.take(pa.array(np.where(known, ids, len(self.pieces) - 1))))
        return off, memoryview(raw)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _lists(column):
    """(offset of each row's values, and the end; values) of an Arrow array of lists."""
    import pyarrow.compute as pc

    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(n, dtype=np.int64)]), column.flatten()


#: What is known of a text's words: ids, where a negative one stands for a word that is not in the
#: dictionary; and of these words in turn the bytes, as tokens, and the merges.
KNOWN = "struct<ids: array<int>, rest: array<struct<bytes: string, merges: array<string>>>>"


def _by_pieces(rows: np.ndarray, run):
    """``run(first row, end)`` of pieces of about PIECE values, put together: the arrays that it needs
    meanwhile are several times as large as its input."""
    import pyarrow as pa

    return pa.concat_arrays([run(a, b) for a, b in row_chunks(rows, PIECE)] or [run(0, 0)])


def _look_up(shared, dictionary, folded: int):
    """Arrow function: KNOWN of arrays of words.  Words of more than ``folded`` bytes are merged by the heap."""
    import pyarrow as pa

    def run(column):
        import pyarrow.compute as pc

        vocabulary = Vocabulary.of(shared)
        entries = dictionary.value if dictionary else {"word": pa.array([], pa.string()), "token_ids": pa.array([], pa.list_(pa.int32()))}
        rows, words = _lists(column)
        places = pc.fill_null(pc.index_in(words, entries["word"]), -1).to_numpy()
        off, ids = _lists(entries["token_ids"])
        off, gap = np.append(off, off[-1] + 1), len(ids)  # place -1 is the gap, which follows the dictionary's ids
        ids = np.append(ids.to_numpy(), np.int32(-1))

        def piece(a, b):
            first, ends = rows[a], rows[a : b + 1] - rows[a]
            own, place = words.slice(first, ends[-1]), places[first : rows[b]]
            place = np.where(place < 0, len(off) - 2, place)
            starts, counts, source, filled = off[place], np.diff(off)[place], [ids], gap + 1
            missing = np.flatnonzero(starts == gap)
            length = pc.binary_length(own.take(pa.array(missing))).to_numpy()
            for i in missing[length > folded].tolist():
                tokens = np.frombuffer(merge_long(own[i].as_py().encode(), vocabulary.by_bytes()).encode("utf-32-le"), "<i4") - FIRST
                source.append(tokens.astype(np.int32))
                starts[i], counts[i] = filled, len(tokens)
                filled += len(tokens)
            source = np.concatenate(source) if len(source) > 1 else ids
            short = missing[length <= folded]
            bytes_, merges = vocabulary.merge_lists(own.take(pa.array(short)))
            rest = pa.StructArray.from_arrays([bytes_, merges], ["bytes", "merges"])
            as_list = lambda at, values: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)
            known = as_list(np.concatenate([[0], np.cumsum(counts)])[ends], pa.array(source[_spread(starts, counts)]))
            return pa.StructArray.from_arrays([known, as_list(np.searchsorted(short, ends), rest)], ["ids", "rest"])

        return _by_pieces(rows, piece)

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, KNOWN)


def _filled(ids, folded):
    """(offset of each row, ids) once the words' tokens, written as characters, stand in the gaps."""
    rows, flat = _lists(ids)
    flat = flat.to_numpy()
    raw, off = text_buffers(_lists(folded)[1])
    tokens = np.frombuffer(raw[off[0] : off[-1]].tobytes().decode().encode("utf-32-le"), "<i4") - FIRST
    gap, counts = flat < 0, np.ones(len(flat), np.int64)
    counts[gap] = np.diff(off) // 4
    ends = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(ends[-1], np.int32)
    out[ends[:-1][~gap]] = flat[~gap]
    out[_spread(ends[:-1][gap], counts[gap])] = tokens
    return ends[rows], out


def _token_ids():
    """Arrow function: ids of texts, from KNOWN's ids and the folded words."""
    import pyarrow as pa

    def run(ids, folded):
        def piece(a, b):
            rows, out = _filled(ids.slice(a, b - a), folded.slice(a, b - a))
            return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(out))

        return _by_pieces(_lists(ids)[0], piece)

    run.__annotations__ = {"ids": pa.Array, "folded": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<int>")


def _digests(shared):
    """Arrow function: number and digest of a text's ids, little-endian and unsigned, and digest of the bytes decoded from them."""
    import pyarrow as pa

    def run(ids, folded):
        def piece(a, b):
            rows, out = _filled(ids.slice(a, b - a), folded.slice(a, b - a))
            off, spelled = vocabulary.spelled(out)
            written = memoryview(out.astype("<u4").tobytes())
            runs = list(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True))
            ids_sha256 = pa.array([sha(written[4 * i : 4 * j]) for i, j in runs], pa.string())
            decoded_sha256 = pa.array([sha(spelled[off[i] : off[j]]) for i, j in runs], pa.string())
            return pa.StructArray.from_arrays([pa.array(np.diff(rows)), ids_sha256, decoded_sha256], ["n_tokens", "ids_sha256", "decoded_sha256"])

        vocabulary, sha = Vocabulary.of(shared), lambda raw: hashlib.sha256(raw).hexdigest()
        return _by_pieces(_lists(ids)[0], piece)

    run.__annotations__ = {"ids": pa.Array, "folded": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>")


def _decoder(shared):
    """Arrow function: the bytes of arrays of ids."""
    import pyarrow as pa

    def run(column):
        import pyarrow.compute as pc

        rows, ids = _lists(column)
        off, spelled = Vocabulary.of(shared).spelled(pc.fill_null(ids, -1).to_numpy())
        return pa.BinaryArray.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(off[rows].astype(np.int32)), pa.py_buffer(spelled)])

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "binary")


def fold_word(word: Column) -> Column:
    """Tokens of a word of KNOWN: its merges in turn, each wherever its pair stands."""
    return F.aggregate(word["merges"], word["bytes"], lambda tokens, m: F.replace(tokens, F.substring(m, 1, 2), F.substring(m, 3, 1)))


class ByteBpe:
    """Encoder and decoder of a rank file, for DataFrames."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.spark, self.ranks = spark, read_ranks(path)
        self.pattern = java_pattern(spark, pattern)
        vocabulary = Vocabulary(self.ranks)
        self.folded = FOLDED if vocabulary.in_order else 0
        self.vocabulary = vocabulary.share(spark)
        small_batches(spark, ROWS)

    def words(self, text: Column) -> Column:
        """The matches of the pattern in turn.  No text is lost, as every character matches."""
        return F.regexp_extract_all(text, F.lit(self.pattern), 0)

    def dictionary(self, docs: DataFrame, words: int = WORDS, documents: int = DOCUMENTS) -> dict:
        """Arrow arrays word and token_ids: of the tokens that are text, and of the words most frequent in about
        ``documents`` of the documents, taken by a hash of their text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        tokens = {}
        for token, rank in self.ranks.items():  # a word that is a token needs no merges
            try:
                tokens[token.decode()] = [rank]
            except UnicodeDecodeError:
                continue
        tokens = pa.table({"word": pa.array(tokens, pa.string()), "token_ids": pa.array(tokens.values(), pa.list_(pa.int32()))})
        every = max(1, docs.count() // documents)
        some = docs.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select(F.explode(self.words(whole_text())).alias("word"))
        counted = some.where(F.octet_length("word") <= FOLDED).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(words)
        # Stored, and dealt anew: the fold is to run on all cores.
        counted = stored(counted, f"{work_dir(self.spark, 'byte-bpe')}/words").select("word").repartition(F.xxhash64("word"))
        known, folded = self.known(counted, F.array("word"), {})
        got = known.select("word", _token_ids()(F.col("_tf_known.ids"), folded).alias("token_ids")).toArrow().cast(tokens.schema)
        got = got.filter(pc.invert(pc.is_in(got["word"], tokens["word"].combine_chunks())))
        every = pa.concat_tables([tokens, got]).combine_chunks()
        return {c: every[c].chunk(0) for c in every.column_names}

    def known(self, df: DataFrame, words: Column, dictionary: dict) -> tuple[DataFrame, Column]:
        """``df`` and _tf_known (KNOWN of the words), and the column of the words that are folded."""
        dictionary = self.spark.sparkContext.broadcast(dictionary) if dictionary else None
        got = df.withColumn("_tf_known", _look_up(self.vocabulary, dictionary, self.folded)(words))
        return got, F.transform("_tf_known.rest", fold_word)

    def encoded(self, docs: DataFrame) -> tuple[DataFrame, Column]:
        """``known`` of the documents' texts (null text: no words)."""
        return self.known(docs, self.words(whole_text()), self.dictionary(docs))


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns of ``docs`` but text, and n_tokens, token_ids (which replace columns of those names).

    Null and empty texts have no tokens.  Ids and repeated rows are carried as they come; texts
    and words may be of any length.  An empty table gives no rows.
    """
    got, folded = ByteBpe(spark, path, pattern).encoded(docs)
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_tokens", "token_ids", "text")]
    got = got.select(*rest, _token_ids()(F.col("_tf_known.ids"), folded).alias("token_ids"))
    return got.select(*rest, F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


def decode_documents(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, token_ids); bytes that are no UTF-8 become U+FFFD, null ids an empty text."""
    ids = F.coalesce("token_ids", F.array().cast("array<int>"))
    small_batches(spark, ROWS)
    decoded = _decoder(Vocabulary(read_ranks(path)).share(spark))(ids)
    return encoded.select("doc_id", F.make_valid_utf8(decoded.cast("string")).alias("text"))


def round_trip(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the bytes decoded
    from the ids).  Nulls, repeats and empty tables as in ``encode_documents``."""
    bpe = ByteBpe(spark, path, pattern)
    got, folded = bpe.encoded(docs.select("doc_id", "text"))
    return got.select("doc_id", _digests(bpe.vocabulary)(F.col("_tf_known.ids"), folded).alias("d")).select("doc_id", "d.*")


def op12_byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
