"""License scans with a positional rare-token index (method 1).

The index holds, per word of the licence texts, its postings (text, position).
A document is looked up by its rarest licence words, rare by the number of
documents that hold them; each hit places a text at a relative position, and
texts placed there are compared word by word.  A short phrase must match in full; a
notice must match in enough of its weight and hold its key phrases.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytescan import ALNUM, WordHasher
from .common import row_chunks, table, text_buffers, to_workers, whole_text, worker_cache

#: Words of a notice that look it up, its rarest; hits that place it; part of its weight that must match.
ANCHORS, VOTES, COVERAGE = 8, 2, 0.6
#: Words by which parts of a notice may lie off their place.
SLACK = 8


@dataclass(frozen=True)
class Template:
    """A licence text under a label.  Without key phrases it is a phrase, found only whole."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


#: The base phrases, further phrases, and opening passages of public licence notices.
TEMPLATES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
    Template("agpl", "gnu affero general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("cc-by-4.0", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "cc0 1 0"),
    Template("mpl", "mozilla public license"),
    Template("eclipse", "eclipse public license"),
    Template("bsd", "bsd license"),
    Template("isc", "isc license"),
    Template("spdx", "spdx license identifier"),
    Template("reserved", "all rights reserved"),
    Template("public-domain", "released into the public domain"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        ("except in compliance with the license",),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        ("free software", "redistribute it and or modify it under the terms", "gnu general public license"),
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
        ("free software", "redistribute it and or modify it under the terms", "gnu lesser general public license"),
    ),
    Template(
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation",
        ("free software", "redistribute it and or modify it under the terms", "gnu affero general public license"),
    ),
    Template(
        "boost",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software",
        ("free of charge to any person or organization obtaining a copy",),
    ),
    Template(
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software",
        ("without any express or implied warranty", "liable for any damages arising from the use of this software"),
    ),
    Template(
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
        ("may be used to endorse or promote products derived from this software",),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        ("source and binary forms", "with or without modification"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("subject to the terms of the mozilla public license",),
    ),
)


def split_words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Index:
    """Word numbers, and for given document frequencies the postings of anchor words."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        self.hasher = WordHasher(ALNUM)
        texts = [split_words(t.text) for t in templates]
        self.vocabulary = sorted({w for t in texts for w in t})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.words = [np.array([number[w] for w in t], np.int32) for t in texts]
        self.keys = [[np.array([number[w] for w in split_words(k)], np.int32) for k in t.keys] for t in templates]
        hashes = np.array([self.hasher.one(w) for w in self.vocabulary], np.uint64)
        self.order = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[hashes & np.uint64(0xFFFF)] = True
        self.anchors = None

    def number(self, hashes) -> np.ndarray:
        """Number of each word, -1 if it is in no text."""
        out = np.full(len(hashes), -1, np.int32)
        some = np.flatnonzero(self.maybe[hashes & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        out[some[hit]] = self.order[at[hit]]
        return out

    def weigh(self, n_docs: int, frequency: dict[int, int]) -> "Index":
        """Inverse document frequencies, and postings of each text's rarest words."""
        self.idf = np.array([math.log(2 + n_docs / (1 + frequency.get(i, 0))) for i in range(len(self.vocabulary))])
        postings: dict[int, list] = {}
        for t, words in enumerate(self.words):
            rare = sorted(set(words.tolist()), key=lambda w: (-self.idf[w], w))[: ANCHORS if self.templates[t].keys else 1]
            for place, w in enumerate(words.tolist()):
                if w in rare:
                    postings.setdefault(w, []).append((t, place))
        self.anchors = np.zeros(len(self.vocabulary), bool)
        self.anchors[list(postings)] = True
        self.postings = {w: np.array(p, np.int64) for w, p in postings.items()}
        return self

    def matches(self, numbers, bounds):
        """(row, template, start, coverage) of all accepted placements, starts from the row's first word."""
        hits = np.flatnonzero((numbers >= 0) & self.anchors[np.maximum(numbers, 0)])
        placed = []
        for w in np.unique(numbers[hits]):
            at = hits[numbers[hits] == w]
            for t, place in self.postings[w]:
                placed.append(np.stack([np.full(len(at), t), at - place, at]))
        if not placed:
            return np.zeros((4, 0))
        template, start, hit = np.concatenate(placed, axis=1)
        row = np.searchsorted(bounds, hit, "right") - 1
        out = []
        for t in np.unique(template):
            mine = template == t
            found = self._phrase(t, start[mine], row[mine], numbers, bounds) if not self.templates[t].keys else self._notice(t, start[mine], row[mine], numbers, bounds)
            if len(found[0]):
                out.append(np.stack([found[0], np.full(len(found[0]), t), found[1] - bounds[found[0]], found[2]]))
        return np.concatenate(out, axis=1) if out else np.zeros((4, 0))

    @staticmethod
    def _equal(words, start, row, numbers, bounds):
        """Whether each word stands at its place, as (placements, words)."""
        place = start[:, None] + np.arange(len(words))
        inside = (place >= bounds[row][:, None]) & (place < bounds[row + 1][:, None])
        return inside & (numbers[np.clip(place, 0, len(numbers) - 1)] == words)

    def _phrase(self, t, start, row, numbers, bounds):
        pair = np.unique(np.stack([row, start]), axis=1)
        row, start = pair[0], pair[1]
        ok = self._equal(self.words[t], start, row, numbers, bounds).all(axis=1)
        return row[ok], start[ok], np.ones(int(ok.sum()))

    def _notice(self, t, start, row, numbers, bounds):
        pair, votes = np.unique(np.stack([row, start]), axis=1, return_counts=True)
        # Hits whose relative positions differ by a few inserted or missing words vote together.
        apart = np.ones(pair.shape[1], bool)
        apart[1:] = (np.diff(pair[0]) != 0) | (np.diff(pair[1]) > SLACK)
        group = np.cumsum(apart) - 1
        together = np.bincount(group, votes)
        order = np.lexsort((-votes, group))
        top = order[np.flatnonzero(np.diff(group[order], prepend=-1))]
        top = top[together[group[top]] >= VOTES]
        row, start = pair[0][top], pair[1][top]
        near = np.zeros((len(row), len(self.words[t])), bool)
        for off in range(-SLACK, SLACK + 1):
            near |= self._equal(self.words[t], start + off, row, numbers, bounds)
        weight = self.idf[self.words[t]]
        cover = near @ (weight / weight.sum())
        ok = cover >= COVERAGE
        row, start, cover = row[ok], start[ok], cover[ok]
        text = self.words[t].tolist()
        for key in self.keys[t]:
            place = next(i for i in range(len(text)) if text[i : i + len(key)] == key.tolist())
            found = np.zeros(len(row), bool)
            for off in range(-SLACK, SLACK + 1):
                found |= self._equal(key, start + place + off, row, numbers, bounds).all(axis=1)
            row, start, cover = row[found], start[found], cover[found]
        return row, start, cover


def _index(templates) -> Index:
    return worker_cache(("licenses", hash(templates)), lambda: Index(templates))


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...]) -> tuple[int, dict[int, int]]:
    """Documents in all, and documents that hold each word of the licence texts (one number per word)."""

    def run(batches):
        import pyarrow as pa

        index = _index(templates)
        count, n = np.zeros(len(index.vocabulary), np.int64), 0
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in row_chunks(offsets, 1 << 20):
                hashes, bounds = index.hasher(data, offsets[a : b + 1])
                numbers = index.number(hashes)
                at = np.flatnonzero(numbers >= 0)
                row = np.searchsorted(bounds, at, "right") - 1
                held = np.unique(row.astype(np.int64) * len(count) + numbers[at])
                count += np.bincount(held % len(count), minlength=len(count))
                n += b - a
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(count))), pa.array(np.append(n, count))], ["word", "n"])

    got = to_workers(docs.select(whole_text().alias("text")), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in got}
    return counts.pop(-1, 0), counts


SPANS = "array<struct<label:string,start:bigint,words:bigint,coverage:double>>"


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans.

    Null and empty texts have no words and no labels.  n_base counts all places of
    base phrases, overlapping ones included; first_word and last_word are their
    least and greatest start.  ``score`` is the largest coverage of any match, 0
    without one.  ``spans`` lists all matches by (start, label).
    """
    n_docs, frequency = document_frequencies(docs, templates)

    def run(batches):
        import pyarrow as pa

        index = _index(templates)
        index.weigh(n_docs, frequency)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in row_chunks(offsets, 1 << 20):
                hashes, bounds = index.hasher(data, offsets[a : b + 1])
                found = index.matches(index.number(hashes), bounds)
                spans: list[list] = [[] for _ in range(b - a)]
                for row, t, start, cover in found.T.tolist():
                    spans[int(row)].append((int(start), int(t), cover))
                columns: list[list] = [[] for _ in range(8)]
                for n, mine in zip(np.diff(bounds).tolist(), spans, strict=True):
                    mine.sort(key=lambda s: (s[0], templates[s[1]].label, s[1]))
                    base = [s for s in mine if templates[s[1]].base]
                    values = (
                        n,
                        len(base),
                        base[0][0] if base else None,
                        base[-1][0] if base else None,
                        ",".join(sorted({templates[s[1]].label for s in base})),
                        ",".join(sorted({templates[s[1]].label for s in mine})),
                        min(1.0, max((s[2] for s in mine), default=0.0)),
                        [{"label": templates[t].label, "start": s, "words": len(index.words[t]), "coverage": c} for s, t, c in mine],
                    )
                    for c, v in zip(columns, values, strict=True):
                        c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
                span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("coverage", pa.float64())]))
                arrays = [pa.array(c, k) for c, k in zip(columns, (*kinds, span), strict=True)]
                names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *arrays], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {SPANS}"
    return to_workers(docs.select("doc_id", whole_text().alias("text")), run, schema)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
