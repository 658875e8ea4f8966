"""Operator 2: licence scans by a positional rare-token index.

Licence templates are indexed by word: each template lists the rarest word of its
key phrases (by the inverse document frequency that one pass counts over all
documents). Each place in a file of such a word, with its phrase around it,
gives the starts at which the template's window would hold that phrase; a start
counts if all mandatory key phrases and enough of the template's words stand in
its window. As no template counts without its key phrases, no start is missed,
and the frequencies decide only which word is looked up first. Short names of
licences are templates that are all key phrase, so every place of them is found.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import ALNUM, Words, pieces, words_of

# Phrases and labels of the base scan.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Template wording (licence notices), label, mandatory key phrases.
TEMPLATES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation either version 2 of the license or at your option any later version",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
     "as published by the free software foundation", ("gnu lesser general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("apache-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at", ("apache license", "except in compliance with the license")),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    ("mit-release", "released under the mit license", ("mit license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
     "are met", ("redistribution and use in source and binary forms", "following conditions")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)

#: Words a template's start may drift; share of its words that must stand in place.
DRIFT, LEAST_SHARE = 3, 0.6


def _word_hashes(text: str) -> np.ndarray:
    return words_of(pa.array([text]), ALNUM, True).hashes()


@dataclass
class Index:
    """Word hashes (sorted), their weights, and the templates: label, words, key phrases."""

    vocabulary: np.ndarray
    idf: np.ndarray
    templates: list[tuple[str, np.ndarray, list[np.ndarray]]]
    #: Each template's rarest key word: its number, the phrase it is in, its place there, and the phrase's place in the template.
    postings: list[tuple[int, np.ndarray, int, int]]
    base: list[tuple[str, np.ndarray, bytes]]
    #: The rarest word of each template's key phrases: a file without any of them holds no licence.
    keys: np.ndarray


def build_index(frequency: dict[int, int] | None = None, documents: int = 1, templates=TEMPLATES, base=None) -> Index:
    base = BASE if base is None else base
    made = [(label, _word_hashes(text), [_word_hashes(p) for p in phrases]) for label, text, phrases in templates]
    made += [(label, _word_hashes(phrase), [_word_hashes(phrase)]) for phrase, label in base.items()]
    vocabulary = np.unique(np.concatenate([m[1] for m in made]))
    frequency = frequency or {}
    idf = np.array([math.log((documents + 1) / (frequency.get(int(w.astype(np.int64)), 0) + 1)) for w in vocabulary])
    postings = []
    for _, words, phrases in made:
        key, phrase, at = max(((int(k), p, at) for p in phrases for at, k in enumerate(np.searchsorted(vocabulary, p))), key=lambda x: idf[x[0]])
        n = len(phrase)
        postings.append((key, phrase, at, next(i for i in range(len(words) - n + 1) if np.array_equal(words[i:i + n], phrase))))
    keys = np.unique([key for key, *_ in postings])
    return Index(vocabulary, idf, made, postings, [(label, _word_hashes(p), p.encode()) for p, label in base.items()], keys)


def _stands(words: np.ndarray, phrase: np.ndarray, low: int, high: int) -> bool:
    part = words[max(0, low):max(0, high)]
    n = len(part) - len(phrase) + 1
    if n <= 0:
        return False
    same = np.ones(n, bool)
    for k, h in enumerate(phrase):
        same &= part[k:k + n] == h
    return bool(same.any())


def match_templates(words: np.ndarray, known: np.ndarray, index: Index) -> dict[str, float]:
    """Label and share in place of the templates verified in one file; ``known``: vocabulary number of each word or -1."""
    held = np.flatnonzero(np.isin(known, index.keys))
    found: dict[str, float] = {}
    for (label, wording, phrases), (key, phrase, within, position) in zip(index.templates, index.postings):
        at = held[known[held] == key] - within
        at = at[(at >= 0) & (at + len(phrase) <= len(words))]
        for k, h in enumerate(phrase):
            at = at[words[at + k] == h]
        best, seen = 0.0, set()
        for place in at.tolist():
            if best == 1.0:
                break
            # slots whose window holds the phrase; the one where a full copy would start goes first
            first = -((len(wording) + 2 * DRIFT + 1 - len(phrase) - place) // (DRIFT + 1))
            slots = [(place - position) // (DRIFT + 1), *range(first, (place + DRIFT) // (DRIFT + 1) + 1)]
            for slot in slots:
                low, high = slot * (DRIFT + 1) - DRIFT, slot * (DRIFT + 1) + len(wording) + 2 * DRIFT + 1
                near = words[max(0, low):max(0, high)]
                if best == 1.0 or (mark := near.tobytes()) in seen:
                    continue
                seen.add(mark)
                share = float(np.isin(wording, near).mean())
                if share > best and share >= LEAST_SHARE and all(_stands(words, p, low, high) for p in phrases):
                    best = share
        if best:
            found[label] = max(found.get(label, 0.0), best)
    return found


def _base_places(words: Words, hashes: np.ndarray, index: Index) -> list[tuple[np.ndarray, str]]:
    """Starts (word numbers of the piece) of each base phrase, checked on the bytes."""
    out = []
    for label, phrase, raw in index.base:
        n = len(hashes) - len(phrase) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(hashes[:n] == phrase[0])
        for k, h in enumerate(phrase[1:], 1):
            at = at[hashes[at + k] == h]
        at = at[words.doc[at] == words.doc[at + len(phrase) - 1]] if len(at) else at
        spelt = raw.split(b" ")
        at = np.array([i for i in at.tolist() if all(words.data[words.start[i + k]:words.end[i + k]].tobytes() == w for k, w in enumerate(spelt))], np.int64)
        out.append((at, label))
    return out


def _scan(piece: pa.RecordBatch, index: Index) -> pa.RecordBatch:
    words = words_of(piece.column("text"), ALNUM, True)
    hashes = words.hashes()
    slot = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
    known = np.where(index.vocabulary[slot] == hashes, slot, -1)
    places: dict[int, list[tuple[int, str]]] = defaultdict(list)
    for at, label in _base_places(words, hashes, index):
        for i in at.tolist():
            places[int(words.doc[i])].append((i, label))
    asked = set(np.unique(words.doc[np.isin(known, index.keys)]).tolist())
    rows = []
    for d in range(piece.num_rows):
        first, last = words.first[d], words.first[d + 1]
        base = places.get(d, [])
        found = match_templates(hashes[first:last], known[first:last], index) if d in asked or base else {}
        for _, label in base:
            found[label] = 1.0
        starts = [i - first for i, _ in base]
        rows.append((int(last - first), len(base), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted({x for _, x in base})), ",".join(sorted(found)), max(found.values(), default=0.0)))
    columns = list(zip(*rows))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)


def word_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[int, int], int]:
    """Document frequency of the templates' words over all rows (one row a word), and the number of rows."""
    vocabulary = build_index(templates=templates).vocabulary

    def count(batches):
        seen, n = np.zeros(len(vocabulary), np.int64), 0
        for piece in pieces(batches):
            words = words_of(piece.column("text"), ALNUM, True)
            slot = np.minimum(np.searchsorted(vocabulary, hashes := words.hashes()), len(vocabulary) - 1)
            same = vocabulary[slot] == hashes
            pairs = np.unique(words.doc[same] * len(vocabulary) + slot[same])
            seen += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            n += piece.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([*vocabulary.astype(np.int64), 0]), pa.array([False] * len(seen) + [True]), pa.array([*seen, n])], ["word", "rows", "n"])
    counts = docs.select("text").mapInArrow(count, "word long, rows boolean, n long").groupBy("word", "rows").agg(F.sum("n").alias("n")).collect()
    return {r["word"]: r["n"] for r in counts if not r["rows"]}, sum(r["n"] for r in counts if r["rows"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``.

    ``score`` is the largest share of a verified template's words found in
    place (base phrases: 1). Null or empty text: no words, null places, empty
    labels, score 0; repeated rows each give their row; an empty table gives
    none; further columns are not read.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    frequency, n = word_frequencies(rows)
    index = build_index(frequency, n)

    def run(batches):
        for piece in pieces(batches):
            yield _scan(piece, index)
    return rows.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")

