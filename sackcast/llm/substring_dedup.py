"""Operator 3: substring dedup by difference-cover anchors.

Word positions of a document are taken modulo PERIOD; anchors (hashes of ANCHOR
words) stand only at positions whose residue is in the difference cover. For
any two starts of an equal window there is a shift below PERIOD that takes both
to cover positions, and the window still holds the whole anchor there: equal
windows share an aligned anchor. So only windows around anchors that occur
elsewhere are extended to their WINDOW words and compared in full (128 bits);
for each text of a window the earliest start is kept, found by one aggregation.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .screen import keyed, repeated_anchors
from .shared import NOT_SPACE, Words, covered, cut, mix, pieces, runs_of_words, utf8, words_of

#: 0, 1, 3, 9 differ by every residue modulo 13; a window's words, and an anchor's: WINDOW >= PERIOD - 1 + ANCHOR.
PERIOD, COVER, WINDOW, ANCHOR = 13, (0, 1, 3, 9), 20, 8


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hash) of the anchors at cover positions."""
    found, whole = runs_of_words(words.hashes(), words.doc, ANCHOR)
    place = (np.arange(len(found)) - words.first[words.doc[:len(found)]]) % PERIOD
    long = np.diff(words.first)[words.doc[:len(found)]] >= WINDOW
    at = np.flatnonzero(whole & long & np.isin(place, COVER))
    return at, found[at]


def _candidates(words: Words, flags: pa.ListArray) -> np.ndarray:
    """Starts (word numbers) of the windows that hold an anchor which occurs elsewhere."""
    at, found = _anchors(words)
    flags = flags.combine_chunks() if isinstance(flags, pa.ChunkedArray) else flags
    owner = np.asarray(pc.list_parent_indices(flags), dtype=np.int64)
    known = np.asarray(pc.list_flatten(flags), dtype=np.int64).view(np.uint64)
    name = lambda d, h: mix(h ^ mix(d.astype(np.uint64) + np.uint64(1)))
    hit = at[np.isin(name(words.doc[at], found), name(owner, known))]
    n = len(words.doc)
    start = np.flatnonzero(_around(hit, n))
    start = start[start + WINDOW <= n]
    return start[words.doc[start] == words.doc[start + WINDOW - 1]]


def _around(hit: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions are less than a period before a hit, or at it."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.maximum(hit - (PERIOD - 1), 0), 1)
    np.add.at(step, hit + 1, -1)
    return np.cumsum(step[:-1]) > 0


def _window_keys(hashes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = []
    for seed in (1, 2):
        out = np.full(len(start), mix(np.array([seed], np.uint64))[0])
        for k in range(WINDOW):
            out = (out ^ hashes[start + k]) * np.uint64(0xD6E8FEB86659FD93 if seed == 1 else 0xA3B195354A39B70D)
            out ^= out >> np.uint64(32)
        keys.append(mix(out).astype(np.int64))
    return keys[0], keys[1]


def _emit_windows(batches):
    names = ["a", "b", "at", "version", "start"]
    for piece in pieces(batches):
        words = words_of(piece.column("text"), NOT_SPACE)
        start = _candidates(words, piece.column("anchors"))
        a, b = _window_keys(words.hashes(), start)
        order = np.lexsort((start, a, words.doc[start]))  # a document's first start of a window speaks for it
        doc, a, b, start = words.doc[start][order], a[order], b[order], start[order]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        doc, start = doc[fresh], start[fresh]
        yield pa.RecordBatch.from_arrays([
            pa.array(a[fresh]), pa.array(b[fresh]), pa.array(np.asarray(piece.column("at"))[doc]),
            pa.array(np.asarray(piece.column("version"))[doc]), pa.array(start - words.first[doc])], names)


def _emit_kept(batches):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    for piece in pieces(batches):
        words = words_of(piece.column("text"), NOT_SPACE)
        start = _candidates(words, piece.column("anchors"))
        firsts = piece.column("firsts")
        owner = np.asarray(pc.list_parent_indices(firsts), dtype=np.int64)
        first = np.asarray(pc.list_flatten(firsts), dtype=np.int64) + words.first[owner]
        gone = covered(start[~np.isin(start, first)], WINDOW, len(words.doc))
        copy = np.asarray(piece.column("copy"))[words.doc]
        gone |= copy & (np.diff(words.first)[words.doc] >= WINDOW)
        raw, offsets = utf8(piece.column("text"))
        sums, texts = [], []
        for d in range(piece.num_rows):
            part = raw[offsets[d]:offsets[d + 1]].tobytes().split()
            text = b" ".join(compress(part, ~gone[words.first[d]:words.first[d + 1]]))
            sums.append(hashlib.sha256(text).hexdigest())
            texts.append(text.decode())
        count = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) if len(words.doc) else np.zeros(piece.num_rows, np.int64)
        count[np.diff(words.first) == 0] = 0
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.diff(words.first)), pa.array(count), pa.array(sums), pa.array(texts, pa.string())], names)


def _doc_anchors(piece):
    words = words_of(piece.column("text"), NOT_SPACE)
    at, found = _anchors(words)
    return words.doc[at], found


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row of ``docs``:
    words covered by a window of WINDOW words that also starts earlier (smaller
    doc_id, or earlier in the same document) are removed; ``kept`` is what is left.

    Null and empty texts have no words; a null doc_id comes after all others;
    rows that repeat a doc_id are copies of one document, none of them earlier;
    an empty table gives no rows; further columns are not read.
    """
    rows = keyed(docs)
    flags = cut(repeated_anchors(rows, _doc_anchors).groupBy("at", "version").agg(F.collect_set("anchor").alias("anchors")))
    heads = rows.groupBy(F.md5("text").alias("same"), F.octet_length("text").alias("size")).agg(F.min(F.struct("at", "version")).alias("head"))
    heads = cut(heads.select("head.at", "head.version", F.lit(False).alias("copy")))  # equal texts: the first one's windows speak for all
    marked = rows.join(flags.join(heads, ["at", "version"], "full"), ["at", "version"], "left")
    windows = marked.where("anchors is not null and copy is not null").select("doc_id", "at", "version", "text", "anchors").mapInArrow(
        _emit_windows, "a long, b long, at long, version long, start long")
    first = windows.groupBy("a", "b").agg(F.min(F.struct("at", "start", "version")).alias("first"))
    firsts = first.groupBy("first.at", "first.version").agg(F.collect_list("first.start").alias("firsts"))
    full = marked.join(firsts, ["at", "version"], "left").select(
        "doc_id", "at", "version", "text", F.coalesce("anchors", F.array().cast("array<long>")).alias("anchors"), F.coalesce("firsts", F.array().cast("array<long>")).alias("firsts"),
        F.coalesce("copy", F.lit(True)).alias("copy"))
    return full.mapInArrow(_emit_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
