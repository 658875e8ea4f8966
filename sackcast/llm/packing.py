"""Operator 13: best-fit packing of token sequences by the sum of squares.

Documents become token ids (a public tokenizer's file, named by a parameter)
and are cut into pieces of at most ``most`` tokens. Full pieces are sequences of
their own. The others are dealt into groups of about ``GROUP`` pieces; in a
group, longest first, each piece goes to the open bin after which the squares of the
numbers of open bins per residual gap sum to least; a new bin is opened where
none has room.

A pretoken's ids do not depend on what stands around it, so a task tokenizes
each distinct one once: texts are split at white space and, between ASCII bytes,
where the tokenizer's own pattern always splits (letters, single digits, other
signs), except beside ``'`` and ``|``, which its contractions and special tokens hold.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .shared import LOWER, NOT_SPACE, cut, pieces, utf8

#: Pieces of a group on average, distinct pretokens a task keeps, and text bytes it takes at once.
GROUP, KNOWN, BYTES = 1 << 16, 1 << 20, 1 << 23

# classes of bytes: 0 never split beside, 1 letters, 2 digits, 3 other ASCII
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
_CLASS[[0x27, 0x7C]] = 0

_SPLIT = np.flatnonzero(_CLASS).astype(np.uint8).tobytes()

_PIECE = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long"


def pretokens(column) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Every pretoken of an Arrow text column, dictionary coded, and the first of each text (n + 1)."""
    data, offsets = utf8(column)
    inside = NOT_SPACE[data]
    kind = _CLASS[data]
    start = np.zeros(len(data), bool)
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    left, right = kind[:-1], kind[1:]
    start[1:] |= ~inside[:-1] | ((left > 0) & (right > 0) & ((left != right) | (left == 2)))
    start &= inside
    first = np.searchsorted(np.flatnonzero(start), offsets)
    packed = data[inside]
    if not (packed == 0x7C).any():  # a special token's letters must keep their case
        packed = LOWER[packed]
    bounds = np.append(np.flatnonzero(start[inside]), len(packed)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(packed))])
    return words.dictionary_encode(), first


class TextTokens:
    """Token ids of texts by the tokenizer in a file; the ids of distinct pretokens are kept, ``KNOWN`` of them at most."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.public = Tokenizer.from_file(path)
        #: little-endian 32-bit ids of each
        self.known: dict[bytes, bytes] = {}
        #: which ids end a pretoken
        self.ends = np.zeros(self.public.get_vocab_size(), bool)
        self.ends[[i for word, i in self.public.get_vocab().items() if word.endswith("</w>")]] = True

    def _keep(self, words: list[bytes], ids: list[int], cuts: np.ndarray) -> None:
        raw = np.array(ids, "<u4").tobytes()
        at = (4 * cuts).tolist()
        self.known.update(zip(words, map(raw.__getitem__, map(slice, at[:-1], at[1:]))))

    def _learn(self, words: list[bytes]) -> None:
        """Many pretokens go in one call, a space between them. The ids of plain ones (ASCII, no open sign) are told
        apart by those that end a pretoken, the others' by the places in the text that they came from."""
        plain = [w for w in words if not w.translate(None, _SPLIT)] if self.ends.any() else []
        for low in range(0, len(plain), 4096):
            part = plain[low:low + 4096]
            ids = self.public.encode(b" ".join(part).decode(), add_special_tokens=False).ids
            cuts = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
            if len(cuts) == len(part) + 1 and cuts[-1] == len(ids):
                self._keep(part, ids, cuts)
        rest = [w for w in words if w not in self.known]
        for low in range(0, len(rest), 4096):
            part = rest[low:low + 4096]
            texts = [w.decode() for w in part]
            found = self.public.encode(" ".join(texts), add_special_tokens=False)
            starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
            self._keep(part, found.ids, np.searchsorted(np.array([x for x, _ in found.offsets], np.int64), starts))

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow text column's texts, end to end, each with id 0 after its own; the bounds of each (n + 1)."""
        coded, first = pretokens(column)
        words = coded.dictionary.to_pylist()
        if len(self.known) > KNOWN:
            self.known.clear()
        found = list(map(self.known.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        self._learn([words[k] for k in new])
        for k in new:
            found[k] = self.known[words[k]]
        found.append(bytes(4))  # what every text ends with
        many = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        at = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), first[1:], len(words))
        each = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(many))), pa.array(flat, pa.uint32()))
        ids = each.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(many[at]))
        return ids, ends[first + np.arange(len(first))]


_OPEN: dict[str, TextTokens] = {}


def tokenizer(path: str) -> TextTokens:
    """The tokenizer of a file, one a worker process."""
    if path not in _OPEN:
        _OPEN[path] = TextTokens(path)
    return _OPEN[path]


def token_pieces(docs: DataFrame, path: str, most: int) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of every piece; ``row`` names it."""
    def run(batches):
        encode, row = tokenizer(path), TaskContext.get().partitionId() << 40
        for part in pieces(batches, most=BYTES):
            ids, bounds = encode(part.column("text"))
            size = np.diff(bounds)
            count = -(-size // most)
            doc = np.repeat(np.arange(len(size)), count)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = number * most
            length = np.minimum(size[doc] - start, most)
            low = bounds[doc] + start
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(low, low + length)]
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(doc))), part.column("doc_id").take(pa.array(doc)), pa.array(number.astype(np.int32)),
                pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["row", "doc_id", "piece", "start", "length", "ids_crc32"])
            row += len(doc)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECE)


def pack_sizes(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, taken in order: it goes to the open bin after which the squared counts of
    open bins per gap sum to least, ties to the smaller gap; a new bin is opened where none has room."""
    count = np.zeros(most + 1, np.int64)  # open bins by gap; [0] stays 0: full bins are closed
    open_bins: list[list[int]] = [[] for _ in range(most + 1)]
    bins, offset, made = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    nowhere = np.iinfo(np.int64).max
    for k, s in enumerate(sizes.tolist()):
        here = count[s:]  # gaps s .. most
        change = np.where(here > 0, 2 * (count[:most + 1 - s] - here) + 2, nowhere)
        if here[0]:
            change[0] -= 1  # the bin is closed instead of moved
        best = int(np.argmin(change))
        if change[best] < nowhere:
            gap = s + best
            count[gap] -= 1
            b = open_bins[gap].pop()
        else:
            gap, b = most, made
            made += 1
        bins[k], offset[k] = b, most - gap
        if gap > s:
            count[gap - s] += 1
            open_bins[gap - s].append(b)
    return bins, offset


def pack_documents(docs: DataFrame, path: str, most: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    ``path``: a tokenizer file that every executor can open at that place (an
    installed library's). A null or empty text is the single id 0; a null doc_id
    stays null; every one of repeated rows is packed; other columns are ignored;
    an empty table gives no rows. No sequence is longer than ``most`` tokens, and
    places in it leave no gap. Pieces are named by task and place in the written
    table, so one key or text that many rows hold is spread over the groups.
    """
    made = cut(token_pieces(docs, path, most))
    short = made.where(F.col("length") < most)
    groups = max(1, -(-short.count() // GROUP))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], kind="stable")
        bins, offset = pack_sizes(frame["length"].to_numpy(np.int64), most)
        return frame.drop(columns="group").assign(bin=bins, offset=offset, group=frame["group"])
    placed = (short.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
              .groupBy("group").applyInPandas(place, _PLACED + ", group long"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = made.where(F.col("length") == most).select(*kept, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # full pieces have non-negative numbers, groups' bins negative ones
    return full.unionByName(placed.select(*kept, (-1 - (F.col("bin") * groups + F.col("group"))).alias("sequence_id"), "offset"))
