"""Operator 10: benchmark decontamination by n-gram seeds and local alignment.

Seeds are the items' runs of SEED words. A bitmap of fixed size screens every
document's runs; the few hits carry the words around them and join the items on
every seed they share, however frequent. Each candidate (region of a document,
item) that has enough words in common is scored by a Smith-Waterman alignment of
words, so edited copies score by what is left of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import ALNUM, pieces, runs_of_words, cut, words_of

#: Words of a seed; alignment scores; share of an item's best score that marks a copy, and least words in common.
SEED, MATCH, MISMATCH, GAP = 4, 2, -1, -1
SHARE, LEAST_WORDS = 0.5, 6
#: Bits of the screening bitmap (1 MB).
BITMAP_BITS = 23


def _fit(n: int) -> int:
    """Seed length of an item with n words: shorter items seed on all their words."""
    return min(SEED, n)


def item_seeds(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, words, n) of every item that has words, and (seed, item_id)."""
    def run(batches):
        for piece in pieces(batches):
            words = words_of(piece.column("text"), ALNUM, True)
            hashes = words.hashes()
            per = [hashes[a:b] for a, b in zip(words.first, words.first[1:])]
            seeds = [np.unique(runs_of_words(h, np.zeros(len(h), np.int64), _fit(len(h)))[0]).astype(np.int64) if len(h) else np.zeros(0, np.int64) for h in per]
            yield pa.RecordBatch.from_arrays([
                piece.column("item_id"), pa.array([h.tobytes() for h in per], pa.binary()),
                pa.array([len(h) for h in per], pa.int64()), pa.array(seeds, pa.list_(pa.int64()))], ["item_id", "words", "n", "seeds"])
    rows = benchmark.selectExpr("cast(item_id as long) item_id", "text").where("item_id is not null")
    items = cut(rows.mapInArrow(run, "item_id long, words binary, n long, seeds array<long>").where("n > 0").dropDuplicates(["item_id", "words"]))
    return items.select("item_id", "words", "n"), items.select("item_id", F.explode("seeds").alias("seed")).distinct()


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Which of 2**BITMAP_BITS cells hold a seed."""
    cell = F.shiftrightunsigned("seed", 64 - BITMAP_BITS)
    rows = seeds.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number(F.col("cell")).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("cell"))).alias("bits")).collect()
    out = np.zeros(1 << BITMAP_BITS, bool)
    for row in rows:
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        numbers = (row["part"] - 1) * len(bits) + 1 + np.flatnonzero(bits)  # bucket k holds (k-1)*size+1 .. k*size
        numbers = numbers if row["part"] > 0 else np.zeros(1, np.int64)
        out[numbers[numbers < len(out)]] = True
    return out


def seed_hits(docs: DataFrame, seeds: DataFrame, lengths: list[int], reach: int) -> DataFrame:
    """(doc_id, row, region, words, seeds): stretches of a document around hits of the bitmap, ``reach`` words to each side."""
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(_bitmap(seeds)))

    def run(batches):
        marked = np.unpackbits(sent.value).astype(bool)
        for piece in pieces(batches):
            words = words_of(piece.column("text"), ALNUM, True)
            hashes = words.hashes()
            ats, seeds_ = [], []
            for n in lengths:
                found, whole = runs_of_words(hashes, words.doc, n)
                at = np.flatnonzero(whole & marked[(found >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)])
                ats.append(at)
                seeds_.append(found[at])
            at, seed = np.concatenate(ats), np.concatenate(seeds_).astype(np.int64)
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order]
            doc = words.doc[at]
            low = np.maximum(at - reach, words.first[doc])
            high = np.minimum(at + SEED + reach, words.first[doc + 1])
            fresh = np.ones(len(at), bool)  # overlapping stretches of a document are one
            fresh[1:] = (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
            cut = np.flatnonzero(fresh)
            ends = np.append(cut[1:], len(at)) - 1
            if not len(cut):
                continue
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id").take(pa.array(doc[cut])),
                pa.array(low[cut] - words.first[doc[cut]]),
                pa.array([hashes[a:b].tobytes() for a, b in zip(low[cut], high[ends])], pa.binary()),
                pa.array([np.unique(seed[a:b + 1]) for a, b in zip(cut, ends)], pa.list_(pa.int64()))], ["doc_id", "region", "words", "seeds"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, region long, words binary, seeds array<long>")


def align(words: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment score over the item's own best score, and the span of words where it ends a row at a time."""
    n = len(words)
    row, best, at = np.zeros(n + 1, np.int64), 0, 0
    ladder = GAP * np.arange(n + 1)
    for word in item:
        step = np.zeros(n + 1, np.int64)
        step[1:] = np.maximum(np.maximum(row[:-1] + np.where(words == word, MATCH, MISMATCH), row[1:] + GAP), 0)
        row = np.maximum.accumulate(step - ladder) + ladder  # gaps along the document
        top = int(row.argmax())
        if row[top] > best:
            best, at = int(row[top]), top
    return best / (MATCH * len(item)), max(0, at - len(item)), at


def _score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            words, item = np.frombuffer(r.words, np.uint64), np.frombuffer(r.item, np.uint64)
            common = int(np.isin(item, words).sum())
            if common < min(LEAST_WORDS, len(item)) or common < SHARE * len(item):
                continue
            share, start, end = align(words, item)
            if share >= SHARE:
                rows.append((r.doc_id, r.item_id, share, r.region + start, r.region + end))
        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "first_word", "last_word"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of the copies of benchmark
    items found in ``docs``: the best alignment of each document and item, with
    its rough span of words. ``score`` is the alignment's share of a full copy.

    Null or empty texts and items match nothing, null ids are left out, repeated
    rows give one row, an empty table on either side gives none; further columns
    are not read. Items shorter than a seed must stand in full.
    """
    items, seeds = item_seeds(benchmark)
    size = items.agg(F.max("n").alias("most"), F.collect_set(F.least("n", F.lit(SEED))).alias("lengths")).first()
    lengths = sorted(int(x) for x in size["lengths"]) if size["most"] else [SEED]
    hits = cut(seed_hits(docs.where("doc_id is not null"), seeds, lengths, int(size["most"] or 0)))
    single = hits.select("doc_id", "region", F.explode("seeds").alias("seed"))
    pairs = single.join(seeds, "seed").select("doc_id", "region", "item_id").distinct()
    both = pairs.join(hits.select("doc_id", "region", "words").distinct(), ["doc_id", "region"]).join(
        items.select("item_id", F.col("words").alias("item")), "item_id").select("doc_id", "region", "item_id", "words", "item")
    scored = both.mapInPandas(_score, "doc_id long, item_id long, score double, first_word long, last_word long")
    best = F.max(F.struct("score", (-F.col("first_word")).alias("at"), "last_word")).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.score", (-F.col("best.at")).alias("first_word"), "best.last_word")
