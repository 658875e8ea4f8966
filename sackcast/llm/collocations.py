"""Operator 12: collocations by top-order marginalisation.

Only the longest windows are counted: every word leads one window of ``longest``
words of its piece, padded with 0 where the piece ends. Spark's ROLLUP sums their
counts to the shorter prefixes, which are all shorter phrases: no n-gram of
another length is ever exploded.

A first pass counts the words of each language. Windows hold numbers instead of
words: the ``CODES`` most frequent have short codes, so that one long holds a
window; others have 63 bits of a hash, tried anew with another seed where two
words share one. A word of fewer than ``least`` places can't be part of a
candidate: a window ends before it. (Where words with codes run out, any other
word may be frequent, and keeps its hash.)
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .shared import cut, pieces, words_of

#: Bits of a code, and codes (0 is padding).
BITS = 20
CODES = (1 << BITS) - 1
#: Text bytes a task takes at once; rows a language's best are first looked for in.
BYTES, SALTS = 1 << 21, 64

_BREAK = np.zeros(256, bool)
_BREAK[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def _words(batch: pa.RecordBatch):
    """Of a batch: number of each word (of its language), whether the next one is of the same piece, the numbers' languages and words."""
    words = words_of(batch.column("text"), _WORD, lower=True)
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(words.end - words.start)])
    packed = np.ascontiguousarray(words.data[_WORD[words.data]])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]).dictionary_encode()
    langs = batch.column("lang").dictionary_encode()
    many = max(1, len(coded.dictionary))
    pair = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.doc] * many + coded.indices.to_numpy(zero_copy_only=False)
    kinds, number = np.unique(pair, return_inverse=True)
    passed = np.concatenate([np.zeros(1, np.int64), np.cumsum(_BREAK[words.data])])
    joined = (words.doc[1:] == words.doc[:-1]) & (passed[words.start[1:]] == passed[words.end[:-1]])
    return number, joined, langs.dictionary.take(pa.array(kinds // many)), coded.dictionary.take(pa.array(kinds % many))


def _ids(langs: pa.Array, words: pa.Array, seed: int) -> np.ndarray:
    heads = {x: x.encode() + b"\0" for x in langs.unique().to_pylist()}
    return np.fromiter((xxhash.xxh3_64_intdigest(heads[a] + b, seed) for a, b in zip(langs.to_pylist(), words.to_pylist())), np.uint64, len(words)) | np.uint64(1 << 63)


def word_counts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(lang, word, id, n) of all words; ``id`` is negative."""
    def run(batches):
        for part in pieces(batches, most=BYTES):
            number, _, langs, words = _words(part)
            yield pa.RecordBatch.from_arrays([langs.cast(pa.string()), words.cast(pa.large_string()).cast(pa.string()), pa.array(_ids(langs, words, seed).view(np.int64)),
                                              pa.array(np.bincount(number, minlength=len(words)))], ["lang", "word", "id", "n"])
    return _rows(docs).mapInArrow(run, "lang string, word string, id long, n long").groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def _coded(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray], full: bool) -> np.ndarray:
    """Number of each id: its code; else the id itself where any word may be frequent, or 0."""
    order, codes = table
    at = np.minimum(np.searchsorted(order, ids), max(0, len(order) - 1))
    known = order[at] == ids if len(order) else np.zeros(len(ids), bool)
    return np.where(known, codes[at] if len(order) else 0, ids.view(np.int64) if full else 0)


def _columns(longest: int) -> list[str]:
    return [f"k{j}" for j in range(longest)]


def window_counts(docs: DataFrame, table, full: bool, longest: int, seed: int) -> DataFrame:
    """(k0.., n): the windows of all words and how often they stand, counted in blocks of text. Where all of a
    window's numbers are codes and fit one long, k0 holds them all and the others are null."""
    sent = docs.sparkSession.sparkContext.broadcast(table)
    names, fits = _columns(longest), BITS * longest < 63

    def run(batches):
        for part in pieces(batches, most=BYTES):
            number, joined, langs, words = _words(part)
            value = _coded(_ids(langs, words, seed), sent.value, full)[number]
            cells = [value]
            open_ = value != 0
            for j in range(1, longest):
                following = np.zeros(len(value), np.int64)
                same = np.zeros(len(value), bool)
                same[:len(value) - j] = joined[j - 1:]
                following[:len(value) - j] = value[j:]
                open_ = open_ & same
                following[~open_] = 0
                open_ = open_ & (following != 0)
                cells.append(following)
            led = value != 0
            cells = [x[led] for x in cells]
            coded = np.all([x >= 0 for x in cells], axis=0) if fits else np.zeros(len(cells[0]), bool)
            whole = np.zeros(int(coded.sum()), np.int64)
            for x in cells:
                whole = (whole << BITS) | x[coded]
            keys, n = np.unique(whole, return_counts=True)
            none = pa.nulls(len(keys), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys), *[none] * (longest - 1), pa.array(n)], [*names, "n"])
            wide = [x[~coded] for x in cells]
            order = np.lexsort(wide[::-1])
            wide = [x[order] for x in wide]
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.any([x[1:] != x[:-1] for x in wide], axis=0)
            at = np.flatnonzero(fresh)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in wide), pa.array(np.diff(np.append(at, len(order))))], [*names, "n"])
    counted = _rows(docs).mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n"))
    if not fits:
        return counted.select(*(F.col(x).alias(f"w{j}") for j, x in enumerate(names)), "n")
    return counted.select(*(F.when(F.col("k1").isNull(), F.shiftright("k0", BITS * (longest - 1 - j)).bitwiseAND(F.lit(CODES))).otherwise(F.col(x)).alias(f"w{j}")
                            for j, x in enumerate(names)), "n")


def _phrases(windows: DataFrame, longest: int, least: int) -> DataFrame:
    """(w0.., n): every phrase of 1 to ``longest`` words with at least ``least`` places; the numbers after a shorter one's are null."""
    w = [f"w{j}" for j in range(longest)]
    top = windows.where((F.col(w[-1]) != 0) & (F.col("n") >= least))
    shorter = windows.rollup(*w[:-1]).agg(F.sum("n").alias("n")).where((F.coalesce(*w[-2::-1]) != 0) & (F.col("n") >= least))
    return top.unionByName(shorter.withColumn(w[-1], F.lit(None).cast("long")))


def mine_collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, best: int = 2000, codes: int = CODES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of 2 to ``longest`` words of each language.

    ``a`` places of the phrase, at least ``least``; l and r those of its parts at
    the cut with the least score, floor(1000000 a a / (l r)), ties to the earliest
    cut; ``n`` words of the language. A phrase is dropped inside a longer one with
    at least ``share`` per cent of its places. Order: score and places falling,
    phrase rising (bytes). Null lang is ``und``, null text empty; repeated rows
    count each; other columns are ignored; an empty table, or one without frequent
    phrases, gives no rows. Products are decimals of 38 digits (places under 10**15).
    """
    if longest < 2 or codes > CODES:
        raise ValueError("a phrase has at least two words, a code at most BITS bits")
    for seed in count():
        words = cut(word_counts(docs, seed))
        if words.groupBy("id").count().where("count > 1").isEmpty():
            break
    often = words.where(F.col("n") >= least)
    top = often.orderBy(F.col("n").desc(), "id").limit(codes).select("id").toPandas()["id"].to_numpy(np.int64).view(np.uint64)  # CODES numbers at most
    order = np.argsort(top)
    table = (top[order], order + 1)
    full = len(top) == codes
    w = [f"w{j}" for j in range(longest)]
    found = cut(_phrases(cut(window_counts(docs, table, full, longest, seed)), longest, least))  # both of its parts read the windows

    def of(m: int, names: list[str], value: str) -> DataFrame:
        """Phrases of m words, their columns named anew."""
        rows = found.where(F.col(w[m - 1]).isNotNull() & (F.col(w[m]).isNull() if m < longest else F.lit(True)))
        return rows.select(*(F.col(x).alias(y) for x, y in zip(w, names)), F.col("n").alias(value))

    scored = []
    for m in range(2, longest + 1):
        rows = of(m, w[:m], "a")
        cuts = []
        for k in range(1, m):
            rows = rows.join(of(k, w[:k], f"l{k}"), w[:k]).join(of(m - k, w[k:m], f"r{k}"), w[k:m])
            exact = [F.col(x).cast("decimal(15,0)") for x in ("a", f"l{k}", f"r{k}")]
            rows = rows.withColumns({"top": F.lit(1000000).cast("decimal(7,0)") * exact[0] * exact[0], "under": exact[1] * exact[2]})
            rows = rows.withColumn(f"s{k}", F.expr("top div under")).drop("top", "under")
            cuts.append(F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        rows = rows.select(*w[:m], "a", F.array_min(F.array(*cuts)).alias("cut"))
        inside = None
        for longer in range(m + 1, longest + 1):
            whole = of(longer, w[:longer], "whole")
            for first in range(longer - m + 1):
                part = whole.select(*(F.col(w[first + j]).alias(w[j]) for j in range(m)), "whole")
                inside = part if inside is None else inside.unionByName(part)
        if inside is not None:
            rows = rows.join(inside.groupBy(*w[:m]).agg(F.max("whole").alias("whole")), w[:m], "left").where(F.col("whole").isNull() | (100 * F.col("whole") < share * F.col("a"))).drop("whole")
        scored.append(rows.select(*w[:m], *(F.lit(None).cast("long").alias(x) for x in w[m:]), "a", "cut.*").drop("k"))
    rows = scored[0]
    for more in scored[1:]:
        rows = rows.unionByName(more)

    sent = docs.sparkSession.sparkContext.broadcast(table)

    def name(batches):
        for batch in batches:
            yield batch.append_column("number", pa.array(_coded(batch.column("id").to_numpy().view(np.uint64), sent.value, full)))
    names = often.select("lang", "word", "id").mapInArrow(name, "lang string, word string, id long, number long")
    rows = rows.join(names.select("lang", F.col("word").alias("t0"), F.col("number").alias(w[0])), w[0])
    for j in range(1, longest):
        rows = rows.join(names.select(F.col("word").alias(f"t{j}"), F.col("number").alias(w[j])), w[j], "left")
    rows = rows.select("lang", F.concat_ws(" ", *(f"t{j}" for j in range(longest))).alias("phrase"), "a", "l", "r", "score")
    first = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):  # no task sees more than a salt's rows, or the best of all salts
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(F.col("rank") <= best)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
