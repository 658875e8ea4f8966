"""Operator 6: exact top-k inner products in three phases with a threshold a query.

Vectors are dealt into chunks by a hash of their id; a tile pairs candidates of a
chunk with a group of queries, and nothing is sent once a block of the other side.

Phase 1 gathers each tile's local lists (the k best) over a small share of the
candidates; the k-th best of all gathered is a safe cutoff of the query. Phase 2
sends the cutoffs back to the queries. Phase 3 looks at the next, larger share: the
partial score by the leading digits must reach the cutoff less a bound of the digits
left out (lengths of vectors and of what rounding took); only what is left is scored
exactly, and raises the cutoffs for the next share, until all candidates are through.
Partial scores of several candidates are the digits of one float64 (``_lanes``), so
that their product costs a fraction of the exact one.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .shared import cut, mix, passing

#: Candidates multiplied at once, queries multiplied at once; blocks of candidates and queries of a tile.
BLOCK, QUERIES, TILE, GROUP = 1024, 1024, 128, 1 << 18

#: Of STEPS equal shares of the candidates, how many are through after each round; rounds of under LEAST
#: blocks are left to the next. A round has SPREAD tiles at least, if there are as many chunks of queries.
STEPS, ROUNDS, LEAST, SPREAD = 512, (1, 16, 128), 16, 32

#: Vectors of a packed row; some 300 KB, which a JVM moves without trouble.
PIECE = 2048

#: Components of a vector up to which a tile takes that many vectors; fewer of longer ones.
DIM = 64

#: Cells of exact products and rows of results handled at once.
CELLS, ROWS = 1 << 22, 1 << 16

#: Kinds of packed rows; candidates have CANDIDATE and their round from 0.
QUERY, CUTOFF, CANDIDATE = range(3)

#: Blocks of candidates of similar lengths.
LEVEL = 32

#: Queries that one sign test covers.
SIGNS = 8

#: Share of a block's rows of candidates from which a query is scored with the whole block.
BUSY = 0.15

_LOWEST = np.iinfo(np.int64).min
_PACKED = "kind int, chunk int, dim int, width int, n long, queries long, ids binary, cells binary"
_TILED = "tile int, kind int, dim int, width int, ids binary, cells binary"
_FOUND = "query_id long, vec_id long, score long"


def scaled_vectors(rows: DataFrame, column: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, cells): floor(scale * x); vectors null or with null or non-finite components are left out."""
    wide = F.transform(F.col(column), lambda x: x.cast("double"))
    good = F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return rows.where(good & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(wide, lambda x: F.floor(x * scale)).alias("cells"))


def _packed(kind: int, chunk: int, ids: np.ndarray, cells: np.ndarray, every: int) -> dict:
    """One row of many vectors; their cells take as few bytes as hold them."""
    low, high = int(cells.min(initial=0)), int(cells.max(initial=0))
    width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return {"kind": kind, "chunk": chunk, "dim": cells.shape[1], "width": width, "n": len(ids), "queries": int((ids % every == 0).sum()),
            "ids": ids.tobytes(), "cells": cells.astype(f"<i{width}").tobytes()}


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch of packed ones; ids and cells stay where they are."""
    for i in range(batch.num_rows):
        yield {x: batch.column(x)[i].as_buffer() if x in ("ids", "cells") else batch.column(x)[i].as_py() for x in batch.schema.names}


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["cells"], f"<i{row['width']}").reshape(len(ids), row["dim"])


_PACKED_ARROW = pa.schema([(x, pa.int32()) for x in ("kind", "chunk", "dim", "width")] + [(x, pa.int64()) for x in ("n", "queries")] + [(x, pa.binary()) for x in ("ids", "cells")])


def _gathered(every: int, rows: int):
    """Packs each batch of (vec_id, cells), so many to a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("vec_id"), np.int64)
            size = np.asarray(pc.list_value_length(batch.column("cells")), np.int64)
            flat = np.asarray(batch.column("cells").flatten(), np.int64)
            first = np.cumsum(size) - size
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                for some in np.split(at, range(rows, len(at), rows)):
                    yield pa.RecordBatch.from_pylist([_packed(CANDIDATE, 0, ids[some], flat[first[some][:, None] + np.arange(dim)], every)], _PACKED_ARROW)
    return run


def _chunk_of(ids: np.ndarray, chunks: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk of each id, and what the hash has besides."""
    hashed = mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return (hashed % np.uint64(chunks)).astype(np.int64), hashed // np.uint64(chunks)


def _dealt(chunks: int, every: int):
    """Splits packed rows by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                ids, cells = _unpacked(row)
                chunk, _ = _chunk_of(ids, chunks)
                order = np.argsort(chunk, kind="stable")
                edges = np.flatnonzero(np.diff(chunk[order], prepend=-1))
                rows = [_packed(CANDIDATE, int(chunk[at[0]]), ids[at], cells[at], every) for at in np.split(order, edges[1:])]
                yield pa.RecordBatch.from_pylist(rows, _PACKED_ARROW)
    return run


def _alike(cells: np.ndarray) -> np.ndarray:
    """A hash of each vector."""
    total = np.zeros(len(cells), np.uint64)
    for k in range(cells.shape[1]):
        total = mix(total ^ cells[:, k].astype(np.int64).view(np.uint64))
    return total


def _distinct(ids: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors in the order of their hash and id, and the place of each among equal ones."""
    hashed = _alike(cells)
    order = np.lexsort((ids, hashed))
    ids, cells, hashed = ids[order], cells[order], hashed[order]
    same = np.zeros(len(ids), bool)  # equal vectors are neighbours, or the hash has put another between them
    same[1:] = (hashed[1:] == hashed[:-1]) & (cells[1:] == cells[:-1]).all(axis=1)
    fresh = ~same
    fresh[1:] |= ids[1:] != ids[:-1]
    ids, cells, same = ids[fresh], cells[fresh], same[fresh]
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
    return ids, cells, np.arange(len(ids)) - start


def _chunked(chunks: int, steps: int, rounds: list[int], every: int, k: int, rows: int):
    """Packs a chunk's distinct vectors: its queries, and its candidates by round. Of equal
    candidates the k + 1 smallest ids suffice, as one may be the query's own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(list)
        for batch in batches:
            for row in _rows(batch):
                held[row["chunk"], row["dim"]].append(_unpacked(row))
        batch = row = None
        while held:
            (chunk, _), parts = held.popitem()
            ids, cells, place = _distinct(*map(np.concatenate, zip(*parts)))
            del parts
            step = (_chunk_of(ids, chunks)[1] % np.uint64(steps)).astype(np.int64)
            kinds = np.where(place <= k, CANDIDATE + np.searchsorted(rounds, step, "right"), -1)
            for kind in (QUERY, *range(CANDIDATE, CANDIDATE + len(rounds))):
                at = np.flatnonzero(ids % every == 0 if kind == QUERY else kinds == kind)
                for first in range(0, len(at), rows):
                    some = at[first:first + rows]
                    yield pa.RecordBatch.from_pylist([_packed(kind, chunk, ids[some], cells[some], every)], _PACKED_ARROW)
    return run


def _cutoffs(chunks: int):
    """Packs (query_id, score) by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, score = (np.asarray(batch.column(x), np.int64) for x in ("query_id", "score"))
            chunk, _ = _chunk_of(ids, chunks)
            for one in np.unique(chunk):
                at = chunk == one
                yield pa.RecordBatch.from_pylist([_packed(CUTOFF, int(one), ids[at], score[at][:, None], 1)], _PACKED_ARROW)
    return run


def _lanes(dim: int) -> tuple[int, int, int, float]:
    """Lanes of a float64, bits of each, the largest product of coarse vectors (whole numbers) that fits
    a lane with a threshold taken off, and the length vectors are brought to before rounding. As many
    lanes as leave what rounding takes from two vectors under 15 % of their lengths' product."""
    for lanes in (4, 3, 2):
        bits = 52 // lanes
        most = (1 << bits - 2) - 1
        length = math.sqrt(most) - math.sqrt(dim) / 8
        if 2 * math.sqrt(dim / 12) <= 0.15 * length:
            break
    return lanes, bits, most, length


def _length(cells: np.ndarray) -> np.ndarray:
    exact = cells.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", exact, exact))


def _coarse(cells: np.ndarray, length: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, vectors of about ``length`` in whole numbers (of squares up to ``most``), and how far these are from the exact ones."""
    own = _length(cells)
    exact = cells * (length / np.where(own > 0, own, 1))[:, None]
    whole = np.rint(exact)
    far = np.einsum("ij,ij->i", whole, whole) > most
    whole[far] = np.trunc(exact[far])
    return own, whole, _length(exact - whole)


def _keep(key: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best distinct entries of each key, by score, then smaller id, and their ranks from 0."""
    order = np.lexsort((ids, ~score, key))
    key, ids, score = key[order], ids[order], score[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    key, ids, score = key[fresh], ids[fresh], score[fresh]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    rank = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    top = rank < k
    return key[top], ids[top], score[top], rank[top]


def _ordered(cells: np.ndarray, block: int) -> tuple[np.ndarray, float]:
    """Candidates by length, those of some blocks by what rounding takes, so that a block's largest hold for most of it; the largest length."""
    _, _, most, length = _lanes(cells.shape[1])
    parts = [_coarse(cells[i:i + block], length, most)[::2] for i in range(0, len(cells), block)]
    own, off = map(np.concatenate, zip(*parts))
    level = np.empty(len(own), np.int64)
    level[np.argsort(-own, kind="stable")] = np.arange(len(own)) // (LEVEL * block)
    return np.lexsort((off, level)), own.max()


class _Block:
    """Candidates of similar lengths: exact, and several coarse ones to a row of ``packs``. The last
    lane holds the negative, so that the sign bits of all lanes are set where no candidate reaches its query's threshold."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray):
        self.ids, self.cells = ids, cells
        self.lanes, bits, self.most, self.length = _lanes(cells.shape[1])
        self.shift = [bits * j for j in range(self.lanes - 1)] + [52 - bits]
        self.bit = [s + bits - 1 for s in self.shift]
        self.sign = np.int64(sum(1 << b for b in self.bit))
        unit = [float(1 << s) for s in self.shift]
        unit[-1] *= -1
        self.unit = sum(unit)
        own, whole, off = _coarse(cells, self.length, self.most)
        self.shortest, self.longest, self.off = max(own.min(), 1e-9), max(own.max(), 1e-9), off.max()
        self.size = -(-len(ids) // self.lanes)
        self.packs = np.zeros((self.size, cells.shape[1] + 1))
        self.packs[:, -1] = 1
        for j, u in enumerate(unit):
            part = whole[j * self.size:(j + 1) * self.size]
            self.packs[:len(part), :-1] += u * part

    def threshold(self, aim: np.ndarray, whole: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """Least partial score of an entry whose score reaches the cutoff, less one (a lane may lose one to the next)."""
        return np.floor(aim * np.where(aim > 0, 1 / self.longest, 1 / self.shortest) - whole * self.off - slack) - 1

    def near(self, wide: np.ndarray, threshold: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate) places whose partial score reaches the threshold, and the queries that
        reach it nearly everywhere, whose places are left out. All sums are whole and below 2**53."""
        wide[:, -1] = 1.5 * 2.0 ** 52 - self.most * self.unit
        wide[:len(threshold), -1] = 1.5 * 2.0 ** 52 - np.clip(threshold, -self.most, self.most) * self.unit
        x = np.matmul(wide, self.packs.T, out=out[:len(wide) * self.size].reshape(len(wide), self.size)).view(np.int64)
        flag = np.bitwise_and.reduce(x.reshape(-1, SIGNS, self.size), axis=1) & self.sign != self.sign
        some, busy = np.flatnonzero(flag), np.zeros(0, int)
        if len(some) < flag.size // 2:
            group, col = np.divmod(some, self.size)
            place = (group * (SIGNS * self.size) + col)[:, None] + self.size * np.arange(SIGNS)
            place = place[x.ravel()[place] & self.sign != self.sign]
        else:
            flag = x & self.sign != self.sign
            busy = np.flatnonzero(np.count_nonzero(flag, axis=1) > BUSY * self.size)
            flag[busy] = False
            place = np.flatnonzero(flag)
        seen = x.ravel()[place]
        hits = [place[seen >> b & 1 == 0] for b in self.bit]
        at, to = np.divmod(np.concatenate(hits), self.size)
        to += np.repeat(self.size * np.arange(self.lanes), [len(h) for h in hits])
        real = to < len(self.ids)
        return at[real], to[real], busy


class _Search:
    """The k best candidates of a block of queries, those below the queries' cutoffs left out."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray, cutoff: np.ndarray, k: int):
        self.ids, self.cells, self.k = ids, cells, k
        self.cutoff = cutoff.copy()
        self.found = [np.zeros((3, 0), np.int64)]
        self.pending = 0

    def add(self, at: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        good = (score >= self.cutoff[at]) & (ids != self.ids[at])
        self.found.append(np.stack([at[good], ids[good], score[good]]))
        self.pending += int(good.sum())

    def trim(self) -> np.ndarray:
        """Keeps the k best and raises the cutoffs."""
        at, ids, score, rank = _keep(*np.concatenate(self.found, axis=1), self.k)
        last = rank == self.k - 1
        self.cutoff[at[last]] = np.maximum(self.cutoff[at[last]], score[last])
        self.found, self.pending = [np.stack([at, ids, score])], 0
        return self.found[0]

    def all_of(self, block: _Block, at: np.ndarray, kind: type) -> None:
        """Scores these queries with the whole block."""
        score = self.cells[at].astype(kind) @ block.cells.astype(kind).T
        lowest = _LOWEST if kind is np.int64 else -np.inf
        score[self.ids[at][:, None] == block.ids] = lowest
        if len(block.ids) > self.k:
            bar = np.partition(score, -self.k, axis=1)[:, -self.k:].min(axis=1)
        else:
            bar = np.full(len(at), lowest, score.dtype)
        row, to = np.nonzero((score >= bar[:, None]) & (self.ids[at][:, None] != block.ids))
        self.add(at[row], block.ids[to], score[row, to].astype(np.int64))

    def run(self, blocks: list[_Block], longest: float) -> np.ndarray:
        own, whole, off = _coarse(self.cells, blocks[0].length, blocks[0].most)
        wide = np.zeros((SIGNS * -(-len(whole) // SIGNS), whole.shape[1] + 1))
        wide[:len(whole), :-1] = whole
        whole = _length(whole)
        out = np.empty(len(wide) * max(x.size for x in blocks))
        most = own.max() * longest  # no sum of some of the products is larger
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        slack, aim = off * blocks[0].length + 1e-6, None
        for block in blocks:
            if aim is None:
                least = np.where(self.cutoff == _LOWEST, -np.inf, self.cutoff)
                aim = np.where(own > 0, least, np.copysign(np.inf, least - 0.5)) * (blocks[0].length ** 2 / np.where(own > 0, own, 1))
            threshold = block.threshold(aim, whole, slack)
            if (threshold > block.most).all():
                continue
            if (threshold > -block.most).any():
                at, to, busy = block.near(wide, threshold, out)
            else:
                at, to, busy = np.zeros(0, int), np.zeros(0, int), np.arange(len(self.ids))
            step = max(1, CELLS // wide.shape[1])
            for first in range(0, len(at), step):
                a, t = at[first:first + step], to[first:first + step]
                self.add(a, block.ids[t], np.einsum("ij,ij->i", self.cells[a].astype(kind), block.cells[t].astype(kind)).astype(np.int64))
            if len(busy):
                self.all_of(block, busy, kind)
            if len(busy) or self.pending > self.k * len(self.ids):
                self.trim()
                aim = None
        return self.trim()


def _scored(k: int, block: int, queries: int):
    """The k best candidates of each query in each tile."""
    def tile(held: dict) -> np.ndarray:
        ids, score = np.concatenate([np.zeros((2, 0), np.int64), *held.pop(None, [])], axis=1)
        order = np.argsort(ids)
        ids, score = ids[order], score[order]
        found = [np.zeros((3, 0), np.int64)]
        while held:
            _, both = held.popitem()
            if not all(both):
                continue
            (q_ids, q), (c_ids, c) = (tuple(map(np.concatenate, zip(*x))) for x in both)
            del both
            order, longest = _ordered(c, block)
            c_ids, c = c_ids[order], c[order]
            blocks = [_Block(c_ids[i:i + block], c[i:i + block]) for i in range(0, len(c), block)]
            place = np.searchsorted(ids, q_ids)
            place[place == len(ids)] = 0
            cutoff = np.where(ids[place] == q_ids, score[place], _LOWEST) if len(ids) else np.full(len(q_ids), _LOWEST)
            for i in range(0, len(q), queries):
                at, vec, best = _Search(q_ids[i:i + queries], q[i:i + queries], cutoff[i:i + queries], k).run(blocks, longest)
                found.append(np.stack([q_ids[i:i + queries][at], vec, best]))
        return np.stack(_keep(*np.concatenate(found, axis=1), k)[:3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = defaultdict(lambda: defaultdict(lambda: ([], [])))  # by dimensions; cutoffs under None
        for batch in batches:
            for row in _rows(batch):
                ids, cells = _unpacked(row)
                held = tiles[row["tile"]]
                if row["kind"] == CUTOFF:
                    held.setdefault(None, []).append(np.stack([ids, cells[:, 0]]))
                else:
                    held[row["dim"]][row["kind"] != QUERY].append((ids, cells))
        batch = row = ids = cells = held = None  # what they hold is not needed beside the tile's arrays
        while tiles:
            found = tile(tiles.popitem()[1])
            for first in range(0, found.shape[1], ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x[first:first + ROWS]) for x in found], ["query_id", "vec_id", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _tiles(packed: DataFrame, kind: int, rows: int, columns: int, cutoffs: DataFrame | None = None) -> DataFrame:
    """Every query with the candidates of one kind, in ``rows`` groups of queries by ``columns`` of candidates."""
    at = F.pmod("chunk", F.lit(rows)) * columns
    asked = packed.where(F.col("kind") == QUERY)
    asked = asked if cutoffs is None else asked.unionByName(cutoffs)
    asked = asked.withColumn("tile", F.explode(F.sequence(at, at + columns - 1)))
    there = packed.where(F.col("kind") == kind).withColumn("tile", F.pmod("chunk", F.lit(columns)))
    there = there.withColumn("tile", F.explode(F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.col("tile") + r * columns)))
    names = [x.split()[0] for x in _TILED.split(", ")]
    return asked.select(names).unionByName(there.select(names)).repartitionById(rows * columns, "tile")


def exact_top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, cells) rows: queries are the
    ids divisible by ``every``, candidates all rows but those with the query's
    own id; the ``k`` highest integer inner products, ties to the smaller id.

    Vectors are compared with those of the same length; repeated rows count
    once; null ids take no part; an empty table, or a query alone, gives no rows.
    Sums hold in 64 bits.
    """
    with passing(vectors.sparkSession):
        rows = cut(vectors.select("vec_id", "cells").where("vec_id is not null and cells is not null").mapInArrow(_gathered(every, PIECE), _PACKED))
        much = F.greatest(F.lit(1.0), F.col("dim") / DIM)
        counts = rows.agg(*(F.ceil(F.sum(F.col(x) * much)).alias(x) for x in ("n", "queries"))).first()
        n, q = counts["n"] or 0, counts["queries"] or 0
        tile = TILE * BLOCK
        chunks, groups = max(1, -(-n // tile)), max(1, -(-q // GROUP))
        rounds = [x for x in ROUNDS if n * x >= LEAST * BLOCK * STEPS] + [STEPS]
        packed = cut(rows.mapInArrow(_dealt(chunks, every), _PACKED).repartitionById(chunks, "chunk")
                     .mapInArrow(_chunked(chunks, STEPS, rounds, every, k, PIECE), _PACKED), keep=True)
        best = None
        for at, (before, after) in enumerate(zip([0, *rounds], rounds)):
            columns = max(1, -(-n * (after - before) // (tile * STEPS)))
            across = max(groups, min(chunks, -(-SPREAD // columns)))
            cutoffs = None if best is None else best.where(F.col("rank") == k).select("query_id", "score").mapInArrow(_cutoffs(chunks), _PACKED)
            found = _tiles(packed, CANDIDATE + at, across, columns, cutoffs).mapInArrow(_scored(k, BLOCK, QUERIES), _FOUND)
            best = _best(found if best is None else best.select("query_id", "vec_id", "score").unionByName(found), k)
            if after < STEPS:
                best = cut(best, keep=at == len(rounds) - 2)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
