"""Operator 4: n-gram Jaccard join with rare-first prefix filtering.

A document is its set of distinct word shingles. Sets are ordered rarest first
by a frequency table of hashed shingles, counted over all documents; two sets
that reach the threshold share a shingle within their prefixes. Documents are
joined on prefix shingles; length, positional and suffix filters (a bound on
the overlap from the positions, from the parities of the set in SKETCH cells, which
differ at most where the sets do) leave candidate pairs. These are compared by
parities in about as many cells as the sets have shingles, and what is left is
verified once, exactly, on the whole sets.

Equal sets are one class, so copies are never joined with each other. Within a
shingle's list not all pairs are made: every class is first joined with the
list's hubs (linear), which settles most components; after that only pairs
between different components matter. Short lists give theirs directly. The rows
of a long list (a group of near copies) are compared by their differences from
one hub: |x ^ y| = |(x ^ hub) ^ (y ^ hub)|, so linked rows share a part of their
differences, and prefixes of the differences, rarest in the group first, are
joined with the same filters. Copies edited each in its own way share none, so
such a group costs little more than its differences, and no link is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import NOT_SPACE, cut, mix, passing, pieces, runs_of_words, tidy, words_of

#: Cells of the frequency table (2**24, 16 MB, broadcast), and of a part of it.
TABLE_BITS, PART_CELLS = 24, 1 << 16
#: Bits of a set's parities inside the joins, a multiple of 64.
SKETCH = 128
#: Least and most bits of the parities by which a candidate pair is compared, powers of two.
LEAST_FINE, MOST_FINE = 64, 1 << 15
_PARITY = [f"s{k}" for k in range(SKETCH // 64)]
#: Rounds of hub joins before the remaining pairs are made.
HUBS = 2
#: Bits of the bitmap (8 MB, broadcast) of documents whose whole sets are wanted.
BITMAP_BITS = 26
#: Rows of a list whose pairs are made directly, a few for each row; longer lists go by differences.
SHORT = 16
#: Rows of a list in one block: a longer list is dealt over several, joined block with block.
BLOCK = 512


def _cell(shingle: np.ndarray) -> np.ndarray:
    """Cell of the frequency table of each shingle."""
    return (shingle >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def shingle_sets(piece: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash) of each distinct shingle, sorted, and the bounds of each document (rows + 1).
    A text with fewer than ``n`` words has one shingle, all its words."""
    words = words_of(piece.column("text"), NOT_SPACE, lower=True)
    hashes = words.hashes()
    found, whole = runs_of_words(hashes, words.doc, n)
    doc, shingle = words.doc[:len(found)][whole], found[whole]
    count = np.diff(words.first)
    for d in np.flatnonzero((count > 0) & (count < n)):
        part = hashes[words.first[d]:words.first[d + 1]]
        doc = np.append(doc, d)
        shingle = np.append(shingle, runs_of_words(part, np.zeros(len(part), np.int64), len(part), seed=1)[0])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    doc, shingle = doc[fresh], shingle[fresh]
    return doc, shingle, np.searchsorted(doc, np.arange(piece.num_rows + 1))


def _set_key(shingle: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits of each set."""
    out = []
    for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        with np.errstate(over="ignore"):
            part = (shingle ^ np.uint64(k)) * np.uint64(k | 1)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part ^ (part >> np.uint64(31)))])
        out.append(total[bounds[1:]] - total[bounds[:-1]])
    return [row.tobytes() for row in np.stack(out, axis=1)]


_FIRST = "doc_id long, n_shingles long, key binary, part long, counts binary"


def first_pass(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, key) of every document, and the frequency table of
    all shingles in 2**TABLE_BITS hashed cells, one byte each, from one scan.

    Each task adds its own compressed counts, which are summed part by part. A
    task counts a cell up to 255 and the table holds logarithms: it only has to
    be one order for all documents, rare shingles first.
    """
    def run(batches):
        seen = np.zeros(1 << TABLE_BITS, np.uint8)
        for piece in pieces(batches):
            _, shingle, bounds = shingle_sets(piece, n)
            cell, times = np.unique(_cell(shingle), return_counts=True)
            seen[cell] = np.minimum(seen[cell] + times, 255)
            none = pa.nulls(piece.num_rows)
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(np.diff(bounds)), pa.array(_set_key(shingle, bounds), pa.binary()),
                none.cast(pa.int64()), none.cast(pa.binary())], ["doc_id", "n_shingles", "key", "part", "counts"])
        parts = seen.reshape(-1, PART_CELLS)
        at = np.flatnonzero(parts.any(axis=1))
        none = pa.nulls(len(at))
        yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(at),
                                          pa.array([zlib.compress(parts[k].tobytes(), 1) for k in at], pa.binary())],
                                         ["doc_id", "n_shingles", "key", "part", "counts"])
    both = cut(docs.mapInArrow(run, _FIRST))

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                total.setdefault(part, np.zeros(PART_CELLS, np.int64))
                total[part] += np.frombuffer(zlib.decompress(counts), np.uint8)
        codes = [np.minimum(8 * np.log2(1 + x), 255).astype(np.uint8).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(codes, pa.binary())], ["part", "codes"])
    table = np.zeros((1 << TABLE_BITS) // PART_CELLS * PART_CELLS, np.uint8).reshape(-1, PART_CELLS)
    with tidy(docs.sparkSession):
        counted = both.where("part is not null").select("part", "counts").repartition("part").mapInArrow(add, "part long, codes binary")
        for row in counted.collect():  # 2**TABLE_BITS bytes, whatever the input
            table[row["part"]] = np.frombuffer(row["codes"], np.uint8)
    return both.where("part is null").select("doc_id", "n_shingles", "key"), table.reshape(-1)


def _prefix_length(n: np.ndarray, low: int) -> np.ndarray:
    """Shingles of a set of n that any partner shares one of: n less the least overlap, and one."""
    return n - -(-low * n // 100) + 1


def _fine_parities(doc: np.ndarray, shingle: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For each document a bit a cell, set where an odd number of its shingles lies; the cells are the
    power of two from the set's size on, so a bit or two a shingle, within LEAST_FINE and MOST_FINE."""
    bits = np.int64(1) << np.ceil(np.log2(np.clip(size, LEAST_FINE, MOST_FINE))).astype(np.int64)
    first = np.cumsum(bits) - bits
    cell = (shingle >> np.uint64(8)).astype(np.int64) & (bits - 1)[doc]
    odd = np.packbits((np.bincount(first[doc] + cell, minlength=int(bits.sum())) & 1).astype(bool)).tobytes()
    return [odd[a:a + n] for a, n in zip((first >> 3).tolist(), (bits >> 3).tolist())]


def _differing(a: bytes, b: bytes) -> int:
    """In how many cells the parities differ; the longer ones are folded to the cells of the shorter."""
    least = min(len(a), len(b))
    out = 0
    for part in (a, b):
        for k in range(0, len(part), least):
            out ^= int.from_bytes(part[k:k + least])
    return out.bit_count()


def prefixes(docs: DataFrame, table: np.ndarray, n: int, low: int) -> DataFrame:
    """(class, n, fine, common, prefix, parities): each document's rarest shingles in order,
    its fine parities, how frequent its shingles are on average, and in which of SKETCH
    cells an odd number of them lies."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for piece in pieces(batches):
            doc, shingle, bounds = shingle_sets(piece, n)
            size = np.diff(bounds)
            often = sent.value[_cell(shingle)]
            order = np.lexsort((shingle, often, doc))
            place = np.arange(len(doc)) - bounds[doc]
            kept = place < _prefix_length(size, low)[doc]
            fine = _fine_parities(doc, shingle, size)
            prefix = shingle[order][kept].astype(np.int64)
            common = np.bincount(doc, often, piece.num_rows) / np.maximum(size, 1)
            bounds = np.searchsorted(doc[kept], np.arange(piece.num_rows + 1))
            odd = np.bincount(doc * SKETCH + (shingle >> np.uint64(8) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH * piece.num_rows) & 1
            parity = np.packbits(odd.astype(bool)).view(np.int64).reshape(-1, SKETCH // 64)
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(size), pa.array(fine, pa.binary()), pa.array(common),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(prefix)), *map(pa.array, parity.T)],
                ["class", "n", "fine", "common", "prefix", *_PARITY])
    return docs.mapInArrow(run, "class long, n long, fine binary, common double, prefix array<long>, " + ", ".join(f"{k} long" for k in _PARITY))


def _apart(a: str, b: str, low: int) -> tuple[Column, Column]:
    """The most shingles in which two linked rows differ, and the least in which these do."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.{k}").bitwiseXOR(F.col(f"{b}.{k}"))) for k in _PARITY), F.lit(0))
    return n - 2 * F.ceil(F.lit(low) * n / F.lit(100 + low)), differ


def _near(a: str, b: str, low: int) -> Column:
    """Length, positional and parity filters on two rows that share the shingle at places ``place`` of their orders."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    least = F.ceil(F.lit(low) * (na + nb) / F.lit(100 + low))
    most = F.least(F.col(f"{a}.place"), F.col(f"{b}.place")) + F.least(na - F.col(f"{a}.place"), nb - F.col(f"{b}.place"))
    apart, differ = _apart(a, b, low)
    return (F.lit(100) * F.least(na, nb) >= F.lit(low) * F.greatest(na, nb)) & (most >= least) & (differ <= apart)


def _between(placed: DataFrame, key: list[str]) -> DataFrame:
    """Rows x, y of the same list, x.class < y.class, in different components, each
    pair once. A list of many rows is dealt over blocks, and each block of x meets
    each block of y in a group of its own, so that no task holds a whole list."""
    dealt = placed.withColumn("blocks", F.ceil(F.col("times") / F.lit(BLOCK)).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("class", *key), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    x = dealt.withColumn("from", F.col("own")).withColumn("to", other).drop("own", "blocks", "times")
    y = dealt.withColumn("to", F.col("own")).withColumn("from", other).drop("own", "blocks", "times")
    return x.alias("x").join(y.alias("y"), [*key, "from", "to"]).where("x.class < y.class and x.component <> y.component")


def _families(placed: DataFrame) -> DataFrame:
    """(hub, class, n, component, parities): one hub for all rows of a list, the class of the
    most frequent shingles in it or, where that one has a better hub in another
    of its lists, the better one, so that a group has few hubs."""
    rank = F.struct(F.col("common"), F.col("class").alias("hub"))
    hubs = placed.groupBy("shingle").agg(F.max(rank).alias("best"))
    top = placed.join(hubs, "shingle").groupBy("class").agg(F.max("best").alias("top"))
    named = hubs.select("shingle", F.col("best.hub").alias("class")).join(top, "class").select("shingle", F.col("top.hub").alias("hub"))
    return placed.join(named, "shingle").select("hub", "class", "n", "component", *_PARITY).distinct()


def _by_differences(placed: DataFrame, docs: DataFrame, n: int, low: int) -> DataFrame:
    """Candidate pairs (a, b) between components of the lists in ``placed``.

    D is a row's symmetric difference from its hub. A linked partner differs from x
    by at most ``most`` = (100 - low) * n / low shingles, so all but ``most`` of D
    are shared and the first most + 1 of D meet a partner's. If nothing needs to be
    shared, both rows are linked with the hub. That link is a candidate as well.
    """
    family = cut(_families(placed))
    ids = family.select("class").union(family.select("hub")).distinct()
    with passing(docs.sparkSession):
        sets = cut(whole_sets(docs, ids, n))
        both = family.join(sets, "class").join(sets.select(F.col("class").alias("hub"), F.col("shingles").alias("other")), "hub")
        differ = cut(both.select("hub", "class", "n", "component", *_PARITY, F.concat(
            F.array_except("shingles", "other"), F.array_except("other", "shingles")).alias("d")), keep=True)
    most = F.floor(F.lit(100 - low) * F.col("n") / F.lit(low))
    rows = differ.select("hub", "class", "component", F.explode("d").alias("shingle"))  # the rest of a row follows once lists of one row are gone
    times = rows.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("times"), F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(times.where("times > 1"), ["hub", "shingle"]).join(
        differ.select("hub", "class", "n", *_PARITY, F.size("d").alias("d")), ["hub", "class"])
    own = Window.partitionBy("hub", "class")
    ordered = own.orderBy("times", "shingle")
    rows = rows.withColumn("place", F.col("d") - F.count(F.lit(1)).over(own) + F.row_number().over(ordered) - 1)
    # a list within one component has no candidates, but its place in the order counts
    rows = cut(rows.where((F.col("place") <= most) & (F.col("low") != F.col("high"))).drop("low", "high"))
    nx, ny, dx, dy, px, py = (F.col(f"{r}.{c}") for c in ("n", "d", "place") for r in "xy")
    apart, differing = _apart("x", "y", low)
    shared = F.least(px, py) + F.least(dx - px, dy - py)
    near = (F.lit(100) * F.least(nx, ny) >= F.lit(low) * F.greatest(nx, ny)) & (2 * shared >= dx + dy - apart) & (differing <= apart)
    found = _between(rows, ["hub", "shingle"]).where(near).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
    to_hub = family.where("class <> hub").select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
    return found.union(to_hub)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the (a, b) edges.

    Each round points every node at its smallest neighbour, follows pointers
    three times, and contracts the edges to what still crosses; the rounds are
    cut by written tables.
    """
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    state = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a")).toDF("node", "near")
        points = ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("to"))
        for _ in range(3):
            ahead = points.select(F.col("node").alias("to"), F.col("to").alias("far"))
            points = points.join(ahead, "to").select("node", F.col("far").alias("to"))
        points = cut(points)
        left, right = (points.select(F.col("node").alias(k), F.col("to").alias(f"c{k}")) for k in "ab")
        moved = edges.join(left, "a").join(right, "b").where("ca <> cb")
        edges = cut(moved.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
        state = state.join(points.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return state


def _bit(ids: np.ndarray) -> np.ndarray:
    """Place of each id in the bitmap."""
    return (mix(ids.astype(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _bitmap(ids: DataFrame):
    """Broadcast bitmap (2**BITMAP_BITS bits, whatever their number) of the one column of ``ids``; as
    they grow it lets more others through, so what it leaves is joined exactly."""
    part_bits, column = 1 << 16, ids.columns[0]

    def mark(batches):
        seen = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
        for batch in batches:
            at = _bit(np.asarray(batch.column(column)))
            np.bitwise_or.at(seen, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        parts = seen.reshape(-1, part_bits // 8)
        at = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([zlib.compress(parts[k].tobytes(), 1) for k in at], pa.binary())], ["part", "bits"])

    def either(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, bits in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist()):
                parts.setdefault(part, np.zeros(part_bits // 8, np.uint8))
                parts[part] |= np.frombuffer(zlib.decompress(bits), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], ["part", "bits"])
    form = "part long, bits binary"
    bits = np.zeros(((1 << BITMAP_BITS) // part_bits, part_bits // 8), np.uint8)
    with tidy(ids.sparkSession):
        for row in ids.mapInArrow(mark, form).repartition("part").mapInArrow(either, form).collect():  # 2**BITMAP_BITS bits at most
            bits[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(bits.reshape(-1))


def _marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the bitmap."""
    at = _bit(ids)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _screened(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id may be among ``ids`` (class)."""
    sent = _bitmap(ids)

    def screen(batches):
        for batch in batches:
            yield batch.filter(pa.array(_marked(sent.value, np.asarray(batch.column("doc_id")))))
    return docs.select("doc_id", "text").mapInArrow(screen, "doc_id long, text string")


def shared_postings(facts: DataFrame) -> DataFrame:
    """(class, n, common, parities, place, shingle) of the prefix shingles that several classes hold.
    Only bare shingles are shuffled to be counted; a bitmap of the shared ones screens the
    postings before the exact join."""
    every = facts.select(F.explode("prefix").alias("shingle"))
    shared = cut(every.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("shingle"))
    sent = _bitmap(shared)
    names = ["class", "n", "common", *_PARITY, "place", "shingle"]

    def spread(batches):
        for batch in batches:
            prefix = batch.column("prefix")
            owner = np.asarray(pc.list_parent_indices(prefix), dtype=np.int64)
            shingle = np.asarray(pc.list_flatten(prefix), dtype=np.int64)
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            kept = np.flatnonzero(_marked(sent.value, shingle))
            rows = batch.select(names[:-2]).take(pa.array(owner[kept]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(place[kept].astype(np.int32)), pa.array(shingle[kept])], names)
    form = f"class long, n long, common double, {', '.join(f'{k} long' for k in _PARITY)}, place int, shingle long"
    return facts.select(*names[:-2], "prefix").mapInArrow(spread, form).join(shared, "shingle")


def whole_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(class, shingles) of the documents named by ``ids`` (class). A bitmap of the
    ids (2**BITMAP_BITS bits, whatever their number) screens the scan, so that
    texts which nobody asks for are not shuffled; the join is exact."""
    texts = _screened(docs, ids).join(ids.withColumnRenamed("class", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    def whole(batches):
        for piece in pieces(batches):
            _, shingle, bounds = shingle_sets(piece, n)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(shingle.astype(np.int64)))], ["class", "shingles"])
    return texts.mapInArrow(whole, "class long, shingles array<long>")


def _verified(pairs: DataFrame, facts: DataFrame, docs: DataFrame, n: int, low: int) -> DataFrame:
    """The (a, b) pairs whose sets reach the threshold: first those whose fine parities differ
    in no more cells than linked sets do, then by the whole sets of the documents that are left."""
    use = facts.select("class", "n", "fine")
    bounded = (pairs.join(use.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa")), "a")
               .join(use.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb")), "b"))

    def suffix(batches):
        for batch in batches:
            both = np.asarray(batch.column("na")) + np.asarray(batch.column("nb"))
            apart = both - 2 * -(-low * both // (100 + low))
            differing = np.array([_differing(a, b) for a, b in zip(batch.column("fa").to_pylist(), batch.column("fb").to_pylist())], np.int64)
            yield batch.filter(pa.array(differing <= apart)).select(["a", "b", "na", "nb"])
    left = cut(bounded.mapInArrow(suffix, "a long, b long, na long, nb long"))
    ids = left.select(F.col("a").alias("class")).union(left.select("b")).distinct()
    sets = cut(whole_sets(docs, ids, n))
    whole = left.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return whole.where(F.lit(100) * common >= F.lit(low) * (F.col("na") + F.col("nb") - common)).select("a", "b")


def _round(postings: DataFrame, component: DataFrame, facts: DataFrame, docs: DataFrame, n: int, low: int, order: int) -> DataFrame:
    """(class, component) after joining each class with its lists' hubs, or, in the round
    after HUBS, after all pairs between components that are still possible."""
    spark = docs.sparkSession
    with passing(spark):
        placed = postings.join(component, "class")
        mixed = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                              F.count(F.lit(1)).alias("times")).where("low <> high")
        placed = placed.join(mixed.select("shingle", "times"), "shingle")
        if order < HUBS:  # the list's hub: the class of the most frequent shingles, then any other
            first = F.xxhash64("class", F.lit(order)) if order else -F.col("common")
            carried = ["class", "n", "place", "component", *_PARITY]
            hubs = placed.groupBy("shingle").agg(F.min(F.struct(first.alias("rank"), *carried)).alias("hub"))
            both = placed.alias("x").join(hubs.select("shingle", "hub.*").alias("y"), "shingle").where("x.component <> y.component")
        else:
            placed = cut(placed)
            both = _between(placed.where(F.col("times") <= SHORT), ["shingle"])
        found = both.where(_near("x", "y", low)).select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"))
        if order == HUBS:
            found = found.union(_by_differences(placed.where(F.col("times") > SHORT), docs, n, low))
        pairs = cut(found.distinct(), keep=True)
    with passing(spark):
        links = cut(_verified(pairs, facts, docs, n, low), keep=True)
    of = component.select(F.col("class").alias("a"), F.col("component").alias("ca"))
    to = component.select(F.col("class").alias("b"), F.col("component").alias("cb"))
    roots = connected(links.join(of, "a").join(to, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    return component.join(roots.withColumnRenamed("node", "component"), "component", "left").select("class", F.coalesce("root", "component").alias("component"))


def jaccard_components(docs: DataFrame, n: int = 4, low: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) for every row of ``docs``:
    documents whose sets have 100 * intersection >= ``low`` * union are linked,
    ``component_id`` is the smallest doc_id reachable, ``class_id`` that of the
    documents with the same set.

    Null, empty and blank texts have no shingles and are linked with nothing; a row
    with a null doc_id gives its n_shingles, a null component and class, and links with
    nothing; rows that repeat a doc_id with the same text stay
    rows of one document; an empty table gives none; further columns are not read.
    """
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text")

    spark = docs.sparkSession
    with passing(spark):
        sized, table = first_pass(docs, n)
        classes = sized.where("n_shingles > 0 and doc_id is not null").groupBy("key", "n_shingles").agg(F.min("doc_id").alias("class"))
        same = cut(sized.join(classes, ["key", "n_shingles"], "left").select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("class")), keep=True)
    docs = docs.where("doc_id is not null")

    with passing(spark):  # all that the rounds write; the last components stay
        heads = same.where("n_shingles > 0 and doc_id = class").select("class")
        with passing(spark):
            every = cut(prefixes(docs, table, n, low).where("n > 0").join(heads, "class", "left_semi").dropDuplicates(["class"]))
            facts = cut(every.select("class", "n", "fine"), keep=True)
            postings = cut(shared_postings(every), keep=True)
        component = postings.select("class").distinct().withColumn("component", F.col("class"))
        for order in range(HUBS + 1):
            with passing(spark):
                component = cut(_round(postings, component, facts, docs, n, low, order), keep=True)
        component = cut(component, keep=True)
    return same.join(component, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class").alias("component_id"), F.col("class").alias("class_id"))
