"""Operator 1: exact byte-substring dedup with suffix arrays.

1. Screen. Every window of LENGTH bytes is known by its smallest GRAM-byte hash
   (a minimizer); equal windows have equal minimizers, so only windows whose
   minimizer occurs more than once can be repeated.
2. Shards. The stretch of windows around such a minimizer is a segment; segments
   are dealt to shards by minimizer, so equal windows meet. Equal segments are
   decided as they stand (a pack at a time first); a minimizer with very many
   documents is dealt over several shards by the segment's content.
3. Per shard, a suffix array (Larsson-Sadakane refinement in numpy) and Kasai's
   common prefixes of neighbours: windows whose neighbour shares LENGTH bytes
   are repeated.
4. Shards that share a minimizer are merged: each sends its distinct windows in
   order, and a binary search in the other shards' ordered lists finds the rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .screen import ALONE, ASKED, DECIDED, keyed, neighbours, packs, repeated_anchors
from .shared import BYTE_VALUE, cut, mix, pieces, powers, span_hashes, utf8

#: Bytes of a repeated string, and of the grams whose smallest hash names it.
LENGTH, GRAM = 200, 32
SPAN = LENGTH - GRAM + 1
#: Documents of a minimizer that one shard takes; segments of a shard, on average; windows of a merge task.
HOT, SHARD_SEGMENTS, MERGE = 2048, 4000, 500_000


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` over each run of ``size`` values, by doubling."""
    out, have = values, 1
    while have * 2 <= size:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[:len(out) - (size - have)], out[size - have:]) if size > have else out


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:len(data)], out=total[1:])
    return mix((total[GRAM:] - total[:-GRAM]) * down[:len(data) - GRAM + 1])


def minimizer_runs(data: np.ndarray, offsets: np.ndarray, grams: np.ndarray | None = None):
    """(document, first start, last start + 1, minimizer) of the maximal runs of
    windows with one minimizer, for each document; starts count in ``data``."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = _sliding(_gram_hashes(data) if grams is None else grams, SPAN, np.minimum)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = doc[:n] == doc[LENGTH - 1:]
    fresh = inside.copy()
    fresh[1:] &= (least[1:] != least[:-1]) | ~inside[:-1] | (doc[1:n] != doc[:n - 1])
    first = np.flatnonzero(fresh)
    stop = inside.copy()
    stop[:-1] &= fresh[1:] | ~inside[1:]
    return doc[first], first, np.flatnonzero(stop) + 1, least[first]


def _doc_anchors(piece):
    """An occurrence of its minimizer for each run, and one more where the gram stands twice within a window's reach."""
    data, offsets = utf8(piece.column("text"))
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _gram_hashes(data)
    doc, first, last, least = minimizer_runs(data, offsets, grams)
    reach = np.zeros(len(data) - LENGTH + 1 + 2 * (SPAN - 1), np.uint64)
    reach[SPAN - 1:len(reach) - SPAN + 1] = _sliding(grams, SPAN, np.minimum)
    at = np.flatnonzero(_sliding(reach, SPAN, np.maximum) == grams)  # grams that name some window around them
    value = grams[at]
    order = np.lexsort((at, value))
    at, value = at[order], value[order]
    again = at[1:][(value[1:] == value[:-1]) & (at[1:] - at[:-1] <= SPAN)]  # windows SPAN apart still adjoin: one run
    owner = np.searchsorted(offsets, again, "right") - 1
    return np.concatenate([doc, owner]), np.concatenate([least, grams[again]])


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text``: first by 8 bytes, then Larsson-Sadakane rounds that
    double the length and sort only the groups that are still tied."""
    n = len(text)
    wide = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | wide[k:k + n].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    step = 8
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        at = np.flatnonzero(tied)  # places of the order that belong to groups of two and more
        if not len(at):
            return order
        who = order[at]
        ahead = who + step
        group, next_ = rank[who], np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        sort = np.lexsort((next_, group))
        who, group, next_ = who[sort], group[sort], next_[sort]
        order[at] = who
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (next_[1:] != next_[:-1])
        fresh[at] = new
        rank[who] = np.maximum.accumulate(np.where(new, at, 0))
        step *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, block_end: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Kasai: common prefix (at most about ``most`` bytes) of each suffix of ``order`` with the one before it.

    A suffix d places further shares at least d bytes less with its own
    predecessor, as long as the predecessor's block of suffixes reaches so far
    (``block_end``); places are taken in halving strides, so that most start
    from such a bound.
    """
    wide = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(wide, 8)
    before = np.full(len(text) + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    prefix = np.zeros(len(text) + 1, np.int64)
    stride = 64
    todo = [np.arange(0, len(text), stride)]
    while stride > 1:
        stride //= 2
        todo.append(np.arange(stride, len(text), 2 * stride))
    for level, at in enumerate(todo):
        at = at[before[at] >= 0]
        if level:
            d = 64 >> level
            left = at - d
            bound = np.maximum(prefix[left] - d, 0)
            held = (before[left] >= 0) & (before[left] + d < block_end[np.maximum(before[left], 0)]) & (left >= 0)
            prefix[at] = np.where(held, bound, 0)
        open_ = at[prefix[at] < most]
        while len(open_):
            have = prefix[open_]
            a = np.ascontiguousarray(words[open_ + have]).view("<u8").ravel()
            b = np.ascontiguousarray(words[before[open_] + have]).view("<u8").ravel()
            differ = a ^ b
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)) // 8).astype(np.int64))
            prefix[open_] = have + same
            open_ = open_[(same == 8) & (have + 8 < most)]
    return prefix[order]


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, class) of all windows of a shard's distinct segments; windows of a class are equal."""
    text = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(segments)), sizes)
    last = (ends - length + 1)[owner]
    order = suffix_order(text)
    order = order[order < last[order]]  # starts whose window lies in the segment
    prefix = common_prefixes(text, order, last, length)
    fresh = prefix < length
    fresh[:1] = True
    return owner[order], order - (ends - sizes)[owner[order]], np.cumsum(fresh) - 1


def _window_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each of many overlapping windows of LENGTH bytes, a few operations each."""
    up, down = powers(len(data) + 1)
    out = []
    for value in (BYTE_VALUE, mix(BYTE_VALUE)):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * up[:len(data)], out=total[1:])
        out.append(mix((total[end] - total[start]) * down[start] ^ mix((end - start).astype(np.uint64))))
    return out[0], out[1]


_NAMES = ["shard", "sub", "at", "version", "first", "size", "key", "bytes", "kind", "shards", "gram"]
_SEGMENTS = "shard long, sub long, at long, version long, first long, size long, key binary, bytes binary, kind int, shards long, gram long"


def _segments(shards: int):
    """Rows of a pack's segments: equal ones are decided here, each distinct one goes to its shard once."""
    def run(batches):
        for pack in packs(batches):
            parts: list[pa.RecordBatch] = []
            for piece in pack:
                data, offsets = utf8(piece.column("text"))
                doc, first, last, least = minimizer_runs(data, offsets)
                flags = piece.column("anchors")
                owner = np.asarray(pc.list_parent_indices(flags), dtype=np.int64)
                flat = pc.list_flatten(flags)
                known = np.asarray(flat.field("anchor"), dtype=np.int64).view(np.uint64)
                split = np.asarray(flat.field("split"), dtype=np.int64)
                name = lambda d, h: mix(h ^ mix(d.astype(np.uint64) + np.uint64(1)))
                flag = name(owner, known)
                sort = np.argsort(flag)
                asked = name(doc, least)
                slot = np.minimum(np.searchsorted(flag[sort], asked), max(len(flag) - 1, 0))
                hit = np.flatnonzero(flag[sort][slot] == asked) if len(flag) else np.zeros(0, np.int64)
                doc, first, last, least, ways = doc[hit], first[hit], last[hit], least[hit], split[sort][slot[hit]] if len(hit) else split[:0]
                end = last - 1 + LENGTH
                a, b = (span_hashes(data, first, end, seed) for seed in (0, 1))
                sub = np.where(ways > 1, (a % np.maximum(ways, 1).astype(np.uint64)).astype(np.int64), -1)
                shard = np.where(ways > 1, least.astype(np.int64), (least % np.uint64(shards)).astype(np.int64))
                raw = data.tobytes()
                parts.append(pa.RecordBatch.from_arrays([
                    pa.array(shard), pa.array(sub), pa.array(np.asarray(piece.column("at"))[doc]), pa.array(np.asarray(piece.column("version"))[doc]),
                    pa.array(first - offsets[doc]), pa.array(end - first), pa.array([x.tobytes() for x in np.stack([a, b], axis=1)], pa.binary()),
                    pa.array([raw[s:e] for s, e in zip(first.tolist(), end.tolist())], pa.binary()),
                    pa.array(np.zeros(len(doc), np.int32)), pa.array(ways), pa.array(least.astype(np.int64))], _NAMES))
            rows = pa.Table.from_batches(parts).combine_chunks()
            if not rows.num_rows:
                continue
            key = np.frombuffer(b"".join(rows.column("key").to_pylist()), np.uint64).reshape(-1, 2)
            order = np.lexsort((key[:, 1], key[:, 0]))
            code = np.cumsum(np.append(True, (key[order][1:] != key[order][:-1]).any(axis=1)))
            fresh, more = neighbours(code)
            for take, kind in ((order[fresh], np.where(more[fresh], ASKED, ALONE)), (order[more], np.full(int(more.sum()), DECIDED))):
                part = rows.take(pa.array(take))
                part = part.set_column(8, "kind", pa.array(kind, pa.int32()))
                if len(kind) and kind[0] == DECIDED:  # nothing to compare: to its document's place
                    part = part.set_column(7, "bytes", pa.array([b""] * len(kind), pa.binary())).set_column(
                        0, "shard", pa.array(-1 - np.asarray(part.column("at")) % shards))
                yield from part.to_batches()
    return run


_FOUND = "at long, version long, first long, size long, a long, b long, kind int"


def _stretches(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, size) of the maximal runs of neighbouring windows."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(owner))[:len(at)] - 1
    return owner[at], start[at], start[last] - start[at] + LENGTH


def _shard(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeated stretches of a shard, and for shards that share a minimizer their distinct windows in order."""
    out = []

    def add(rows: pd.DataFrame, first, size, a=0, b=0, kind=DECIDED) -> None:
        out.append(pd.DataFrame({"at": rows["at"], "version": rows["version"], "first": first, "size": size, "a": a, "b": b, "kind": kind}))

    done = frame[frame["kind"] == DECIDED]
    add(done, done["first"], done["size"])
    frame = frame[frame["kind"] != DECIDED].sort_values(["key", "kind", "at", "version", "first"], kind="stable").reset_index(drop=True)
    if len(frame):
        twice = frame["key"].duplicated(keep=False)
        equal = frame[twice & (frame["kind"] == ALONE)]
        add(equal, equal["first"], equal["size"])
        whole = (twice | (frame["kind"] == ASKED)).groupby(frame["key"]).transform("any")
        heads = frame[~frame["key"].duplicated()]
        settled = whole[heads.index].to_numpy()
        heads = heads.reset_index(drop=True)
        crowded = int(heads["shards"].iloc[0]) > 1
        if not crowded:  # where all segments around a minimizer are settled, nothing is left to find
            open_ = heads["gram"].isin(heads["gram"][~settled]).to_numpy()
            heads, settled = heads[open_].reset_index(drop=True), settled[open_]
        if crowded or not settled.all():
            owner, start, group = repeated_windows(heads["bytes"].tolist())
            more = np.bincount(group)[group] > 1
            take = more & ~settled[owner]
            who, first, size = _stretches(owner[take], start[take])
            rows = heads.iloc[who]
            add(rows, rows["first"].to_numpy() + first, size)
            if crowded:
                lead = np.ones(len(group), bool)
                lead[1:] = group[1:] != group[:-1]
                text = np.frombuffer(b"".join(heads["bytes"]), np.uint8)
                base = np.cumsum(heads["size"].to_numpy()) - heads["size"].to_numpy()
                begin = base[owner[lead]] + start[lead]
                a, b = _window_keys(text, begin, begin + LENGTH)
                rows = heads.iloc[owner[lead]]
                known = np.where((more | settled[owner])[lead], ASKED, ALONE)
                add(rows, rows["first"].to_numpy() + start[lead], LENGTH, a.astype(np.int64), b.astype(np.int64), known)
    return pd.concat(out, ignore_index=True)


_STRETCHES = "at long, version long, first long, size long"


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """What shards decided, and the windows of one range of keys that stand in several shards' ordered lists."""
    decided = frame[frame["kind"] == DECIDED]
    frame = frame[frame["kind"] != DECIDED]
    a, b = frame["a"].to_numpy(), frame["b"].to_numpy()
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    low, high = np.searchsorted(a, a, "left"), np.searchsorted(a, a, "right")
    again = np.zeros(len(a), bool)
    for k in np.flatnonzero(high - low > 1):
        again[k] = (b[low[k]:high[k]] == b[k]).sum() > 1
    found = frame.iloc[order[again]]
    return pd.concat([decided, found[found["kind"] == ALONE]])[["at", "version", "first", "size"]]


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """(at, version, first, size): stretches of bytes of the rows of ``keyed`` docs that are unions of repeated strings."""
    flags = cut(repeated_anchors(docs.where(F.octet_length("text") >= LENGTH), _doc_anchors).distinct())
    often = flags.groupBy("anchor").agg(F.count(F.lit(1)).alias("docs"))
    crowded = cut(often.where(F.col("docs") > HOT).select("anchor", F.ceil(F.col("docs") / HOT).cast("long").alias("split")))
    shards = max(1, flags.count() // SHARD_SEGMENTS)
    ranges = max(1, (crowded.agg(F.sum("split")).first()[0] or 0) * HOT * SPAN // (2 * MERGE))
    named = flags.join(crowded, "anchor", "left").groupBy("at", "version").agg(
        F.collect_list(F.struct("anchor", F.coalesce("split", F.lit(1)).alias("split"))).alias("anchors"))
    rows = docs.join(named, ["at", "version"]).select("doc_id", "at", "version", "text", "anchors")
    found = rows.mapInArrow(_segments(shards), _SEGMENTS).groupBy("shard", "sub").applyInPandas(_shard, _FOUND)
    part = F.when(F.col("kind") == DECIDED, F.pmod(F.xxhash64("at", "version"), F.lit(shards))).otherwise(-1 - F.pmod(F.shiftright("a", 20), F.lit(ranges)))
    return found.withColumn("part", part).groupBy("part").applyInPandas(_merge, _STRETCHES)


def _emit(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for piece in pieces(batches):
        data, offsets = utf8(piece.column("text"))
        cuts = piece.column("cuts")
        owner = np.asarray(pc.list_parent_indices(cuts), dtype=np.int64)
        flat = pc.list_flatten(cuts)
        first = np.asarray(flat.field("first"), dtype=np.int64) + offsets[owner]
        step = np.zeros(len(data) + 1, np.int64)
        np.add.at(step, first, 1)
        np.add.at(step, first + np.asarray(flat.field("size"), dtype=np.int64), -1)
        gone = np.cumsum(step[:-1]) > 0
        rows = []
        for a, b in zip(offsets, offsets[1:]):
            mask = gone[a:b]
            kept = data[a:b][~mask].tobytes()
            spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
            rows.append((int(b - a), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of
    ``docs``: bytes covered by a string of LENGTH bytes that starts anywhere else
    too are removed; ``kept`` holds the remaining bytes.

    Null and empty texts have no bytes; null ids are rows like others; repeated
    rows are documents of their own, so each repeats the other; an empty table
    gives no rows; further columns are not read.
    """
    rows = keyed(docs)
    found = repeated_stretches(rows)
    cuts = found.groupBy("at", "version").agg(F.collect_list(F.struct("first", "size")).alias("cuts"))
    full = rows.join(cuts, ["at", "version"], "left").select("doc_id", "at", "version", "text", F.coalesce("cuts", F.array().cast("array<struct<first:bigint,size:bigint>>")).alias("cuts"))
    return full.mapInArrow(_emit, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
