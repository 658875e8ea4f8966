"""Operator 11: the trie of conversation prefixes.

A turn's id is 128 bits of the SHA-256 of its role and text; a conversation's
path is its ids end to end. Paths are dealt into range shards in (path, conv_id)
order, so a node's members stand together, in one shard or in a run of shards.
In a shard the ids become a padded matrix (pad 0), sorted column block by column
block with numpy's lexsort; the running OR of the columns' changes marks where
nodes start, and reduceat sums every depth over these starts.

Nodes on the path of a shard's first or last conversation may go on in its
neighbours: they leave the shard as partial sums, two paths a shard at most.
Spark adds these up by node, and one small job passes the sums of their subtrees
up. All other nodes are final in their shard but for the parent's name where the
parent is such a boundary node. Only ids, never texts, are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from .shared import cut

#: Columns of the turn-id matrix sorted at once; conversation ids of one row of a boundary node's list.
COLUMNS, LISTED = 8, 1 << 16

_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Nodes, and what boundary nodes need: their key and their parent's, words of the last turn, and parts of the list of ends.
_SHARD = _NODE + ", open boolean, key binary, parent_key binary, words long, ends binary"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, words) of every turn; rows without conv_id are left out."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    # the length of the role keeps (role, text) apart from any other split of the same characters
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.unhex(F.substring(whole, 1, 32)).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's (id, words) by turn, null first, ties by id."""
    return (turn_rows(conversations).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))
            .select("conv_id", F.transform("turns", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("turns")))


def rebuilt(lists: DataFrame, base: Column, kept: Column, most: int) -> DataFrame:
    """Each conversation with its first ``kept`` turns (``most`` at most) replaced by those of conversation ``base``, if any."""
    heads = lists.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head"))
    own = lists.withColumns({"base": base, "kept": kept.cast("int")})
    none = F.slice("turns", 1, 0)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("kept")), none)
    rest = F.slice("turns", F.col("kept") + 1, F.size("turns"))
    return own.join(heads, own.base == heads.head_id, "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _paths(batches) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Conversations of a shard by id: their ids, first turn of each (n + 1), turns (dense numbers from 1 in the order of ids), words."""
    table = pa.Table.from_batches(batches)
    convs = table["conv_id"].to_numpy()
    path, words = (table[x].combine_chunks() for x in ("path", "words"))
    size = np.asarray(pa.compute.binary_length(path), dtype=np.int64) // 16
    halves = np.frombuffer(b"".join(path.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    fresh = np.zeros(len(order), np.int64)
    fresh[1:] = (halves[order][1:] != halves[order][:-1]).any(axis=1)
    turns = np.empty(len(order), np.int64)
    turns[order] = np.cumsum(fresh) + 1
    return convs, np.concatenate([np.zeros(1, np.int64), np.cumsum(size)]), turns, np.asarray(words.flatten(), dtype=np.int64)


class _Level:
    """Nodes of one depth: members, smallest member, parent's place in the level above, words of the last turn, a
    member's place; ids of members that end here, node by node and rising, with each node's bounds."""

    def __init__(self, n, conv, parent, words, member, ends):
        self.n, self.conv, self.parent, self.words, self.member, self.ends = n, conv, parent, words, member, ends


def _levels(convs, first, turns, words) -> list[_Level]:
    """All nodes of a shard, by depth; in a level they stand in path order, so those of one parent are together."""
    size = np.diff(first)

    def ends_of(rows, node, depth, many):
        here = size[rows] == depth
        return convs[rows[here]], np.searchsorted(node[here], np.arange(many + 1))

    rows, node, depth = np.lexsort((convs, size > 0)), np.zeros(len(convs), np.int64), 0
    none = np.zeros(1, np.int64)
    levels = [_Level(np.array([len(rows)]), np.array([convs.min()]), none, none, rows[:1], ends_of(rows, node, 0, 1))]
    while True:
        on = size[rows] > depth
        rows, node = rows[on], node[on]  # in the order of their nodes at this depth
        if not len(rows):
            return levels
        wide = min(COLUMNS, int(size[rows].max()) - depth)
        column = depth + np.arange(wide)
        matrix = np.where(column < size[rows][:, None], turns[np.minimum(first[rows][:, None] + column, len(turns) - 1)], 0)
        order = np.lexsort((convs[rows], *matrix.T[::-1], node))
        rows, node, matrix = rows[order], node[order], matrix[order]
        changed = np.ones(len(rows), bool)
        changed[1:] = node[1:] != node[:-1]
        for j in range(wide):
            changed[1:] |= matrix[1:, j] != matrix[:-1, j]
            live = matrix[:, j] > 0  # padded rows have ended
            starts, inside = np.flatnonzero(changed & live), np.flatnonzero(live)
            place = np.cumsum(changed & live) - 1
            bounds = np.searchsorted(inside, starts)
            member = rows[starts]
            levels.append(_Level(np.diff(np.append(bounds, len(inside))), np.minimum.reduceat(convs[rows[inside]], bounds), node[starts],
                                 words[first[member] + depth], member, ends_of(rows[inside], place[inside], depth + 1, len(starts))))
            node = place  # of rows that go on, their node one deeper
            depth += 1


def _shard(batches):
    """Rows of ``_SHARD`` for the conversations of one shard."""
    batches = [x for x in batches if x.num_rows]
    if not batches:
        return
    paths = pa.Table.from_batches(batches)["path"]
    convs, first, turns, words = _paths(batches)
    levels = _levels(convs, first, turns, words)
    raw = paths.to_pylist()
    both = list(zip(raw, convs.tolist()))
    lead, tail = both.index(min(both)), both.index(max(both))
    # boundary nodes: those of the first and last path; a row's node at a depth is found by its turns
    opened: list[dict[int, bytes]] = []
    for row in (lead, tail):
        whole, digest = raw[row], hashlib.sha256(b"node")
        place = 0
        for depth in range(len(whole) // 16 + 1):
            if depth == len(opened):
                opened.append({})
            if depth:
                digest.update(whole[16 * depth - 16:16 * depth])
                level = levels[depth]
                low, high = np.searchsorted(level.parent, [place, place + 1])
                want = turns[first[row] + depth - 1]
                place = low + int(np.flatnonzero(turns[first[level.member[low:high]] + depth - 1] == want)[0])
            opened[depth][place] = digest.digest()[:16]
    opened += [{}] * (len(levels) - len(opened))

    children = leaves = saved = np.zeros(0, np.int64)
    last_boundary = np.zeros(0, bool)
    out = []
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        many = len(level.n)
        boundary = np.zeros(many, bool)
        boundary[list(opened[depth])] = True
        below = levels[depth + 1] if depth + 1 < len(levels) else None
        own = [np.zeros(many, np.int64) for _ in range(3)]
        if below is not None:
            shut = ~last_boundary
            for total, part in zip(own, (np.ones(len(below.n), np.int64), leaves, saved)):
                np.add.at(total, below.parent[shut], part[shut])
        children, leaves, saved = own
        leaves = np.where(~boundary & (children == 0), 1, leaves)
        saved = np.where(boundary, saved, saved + (level.n - 1) * level.words)
        ends, at = level.ends
        digests = [_EMPTY if a == b or hot else hashlib.sha256(",".join(map(str, ends[a:b].tolist())).encode()).hexdigest()
                   for a, b, hot in zip(at[:-1].tolist(), at[1:].tolist(), boundary.tolist())]
        up = levels[depth - 1] if depth else None
        keys = [opened[depth].get(k) if boundary[k] else None for k in range(many)] if boundary.any() else [None] * many
        above = [opened[depth - 1].get(k) for k in level.parent.tolist()] if depth and opened[depth - 1] else [None] * many
        named = np.array([x is None for x in above]) & (depth > 0)
        out.append(pa.RecordBatch.from_arrays([
            pa.array(level.conv), pa.array(np.full(many, depth, np.int64)),
            pa.array(up.conv[level.parent] if up is not None else np.zeros(many, np.int64), mask=~named),
            pa.array(level.n), pa.array(children), pa.array(leaves), pa.array(saved), pa.array(digests, pa.string()), pa.array(boundary),
            pa.array(keys, pa.binary()), pa.array(above, pa.binary()), pa.array(level.words), pa.nulls(many, pa.binary())], _NAMES))
        for k, key in opened[depth].items():  # the list of a boundary node's ends, in parts
            for low in range(int(at[k]), int(at[k + 1]), LISTED):
                part = ends[low:min(low + LISTED, int(at[k + 1]))]
                none = pa.nulls(1, pa.int64())
                out.append(pa.RecordBatch.from_arrays([
                    pa.array(part[:1]), *[none] * 6, pa.nulls(1, pa.string()), pa.nulls(1, pa.bool_()), pa.array([key], pa.binary()), pa.nulls(1, pa.binary()),
                    none, pa.array([",".join(map(str, part.tolist())).encode()], pa.binary())], _NAMES))
        last_boundary = boundary
    yield from out


_NAMES = [x.split()[0] for x in _SHARD.split(", ")]


def _digests(batches):
    """(key, ends_sha256) of lists given in parts, sorted by (key, first id): read as a stream."""
    key, digest = None, None
    for batch in batches:
        found = []
        for k, part in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    found.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(part)
            else:
                digest.update(b"," + part)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())], ["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "ends_sha256"])


def _sum_up(frame: pd.DataFrame) -> pd.DataFrame:
    """Boundary nodes with the sums of their subtrees (boundary nodes below them included)."""
    frame = frame.sort_values("depth", ascending=False, kind="stable").reset_index(drop=True)
    place = {k: j for j, k in enumerate(frame["key"])}
    up = np.array([-1 if p is None else place[p] for p in frame["parent_key"]], np.int64)
    children, leaves, saved = (frame[x].to_numpy(np.int64).copy() for x in ("n_children", "n_leaves", "saved_tokens"))
    conv = frame["conv_id"].to_numpy(np.int64)
    saved += (frame["n_convs"].to_numpy(np.int64) - 1) * frame["words"].to_numpy(np.int64)
    depth = frame["depth"].to_numpy()
    for d in np.unique(depth)[::-1]:  # deepest first
        at = np.flatnonzero(depth == d)
        leaves[at] = np.where(children[at] == 0, 1, leaves[at])
        if d:
            np.add.at(children, up[at], 1)
            np.add.at(leaves, up[at], leaves[at])
            np.add.at(saved, up[at], saved[at])
    parent = pd.Series(conv[np.maximum(up, 0)], dtype="Int64").where(pd.Series(up >= 0))
    return frame.assign(n_children=children, n_leaves=leaves, saved_tokens=saved, parent_conv_id=parent)[
        ["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row a node of the trie of ``turns`` (conv_id, turns: array of (id, words)), as ``op11``'s contract names them."""
    sent = turns.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x["id"])), "")).alias("path"),
                        F.transform("turns", lambda x: x["words"]).alias("words"))
    many = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(sent.repartitionByRange(many, "path", "conv_id").mapInArrow(_shard, _SHARD))
    nodes = [x.split()[0] for x in _NODE.split(", ")]
    done = parts.where("not open and parent_key is null").select(*nodes)
    partial = (parts.where("open").groupBy("key", "parent_key", "depth")
               .agg(F.min("conv_id").alias("conv_id"), *(F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("words").alias("words")))
    # two paths a shard at most come here: their number follows the shards, not the rows
    summed = partial.withColumn("all", F.lit(True)).groupBy("all").applyInPandas(
        _sum_up, "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    summed = cut(summed)
    ends = (parts.where("ends is not null").select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
            .select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string"))
    boundary = summed.join(ends, "key", "left").select(*nodes[:-1], F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
    under = parts.where("not open and parent_key is not null").drop("parent_conv_id").join(
        summed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key").select(*nodes)
    return done.unionByName(under).unionByName(boundary)


def conversation_trie(conversations: DataFrame, base: Column, kept: Column, most: int) -> DataFrame:
    """The prefix trie of conversations rebuilt from others: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    ``base`` and ``kept`` are columns of conv_id: its first ``kept`` turns, ``most``
    at most, give way to those of conversation ``base`` (none if it is absent).
    Turns are ordered by turn, null first; rows with the same turn by a hash of
    role and text. Repeated rows are turns of their own. Null role and text are
    empty. Rows without conv_id belong to no conversation and are left out; other
    columns are ignored; an empty table gives no node, not even a root. Turns
    whose SHA-256 agree in 128 bits count as equal. A conversation's ids (24
    bytes a turn), never its texts, stand in one task at a time.
    """
    return prefix_trie(rebuilt(turn_lists(conversations), base, kept, most))


def shared_openings(conversations: DataFrame) -> DataFrame:
    """``conversation_trie`` where conversation c opens with h turns of c - c mod 20, h = crc32(decimal c) mod 4."""
    conv = F.col("conv_id")
    return conversation_trie(conversations, conv - F.pmod(conv, F.lit(20)), F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(4)), 3)
