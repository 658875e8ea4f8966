import hashlib
import re
import zlib

from pyspark.sql import functions as F

from sackcast.llm import turn_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, key string"


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    new = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    nodes = {}
    for c, path in new.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = set()
    for path, members in nodes.items():
        under = [(p, m) for p, m in nodes.items() if p[:len(path)] == path]
        kids = lambda p: sum(len(q) == len(p) + 1 and q[:len(p)] == p for q in nodes)
        words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        ends = ",".join(str(c) for c in sorted(members) if len(new[c]) == len(path))
        out.add((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), kids(path), sum(kids(p) == 0 for p, _ in under),
                 sum((len(m) - 1) * words(p) for p, m in under), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ours(spark, rows, shards="8"):
    table = spark.createDataFrame([(*r, 7, "k") for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = [tuple(r) for r in turn_trie.shared_openings(table).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(set(found))
    return set(found)


def test_same_as_brute_force_over_many_shards(spark):
    rows = []
    for c in range(130):
        for t in range(c % 5 + 1):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} kind {(c // 7) % 3 if t else 0} of it"))
    for c in range(200, 260):  # one common conversation
        rows += [(c, t, "user", f"same {t}") for t in range(4)]
    expected = brute(rows)
    assert ours(spark, rows, "1") == expected
    assert ours(spark, rows, "40") == expected


def test_long_conversations_and_column_blocks(spark):
    rows = [(c, t, "user", f"w{t} x") for c in (1, 2, 3, 21) for t in range(30)] + [(4, t, "user", f"w{t} x") for t in range(17)]
    rows += [(5, t, "user", f"w{t} x" if t < 16 else "other") for t in range(20)]
    assert ours(spark, rows, "5") == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (0, None, None, None), (0, 0, "user", ""), (0, 0, "user", ""), (1, 0, "a", "bc"), (2, 0, "ab", "c"),
        (3, 1, "user", "one word \t\n two"), (3, None, "user", "first"), (-7, 0, "user", "minus"), (61, 0, "user", "no such base"), (61, 1, "user", "own"),
        (62, 0, "user", "x"), (63, 0, "user", "x"), (64, 0, "user", "x " * 50000)]
    rows += [(c, 0, "user", "gone") for c in range(100, 120)]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows, "60") == brute(rows)


def test_turnless_and_empty(spark):
    own = [(c, 0, "user", "only") for c in range(301, 320)]  # base 300 is absent: openings go
    expected = brute(own)
    assert any(row[1] == 0 and row[7] != hashlib.sha256(b"").hexdigest() for row in expected)
    assert ours(spark, own) == expected
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_trie.shared_openings(empty).count() == 0


def test_general_form_without_rebuilding(spark):
    rows = [(c, t, "user", f"t{t}") for c in (1, 2) for t in range(3)]
    found = turn_trie.conversation_trie(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA), F.col("conv_id"), F.lit(0), 1)
    assert {(r.depth, r.n_convs) for r in found.collect()} == {(0, 2), (1, 2), (2, 2), (3, 2)}
