"""Operator 4 against all pairs."""

import re
from collections import defaultdict

import numpy as np
import pytest

from sackcast.llm import jaccard_join


def _brute(rows, n=4, low=85):
    sets = {}
    nameless = set()
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        own = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
        if i is None:
            nameless.add((None, len(own), None))
        else:
            sets[i] = own
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    common = defaultdict(int)
    for members in lists.values():
        for k, a in enumerate(members):
            for b in members[k + 1:]:
                common[a, b] += 1
    for (a, b), c in common.items():
        if 100 * c >= low * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {(i, len(s), root(i)) for i, s in sets.items()} | nameless


def _got(docs):
    rows = jaccard_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert len(rows) == docs.count()
    return {tuple(r) for r in rows}


def test_documents(documents):
    assert _got(documents) == _brute([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(odd_docs):
    assert _got(odd_docs) == _brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert _got(odd_docs.limit(0)) == set()


def test_chains_and_large_groups(spark):
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):  # a chain: neighbours are linked, far ones are not
        rows.append((1000 - i, " ".join(base[i // 3:] + [f"x{k}" for k in range(i // 3)])))
    for i in range(120):  # variants of one text
        rows.append((2000 + i, " ".join(f"v{k}" if k != i % 100 else f"y{i}" for k in range(150))))
    for i in range(60):  # a passage in common, no link
        rows.append((3000 + i, " ".join(["shared passage of words"] * 3 + [f"z{i}_{k}" for k in range(30)])))
    rows += [(5000, "a b"), (5001, "A B"), (5002, "a b c"), (5003, "a\tb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(docs) == _brute(rows)


@pytest.mark.parametrize("hubs, short", [(0, 1000), (0, 1), (1, 1)])
def test_last_round(spark, monkeypatch, hubs, short):
    """Blocks of two rows; every pair of a list directly, or by differences from hubs."""
    monkeypatch.setattr(jaccard_join, "HUBS", hubs)
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    rows = []
    for i in range(60):  # near copies with up to three edits each, some of them shared
        words = [f"v{k}" for k in range(100)]
        for e in range(i % 4):
            words[(7 * i + 31 * e) % 100] = f"y{i % 9}_{e}"
        rows.append((i, " ".join(words[:100 - i % 7])))
    rows += [(100 + i, " ".join([f"w{k}" for k in range(i // 2, 80 + i // 2)])) for i in range(30)]  # a chain
    rows += [(200 + i, " ".join(["one passage here"] * 2 + [f"z{i}_{k}" for k in range(20)])) for i in range(25)]
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)


def test_words_built_to_share_a_polynomial_hash(spark):
    order = "a"
    for _ in range(10):  # Thue-Morse order of 1,024 letters and its complement
        order += order.translate(str.maketrans("ab", "ba"))
    other = order.translate(str.maketrans("ab", "ba"))
    tail = " one two three four five six seven eight"
    rows = [(1, order + tail.replace(" ", f" {order} ")), (2, other + tail.replace(" ", f" {other} ")), (3, order), (4, other), (5, order)]
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)
    assert (4, 1, 4) in _brute(rows)


def test_near_misses_are_not_compared_whole(spark, monkeypatch):
    """Sets of every size that share too little are told apart without fetching whole sets; no link is lost."""
    rows = []
    for i, size in enumerate((60, 300, 400, 900, 3000)):
        words = [f"v{i}_{k}" for k in range(size)]
        rows.append((10 * i, " ".join(words)))
        for j, share in enumerate((0.01, 0.08), 1):  # changed words at equal distances: a link, and a similarity of about 0.5
            every = round(1 / share)
            rows.append((10 * i + j, " ".join(f"y{i}_{k}" if k % every == every // 2 else w for k, w in enumerate(words))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fetched = []
    whole_sets = jaccard_join.whole_sets

    def counted(docs, ids, n):
        fetched.extend(r[0] for r in ids.collect())
        return whole_sets(docs, ids, n)
    monkeypatch.setattr(jaccard_join, "whole_sets", counted)
    _, table = jaccard_join.first_pass(docs, 4)
    facts = jaccard_join.cut(jaccard_join.prefixes(docs, table, 4, 85))
    pairs = spark.createDataFrame([(10 * i, 10 * i + j) for i in range(5) for j in (1, 2)], "a long, b long")
    links = {tuple(r) for r in jaccard_join._verified(pairs, facts, docs, 4, 85).collect()}
    roots = {i: root for i, _, root in _brute(rows)}
    assert links == {(a, b) for a, b in ((r["a"], r["b"]) for r in pairs.collect()) if roots[a] == roots[b]} != set()
    assert set(fetched) == {x for pair in links for x in pair}


def test_fine_parities_differ_at_most_where_the_sets_do():
    rng = np.random.default_rng(1)
    for n, m, shared in ((0, 5, 0), (40, 40, 37), (63, 66, 60), (500, 580, 490), (40000, 70000, 39000)):
        pool = np.unique(rng.integers(0, 1 << 64, n + m, dtype=np.uint64))
        sets = [pool[:n], pool[n - shared:n - shared + m]]
        size = np.array([len(x) for x in sets])
        a, b = jaccard_join._fine_parities(np.repeat([0, 1], size), np.concatenate(sets), size)
        assert jaccard_join._differing(a, b) <= len(np.setxor1d(*sets))
        assert jaccard_join._differing(a, a) == 0
