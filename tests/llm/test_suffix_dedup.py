"""Operator 1 against a count of all strings; suffix order and common prefixes against plain ones."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sackcast.llm import suffix_dedup


def _brute(rows, size=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k:k + size] for _, b in texts for k in range(len(b) - size + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - size + 1):
            if count[b[k:k + size]] > 1:
                gone[k:k + size] = [True] * size
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def _got(docs):
    return sorted((tuple(r) for r in suffix_dedup.dedup_bytes(docs).drop("kept").collect()), key=str)


def _made(seed):
    rng = random.Random(seed)
    letters = "abcdefghij é"
    fresh = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage = fresh(900)
    rows = []
    for i in range(80):
        a = rng.randrange(700)
        rows.append((i, fresh(rng.randrange(150)) + passage[a:a + rng.randrange(150, 260)] + fresh(rng.randrange(150))))
    line = fresh(230)
    rows += [(100 + i, fresh(40) + line + fresh(60)) for i in range(60)]
    rows += [(200, "Orre " * 120), (201, "x" * 199), (202, "y" * 200), (203, "y" * 201), (204, None), (205, ""), (206, line), (206, line), (None, passage)]
    return rows


@pytest.mark.parametrize("hot", [2048, 3])
def test_made_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", 40)
    rows = _made(hot)
    assert _got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == _brute(rows)


def test_periods_about_the_span(spark):
    rng = random.Random(5)
    rows = []
    for i, period in enumerate([*range(167, 172)] * 2):
        line = "".join(rng.choice("abcdefghij klmnop") for _ in range(period - 1)) + "\n"
        rows.append((i, line * rng.choice([3, 4])))
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == _brute(rows)


def test_documents(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert _got(docs) == _brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    short = odd_docs.where("doc_id <> 5 or doc_id is null")
    assert _got(short) == _brute([(r["doc_id"], r["text"]) for r in short.collect()])
    assert _got(docs.limit(0)) == []


def test_order_and_common_prefixes():
    rng = np.random.default_rng(3)
    text = np.tile(rng.integers(97, 100, 500, dtype=np.uint8), 3)
    order = suffix_dedup.suffix_order(text)
    raw = text.tobytes()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    got = suffix_dedup.common_prefixes(text, order, np.full(len(text), len(text)), 24)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1]:] + b"\0" * 40, raw[order[k]:] + b"\0" * 40
        want = next(n for n in range(41) if n >= 24 or a[n] != b[n])
        assert min(got[k], 24) == want
