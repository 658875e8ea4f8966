"""Operator 3 against a dictionary of all windows."""

import hashlib
import random
import re

from sackcast.llm import substring_dedup


def _brute(rows, size=20):
    docs = sorted((i is None, i or 0, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows)
    earliest = {}
    for none, i, words in docs:
        for k in range(len(words) - size + 1):
            earliest.setdefault(tuple(words[k:k + size]), (none, i, k))
    out = []
    for none, i, words in docs:
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            if earliest[tuple(words[k:k + size])] < (none, i, k):
                gone[k:k + size] = [True] * size
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((None if none else i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def _got(docs):
    return sorted((tuple(r) for r in substring_dedup.dedup_substrings(docs).drop("kept").collect()), key=str)


def test_documents(documents):
    assert _got(documents) == _brute([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(spark, odd_docs):
    assert _got(odd_docs) == _brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert _got(odd_docs.limit(0)) == []


def test_overlaps_and_shifts(spark):
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(45)]
    rows = []
    for i in range(60):
        fill = [f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(60))]
        a = rng.randrange(25)
        rows.append((i * 7, " ".join(fill + passage[a:a + rng.randrange(18, 30)] + fill[:rng.randrange(len(fill) + 1)])))
    rows += [(900, "la " * 100), (901, "la " * 19), (902, "la " * 20), (None, " ".join(passage)), (903, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(docs) == _brute(rows)


def test_words_built_to_share_a_polynomial_hash(spark):
    order = "a"
    for _ in range(10):  # Thue-Morse order of 1,024 letters and its complement
        order += order.translate(str.maketrans("ab", "ba"))
    other = order.translate(str.maketrans("ab", "ba"))
    rest = " " + " ".join(f"w{k}" for k in range(20))
    rows = [(1, order + rest), (2, other + rest), (3, (order + " ") * 21), (4, (other + " ") * 21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(docs) == _brute(rows)
