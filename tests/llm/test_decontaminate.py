"""Operator 10 against an alignment of every pair, and edited copies."""

import re

from sackcast.llm import decontaminate as dec


def _words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_every_item_that_shares_a_passage_is_found(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = {r["item_id"]: _words(r["text"]) for r in benchmark.collect()}
    want = set()
    for r in documents.collect():
        text = " " + " ".join(_words(r["text"])) + " "
        want |= {(r["doc_id"], i) for i, w in items.items() if " " + " ".join(w) + " " in text}
    got = dec.contaminated(documents, benchmark).collect()
    assert want <= {(r["doc_id"], r["item_id"]) for r in got}
    assert all((r["doc_id"], r["item_id"]) in want or r["score"] < 1 for r in got)
    assert len(got) <= len(want) + 2


def test_edited_copies_and_odd_rows(spark, odd_docs):
    item = [f"w{k}" for k in range(40)]
    edited = [w if k % 7 else "other" for k, w in enumerate(item)]
    dropped = [w for k, w in enumerate(item) if k % 9]
    pad = ["filler"] * 300
    docs = spark.createDataFrame([(1, " ".join(pad + edited + pad)), (2, " ".join(pad + dropped)), (3, " ".join(item[:12] + pad)), (4, " ".join(pad)), (5, None),
                                  (1, " ".join(pad + edited + pad)), (None, " ".join(item))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(0, " ".join(item), "x"), (1, None, "x"), (2, "", None), (None, "filler filler filler filler", "y"), (7, "two words", "z")], "item_id long, text string, words string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dec.contaminated(docs, benchmark).collect()}
    assert set(got) == {(1, 0), (2, 0)} and all(0.5 <= s < 1 for s in got.values())
    assert dec.contaminated(docs, benchmark.limit(0)).count() == 0 and dec.contaminated(docs.limit(0), benchmark).count() == 0
    assert dec.contaminated(odd_docs, benchmark).count() == 0


def test_many_edited_copies_beside_a_full_one(spark):
    item = [f"w{k}" for k in range(40)]
    edited = [w if (k + 1) % 6 else "other" for k, w in enumerate(item)]
    pad = ["filler"] * 100
    rows = [(0, " ".join(pad + item + pad))] + [(1 + i, " ".join(pad + edited + pad)) for i in range(30)]
    benchmark = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    for docs in (rows, rows[1:]):
        got = dec.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, 5) for i, _ in docs]


def test_alignment():
    import numpy as np
    a = np.arange(10, dtype=np.uint64)
    assert dec.align(np.concatenate([a + 50, a, a + 90]), a)[0] == 1.0
    assert dec.align(np.delete(a, 4), a)[0] == (2 * 9 - 1) / 20
    assert dec.align(a + 100, a)[0] == 0
