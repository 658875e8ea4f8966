"""Operator 5: targets against plain arithmetic, draws by their invariants."""

import re
from collections import defaultdict

from sackcast.llm import mixing


def _targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order if s not in capped}
        over = {s for s, t in share.items() if t > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        capped |= over


def _check(docs):
    size = {}
    per = defaultdict(int)
    for r in docs.select("doc_id", "text", "source").collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        size[r["doc_id"], r["source"]] = n
        per[r["source"]] += n
    want = _targets(per)
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    taken, biggest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == size[r["doc_id"], r["source"]] and r["source_size"] == per[r["source"]]
        assert abs(r["target"] - want[r["source"]]) <= 1e-6 * (1 + want[r["source"]])
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0) <= (r["taken"] == 0) and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        biggest[r["source"]] = max(biggest[r["source"]], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= biggest[s] + 1e-6
    return sorted((str(r["doc_id"]), r["taken"]) for r in rows)


def test_documents(documents):
    assert _check(documents) == _check(documents.repartition(7))


def test_odd_rows(odd_docs):
    _check(odd_docs)
    assert mixing.mix_sources(odd_docs.limit(0)).count() == 0


def test_hot_source(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(id % 7 + 1 as int)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 40)) as source")
    _check(docs)
