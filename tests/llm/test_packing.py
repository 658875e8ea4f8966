import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sackcast.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    public = Tokenizer.from_file(PATH)
    return lambda text: [*public.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_are_those_of_whole_texts(plain):
    rng = np.random.default_rng(3)
    signs = list("aAzZ's' 't09.,|<>=-_ÀéÉß\n\t 漢字🎉l d r e v ḿ̸‍\x00\x1c\x85 ")
    texts = ["Don't 'TIS it's, x='s a'b,c <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> 12.5", "", None, "Σας ΑΣ 1١2 ≮ é,́ a≠", "'s's'll,'d|'re|"]
    texts += ["".join(rng.choice(signs, 40)) for _ in range(500)]
    for some in (texts, texts[1:3], [x for x in texts if x and "|" not in x], []):
        ids, bounds = packing.tokenizer(PATH)(pa.array(some, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain(x) for x in some]


def check(rows, docs, plain, most):
    """Every document is whole, sequences hold at most ``most`` tokens without gaps."""
    left = sorted(((d, tuple(plain(t))) for d, t in docs), key=str)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.sequence_id, []).append(r)
    for held in pieces.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= most
    expected = sorted(((d, k, k * most, len(ids[k * most:(k + 1) * most]), zlib.crc32(np.array(ids[k * most:(k + 1) * most], "<u4").tobytes()))
                       for d, ids in left for k in range(-(-len(ids) // most))), key=str)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == expected
    return len(pieces), -(-sum(len(ids) for _, ids in left) // most)


def test_packs_whole_documents(spark, documents, plain):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    made, least = check(packing.pack_documents(documents, PATH).collect(), docs, plain, 2048)
    assert made <= 1.01 * least + 1


def test_odd_rows_and_groups(spark, odd_docs, plain, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 4)  # several groups
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(packing.pack_documents(odd_docs.withColumnsRenamed({"size": "sequence_id"}), PATH, 64).collect(), docs, plain, 64)
    assert packing.pack_documents(odd_docs.limit(0), PATH).count() == 0


def plain_rule(sizes, most):
    """The rule, tried for every open bin and added up anew."""
    gaps, bins = [], []
    for s in sizes:
        def cost(k):
            after = [g - s * (j == k) for j, g in enumerate(gaps)]
            return sum(sum(g == x for g in after) ** 2 for x in set(after) - {0})
        fit = [(cost(k), g, k) for k, g in enumerate(gaps) if g >= s]
        if fit:
            best = min(fit)[:2]
            bins.append((best, gaps[min(fit)[2]]))
            gaps[min(fit)[2]] -= s
        else:
            bins.append(None)
            gaps.append(most - s)
    return sorted(gaps)


def test_rule_is_the_sum_of_squares():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 20, 40)
        bins, offset = packing.pack_sizes(sizes, 24)
        fill = np.bincount(bins, sizes)
        assert fill.max() <= 24 and sorted(24 - fill) == plain_rule(sizes.tolist(), 24)
        for b in range(len(fill)):
            own = np.flatnonzero(bins == b)
            assert (np.sort(offset[own]) == np.concatenate([[0], np.cumsum(sizes[own][np.argsort(offset[own])])[:-1]])).all()
    bins, _ = packing.pack_sizes(np.array([8, 8, 8], np.int64), 8)
    assert len(set(bins)) == 3
