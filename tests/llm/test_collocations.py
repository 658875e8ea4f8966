import re
from collections import Counter

from sackcast.llm import collocations


def brute(rows, longest=3, least=10, share=50, best=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, *words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for key, a in f.items():
        lang, w = key[0], key[1:]
        if len(w) < 2 or a < least:
            continue
        score, k = min((1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w)))
        longer = (x for x, b in f.items() if x[0] == lang and len(x) - 1 > len(w) and b >= least and 100 * b >= share * a)
        if any(x[i:i + len(w)] == w for x in longer for i in range(1, len(x) - len(w) + 1)):
            continue
        out.append((lang, " ".join(w), a, f[lang, *w[:k]], f[lang, *w[k:]], n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, r + 1, *x[1:]) for r, x in enumerate(own[:best])]
    return sorted(ranked)


def ours(spark, rows, **kinds):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, phrase string")
    return sorted(tuple(r) for r in collocations.mine_collocations(table, **kinds).collect())


def made():
    rows = []
    for i in range(40):
        rows.append(("en" if i % 3 else None, f"New York city {i}; the big Apple. New york City, the the the the big\napple new {i % 4} york"))
        rows.append(("de", f"über alles gut: Über Alles ÜBER alles gut {i % 2} gut\x0bund\tüber  alles"))
    return rows


def test_same_as_brute_force(spark):
    rows = made()
    expected = brute(rows)
    assert expected and ours(spark, rows) == expected


def test_words_beyond_the_codes_keep_their_hash(spark):
    rows = made()
    assert ours(spark, rows, codes=5) == brute(rows)


def test_other_lengths_and_limits(spark):
    rows = made()
    assert ours(spark, rows, longest=2, least=3) == brute(rows, 2, 3)
    assert ours(spark, rows, longest=4, least=4, best=5) == brute(rows, 4, 4, best=5)


def test_odd_rows(spark):
    rows = [(None, None), ("en", ""), ("", "a b " * 12), ("und", "a b " * 12), (None, "A B " * 5), ("en", "\t \n"), ("en", "long word " * 60000), ("en", "x y \x00 " * 11)]
    rows += [("en", "same text here")] * 12
    assert ours(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine_collocations(empty).count() == 0
    assert ours(spark, [("en", "too rare")]) == []
