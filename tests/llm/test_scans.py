"""Operators 2, 8 and 9 against plain Python on the small tables and on fixtures."""

import base64
import gzip
import hashlib
import re
from urllib.parse import quote

from sackcast.llm import html_text, licenses, secret_scan


def _base_license(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def _check_licenses(docs):
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want.setdefault(r["doc_id"], []).append(_base_license(r["text"]))
    got = {}
    for r in licenses.scan_licenses(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}


def test_license_base_equals_plain_scan(documents, odd_docs):
    _check_licenses(documents)
    _check_licenses(odd_docs)
    assert licenses.scan_licenses(documents.limit(0)).count() == 0


def test_license_templates(spark):
    texts = ["so Licensed under the Apache License, Version 2.0. end", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
             "this software and associated documentation files (the Software), to deal in the Software without restriction, including",
             "permission is granted to go", "Licensed under CC BY-NC 4.0."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert got[0]["labels"] == "apache,apache-2.0" and got[1]["labels"] == "mit-notice" and got[1]["score"] > 0.95
    assert got[2]["labels"] == "" and got[2]["score"] == 0 and got[3]["labels"] == "cc-by,cc-by-nc-4.0"


def test_license_templates_in_a_bundle(spark):
    """Each notice is found word for word whatever stands beside it."""
    every = [(label, text) for label, text, _ in licenses.TEMPLATES]
    filler = " some other words between them " * 3
    bundle = filler.join(text for _, text in every)
    short = [text for label, text in every if label in ("mit-release", "apache-2.0", "gpl-3.0", "cc-by-4.0")]
    rows = [bundle, filler * 2000 + bundle, *[f"so {text} end" for _, text in every], *[f"see {t} ok" for t in short * 40]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    for k in (0, 1):
        assert {label for label, _ in every} <= set(got[k]["labels"].split(",")) and got[k]["score"] == 1
    for k, (label, _) in enumerate(every):
        assert label in got[2 + k]["labels"].split(",") and got[2 + k]["score"] == 1


def _base_secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for k, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 20), (2, "hex", r"[0-9a-f]+", 24)):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def test_secret_base_equals_plain_scan(documents, odd_docs):
    for docs in (documents, odd_docs):
        texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        rows = secret_scan.scan_secrets(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            want = _base_secrets(texts[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex")]
            assert set(want) <= set(filter(None, r["spans"].split(",")))
    assert secret_scan.scan_secrets(documents.limit(0)).count() == 0


def test_nested_layers_map_back():
    plain = 'password = "hunter2hunter2"'
    once = base64.b64encode(plain.encode()).decode()
    for wrapped in (once, base64.b64encode(gzip.compress(plain.encode())).decode(), quote(quote(plain)),
                    "".join(f"\\u{ord(c):04x}" for c in plain), quote(once), base64.b64encode(once.encode()).decode()):
        text = "é start " + wrapped + " end"
        base, every, depth = secret_scan.find_secrets(text)
        found = [x for x in every if x[2] == "assign"]
        assert base == [] and found and depth >= 1
        assert all(8 <= s < e <= 8 + len(wrapped) for s, e, _ in found)
        masked = secret_scan.redacted(text, every)
        assert "".join(f"\\u{ord(c):04x}" for c in "hunter2") not in masked
        assert wrapped.startswith("\\u") or wrapped[:4] not in masked


def _masked(text, wrapped):
    """Whether assignments are found, within ``wrapped`` only."""
    every = [x for x in secret_scan.find_secrets(text)[1] if x[2] == "assign"]
    at = text.index(wrapped)
    return bool(every) and all(at <= s < e <= at + len(wrapped) for s, e, _ in every)


def test_wrapped_base64_and_several_members():
    import random
    rng = random.Random(2)
    noise = "".join(rng.choice("abcdefghij klmnop,") for _ in range(900))
    two = gzip.compress(noise.encode()) + gzip.compress(b" password=hunter2secret")
    for raw in (gzip.compress((noise + " password=hunter2secret").encode()), two):
        one = base64.b64encode(raw).decode()
        assert _masked(f"see {one} end", one)
        for line_end in ("\n", "\r\n"):
            lines = line_end.join(one[i:i + 76] for i in range(0, len(one), 76))
            for before, after in (("see\n", "\nend"), ("see: ", " end"), ("A\n\n", "\n"), ("key ", "\n-- \n")):
                assert _masked(before + lines + after, lines), (before, after)
            short = one[:50] + line_end + line_end.join(one[50:][i:i + 76] for i in range(0, len(one) - 50, 76))
            assert _masked(f'x = "{short}"', short)
    cut = "B" * 50 + " password=hunter2secret " + "C" * 40  # across the line break
    lines = base64.encodebytes(cut.encode()).decode().strip()
    assert _masked("\n" + lines + "\n", lines)


def test_long_compressed_layers_are_scanned_whole(monkeypatch):
    line = "päß words, and so on. "
    for block in (64, 1001):
        monkeypatch.setattr(secret_scan, "BLOCK", block)
        for k in range(0, 64, 3):
            text = line * 40 + "x" * k + ' password  =  "hunter2secret" ' + line * 40 + "api_key: abcdef123 "
            packed = gzip.compress(text.encode())
            blocks = list(secret_scan._inflated_blocks(packed))
            assert "".join(blocks) == text and len(blocks) > 1
            assert sum(len(secret_scan.scan(b)) for b in blocks) == len(secret_scan.scan(text)) == 2
            one = base64.b64encode(packed).decode()
            assert _masked(f"a {one} b", one)
    monkeypatch.undo()
    text = "é" * 5 + "the words of it, " * (1 << 22) + "password=hunter2secret"  # over 64 MB
    assert len(text.encode()) > 1 << 26
    one = base64.b64encode(gzip.compress(text.encode(), 1)).decode()
    assert _masked(f"a {one} b", one)


def test_same_layer_is_entered_once():
    assert secret_scan.find_secrets("%25%32%35%25" * 50)[2] >= 1


def test_redaction(odd_docs):
    rows = {r["doc_id"]: r for r in secret_scan.redact_secrets(odd_docs).collect()}
    assert rows[6]["text"].startswith("[secret]") and rows[6]["n_chars"] == len(rows[6]["text"]) and rows[2]["text"] is None
    assert secret_scan.redact_secrets(odd_docs).columns == odd_docs.columns


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/a">the of and</a></nav><!-- x <p>no</p> -->
<div class="ad">buy the thing and go to the shop that is on the corner of the road for it</div><div class="cookie-notice">We use the cookies</div>
<article><header><h1>A &amp; B</h1></header><p>First &lt;one&gt;<br>line<b>d</b></p><p>%s<p>Short.</p><form>name <input></form>
<ul><li>item one</li></ul></article><div id="comments"><p>%s</p></div><footer>&copy; end</footer></body></html>"""


def test_pages_fixture():
    long = "the cat of the house is on the roof and it is at the door with a dog that was by the road " * 4
    assert html_text.main_text(PAGE % (long, long)) == "\n".join(["A & B", "First <one> lined", long.strip(), "Short.", "item one"])
    assert html_text.main_text("") == ""
    plain = f"<body><div><a href=x>menu</a> <a href=y>more</a></div><p>{long}</p><p>So it is.</p><p>{long}</p><div><a href=z>legal</a></div>"
    assert html_text.main_text(plain) == "\n".join([long.strip(), "So it is.", long.strip()])


def test_article_in_a_marked_layout():
    long = "the cat of the house is on the roof and it is at the door with a dog that was by the road " * 4
    article = f"<article><h1>Title</h1><p>{long}</p><div class='share'>{long}</div><p>Short.</p></article>"
    want = "\n".join(["Title", long.strip(), "Short."])
    comments = f"<div id='comments'><article><p>{long} no</p></article></div>"
    for page in (article, f'<div class="content has-sidebar">{article}</div>', f'<div id="header-and-main"><main>{article}</main></div>',
                 f'<main><div class="content has-sidebar">{article}{comments}</div></main>',
                 f"{article}{comments}", f'<div class="has-sidebar"><div class="sidebar"><p>{long}</p></div>{article}{comments}</div>',
                 f'<div class="has-sidebar">{article[:-10]}{comments}</article></div>'):
        assert html_text.main_text(f"<body>{page}<p>end</p></body>").removesuffix("\nend") == want, page
    assert html_text.main_text(f"<main><p>{long}</p>{comments}</main>") == long.strip()
    for name in ("nav", "aside", "footer", "form"):
        assert html_text.main_text(f"<{name}>{article}</{name}>") == ""
    assert html_text.main_text(f'<div class="sidebar" style="display:none">{article}</div>') == ""


def test_pages_equal_their_articles(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", article)
        want = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
        assert got[r["page_id"]]["text"] == "\n".join(w for w in want if w)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    odd = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2)], "page_id long, url string, html string, text int")
    assert [(r["text"], r["n_chars"]) for r in html_text.extract_text(odd).collect()] == [("", 0)] * 3
    assert html_text.extract_text(pages.limit(0)).count() == 0
