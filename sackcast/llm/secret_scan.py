"""Operator 8: secret scans by a recursive decoding worklist.

Each text is the first layer. A layer is scanned for secrets, and its URL
escapes, Unicode escapes and base64 runs, also those wrapped into lines (inflated
if they hold zlib or gzip data, all members), are unwrapped into new layers,
until no new layer is left; a layer seen before at the same place of a document
is not entered again. Inflated data come in blocks, cut only where no match can
cross, one in memory at a time. Every character of a layer knows its span of the
original text, so secrets found in depth map back.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import pieces

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8})+")
_ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

#: Two and more lines of base64 characters (the first may begin, the last may end within a line).
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: Least length of the full lines of wrapped base64.
LEAST_LINE = 16

#: Bytes inflated at once; a block is that long and what follows to the next safe cut (a text without any is held whole).
BLOCK = 1 << 20
#: No match of this module holds such a character, or a space after a letter (not a hex digit) and before a letter or digit;
#: decoding leaves both as they are, so this holds in deeper layers too.
_SAFE = re.compile(r"""[^A-Za-z0-9+/_.=\-"'\x20:%\\\r\n]|[g-zG-Z]\x20(?=[A-Za-z0-9])""")


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets written plainly in ``text``."""
    found = []
    for match in _ASSIGN.finditer(text):
        if match.end(1) - match.start(1) >= 6:
            found.append((match.start(), match.end(), "assign"))
    for match in _ACCESS.finditer(text):
        if match.end() - match.start() >= 20:
            found.append((match.start(), match.end(), "access"))
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


class Layer:
    """A decoded text; ``spans`` gives each character's span of the original, or None where it is the original."""

    def __init__(self, text: str, spans: list[tuple[int, int]] | None, depth: int):
        self.text, self.spans, self.depth = text, spans, depth

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.spans is None or start >= end:
            return start, end
        return min(x[0] for x in self.spans[start:end]), max(x[1] for x in self.spans[start:end])


def _substituted(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match replaced by (characters, each with its span in the layer)."""
    text, spans, at, changed = [], [], 0, False
    for match in pattern.finditer(layer.text):
        plain = decode(match)
        if plain is None:
            continue
        changed = True
        text.append(layer.text[at:match.start()])
        spans += [layer.origin(i, i + 1) for i in range(at, match.start())]
        for char, (start, end) in plain:
            text.append(char)
            spans.append(layer.origin(match.start() + start, match.start() + end))
        at = match.end()
    if not changed:
        return None
    text.append(layer.text[at:])
    spans += [layer.origin(i, i + 1) for i in range(at, len(layer.text))]
    return Layer("".join(text), spans, layer.depth + 1)


def _percent(match: re.Match):
    raw = bytes.fromhex(match.group().replace("%", ""))
    plain, at = [], 0
    for char in raw.decode("utf-8", "replace"):
        width = 1 if char == "�" else len(char.encode())
        plain.append((char, (3 * at, 3 * min(at + width, len(raw)))))
        at = min(at + width, len(raw) - 1) if char == "�" else at + width
    return plain


def _escape(match: re.Match):
    plain, high = [], None
    for one in _ONE_ESCAPE.finditer(match.group()):
        code = int(one.group(1) or one.group(2) or one.group(3), 16)
        span = one.span()
        if high and 0xDC00 <= code < 0xE000:
            code, span = 0x10000 + ((high[0] - 0xD800) << 10) + code - 0xDC00, (high[1], span[1])
            plain.pop()
        high = (code, span[0]) if 0xD800 <= code < 0xDC00 else None
        plain.append((chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�", span))
    return plain


def _inflated(raw: bytes) -> Iterator[bytes]:
    """The data of all zlib or gzip members at the start of ``raw``, BLOCK bytes at most at a time; zlib.error where it is damaged."""
    while raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78":
        member = zlib.decompressobj(zlib.MAX_WBITS | 32)
        while not member.eof:
            part = member.decompress(raw, BLOCK)
            raw = member.unconsumed_tail
            if not part and not raw and not member.eof:
                return  # ends before the member does
            yield part
        raw = member.unused_data.lstrip(b"\0")


def _decoded(raw: bytes) -> Iterator[str]:
    """Inflated text, up to where the data are damaged or end within a character."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        for part in _inflated(raw):
            yield decoder.decode(part)
    except zlib.error:
        return


def _printable(text: str) -> int:
    return sum(c.isprintable() or c in "\t\r\n" for c in text)


def _inflated_blocks(raw: bytes) -> Iterator[str]:
    """The text in ``raw``, cut at safe places; none if it isn't UTF-8 or not mostly printable."""
    size = good = 0
    try:
        for part in _decoded(raw):
            size, good = size + len(part), good + _printable(part)
    except UnicodeDecodeError:
        return
    if good < 0.9 * size:
        return
    held, before = [], ""  # text not yet given, and the two characters before the next part
    for part in _decoded(raw):
        window = before + part
        cut = max((m.end() for m in _SAFE.finditer(window)), default=0) - len(before)
        if cut > 0 or cut == 0 and held:
            yield "".join([*held, part[:cut]])
            held, part = [], part[cut:]
        if part:
            held.append(part)
        before = window[-2:]
    if held:
        yield "".join(held)


def _runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Pieces (start, end) of the base64 runs: those of one line, and wrapped ones with and without an odd first and last line."""
    for match in _BASE64.finditer(text):
        yield [match.span()]
    if "\n" not in text:
        return
    for match in _LINES.finditer(text):
        lines = [m.span() for m in _LINE.finditer(text, match.start(), match.end())]
        width = [len(text[a:b].rstrip("=")) for a, b in lines]
        k = 0
        while k < len(lines):
            stop = k + 1
            while stop < len(lines) and width[stop] == width[k]:
                stop += 1
            if width[k] >= LEAST_LINE:
                firsts = [k, k - 1] if k and width[k - 1] < width[k] else [k]
                lasts = [stop, stop + 1] if stop < len(lines) and width[stop] < width[k] else [stop]
                for first in firsts:
                    for last in lasts:
                        if last - first > 1:
                            yield lines[first:last]
            k = stop


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    for parts in _runs(layer.text):
        body = "".join(layer.text[a:b] for a, b in parts).rstrip("=").replace("-", "+").replace("_", "/")
        body = body[:len(body) - 1] if len(body) % 4 == 1 else body
        try:
            raw = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        if raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78":
            origin = layer.origin(parts[0][0], parts[-1][1])
            for text in _inflated_blocks(raw):
                yield Layer(text, [origin] * len(text), layer.depth + 1)
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if not text or _printable(text) < 0.9 * len(text):
            continue
        place = [i for a, b in parts for i in range(a, b)]
        groups = []
        for k, char in enumerate(text):
            groups += [k] * len(char.encode())
        spans: list[tuple[int, int]] = [(1 << 62, 0)] * len(text)
        for b, k in enumerate(groups):
            first = place[b * 4 // 3]
            last = place[min((b * 4 + 5) // 3, len(place) - 1)] + 1
            spans[k] = min(spans[k][0], first), max(spans[k][1], last)
        yield Layer(text, [layer.origin(*x) for x in spans], layer.depth + 1)


def _inner(layer: Layer) -> Iterator[Layer]:
    yield from _base64_layers(layer)
    if "%" in layer.text and (more := _substituted(layer, _PERCENT, _percent)):
        yield more
    if "\\" in layer.text and (more := _substituted(layer, _ESCAPES, _escape)):
        yield more


def find_secrets(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], int]:
    """Base spans, all spans (both sorted), and the depth reached."""
    base = scan(text)
    every, depth = set(base), 0
    work, seen = [iter([Layer(text, None, 0)])], set()
    while work:
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass")).digest(), layer.origin(0, len(layer.text)))
        if mark in seen:
            continue
        seen.add(mark)
        depth = max(depth, layer.depth)
        if layer.depth:
            every.update((*layer.origin(s, e), kind) for s, e, kind in scan(layer.text))
        work.append(_inner(layer))
    return base, sorted(every, key=lambda x: (x[0], KINDS.index(x[2]), x[1])), depth


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mask: str = "[secret]") -> str:
    """``text`` with the union of ``spans`` replaced by ``mask``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        elif end <= at:
            continue
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scan_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, rows = batch.column("doc_id"), []
    for text in batch.column("text").to_pylist():
        base, every, depth = find_secrets(text or "")
        counts = [sum(x[2] == kind for x in base) for kind in KINDS]
        rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every) - len(base), depth))
    columns = list(zip(*rows)) if rows else [[]] * 7
    kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded", "depth"]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], names)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text; other columns are not read):
    doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded, depth.

    Null text is empty and gives zero counts; a null doc_id stays null; repeated
    rows each give their row; an empty table gives none. Positions count code points.
    """
    def run(batches):
        for piece in pieces(batches):
            yield _scan_batch(piece)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long, depth long"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with every secret (spans of all layers) replaced by a mask; n_chars follows the text if it is there."""
    names = docs.columns

    def run(batches):
        for piece in pieces(batches):
            texts = [x if x is None else redacted(x, find_secrets(x)[1]) for x in piece.column("text").to_pylist()]
            columns = {n: piece.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([o if t is None else len(t) for o, t in zip(old, texts)], piece.column("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)
    return docs.mapInArrow(run, docs.schema)
