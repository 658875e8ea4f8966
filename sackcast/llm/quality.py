"""Operator 7: ordinal cumulative-link regression on graded ratings.

A document's grade is 0 (toxic), 1 (poor) or 2 (good). Hashed words and the
shape of the text are features with one weight each, shared by all grades;
ordered thresholds t_0 < t_1 give P(grade <= k) = sigmoid(t_k - score), so every
document gets an expected grade and a tail probability P(grade >= 2), by which
it is kept. The model is fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import LOWER, NOT_SPACE, mix, pieces, runs_of_words, words_of

#: Hashed features; labelled documents of the fitting sample, at most about so many; chance of a good grade that keeps a document.
BITS, SAMPLE, KEEP = 18, 3000, 0.35
ROUNDS, RATE, DECAY = 250, 0.05, 1e-4
#: Word beginnings of so many bytes are features too; a feature needs so many documents of the sample.
STEMS, LEAST_DOCS = (4, 5, 6, 7), 5
#: Words added to a document's count, so that a few words say little.
DAMPING = 15
#: Features that a step of the fit takes at once, at least one document's.
PART = 1 << 17

_LETTER = np.zeros(256, bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F | 1))
#: Words are hashed on their letters and digits in lower case, marks are summed apart.
WORD_VALUE = np.where(_LETTER, _VALUE[LOWER], np.uint64(0))
MARK_VALUE = np.where(_LETTER, np.uint64(0), _VALUE)
_UPPER = np.zeros(256, np.int64)
_UPPER[0x41:0x5B] = 1


def features(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, feature, value) of a piece: square roots of the (damped)
    shares of a document's words, word beginnings, marks and shapes."""
    words = words_of(piece.column("text"), NOT_SPACE)
    doc, n = words.doc, piece.num_rows
    letters, *stems = words.prefix_hashes(WORD_VALUE, (None, *STEMS))
    stems = [mix(x ^ np.uint64(k + 1)) for k, x in enumerate(stems)]
    marks, capitals = words.sums(MARK_VALUE), words.sums(_UPPER)
    shape = mix((marks ^ mix(np.minimum(capitals, 3).astype(np.uint64) + np.uint64(11))))
    total = np.diff(words.first) + DAMPING
    mask = np.int64((1 << BITS) - 1)
    out = []
    for family in (letters, shape, *stems):
        key, count = np.unique(doc * (1 << BITS) + (family >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
        d = key >> BITS
        out.append((d, key & mask, np.sqrt(count / total[d])))
    runs, whole = runs_of_words(letters, doc, 3)
    d = doc[:len(runs)][whole]
    distinct = np.bincount(np.unique(np.stack([d, runs[whole].astype(np.int64)]), axis=1)[0] if len(d) else d, minlength=n)
    repeated = 1 - distinct / np.maximum(np.bincount(d, minlength=n), 1)
    repeated[np.bincount(d, minlength=n) == 0] = 0
    for k, level in enumerate((0.1, 0.3, 0.6, 0.9)):
        at = np.flatnonzero(repeated > level)
        out.append((at, np.full(len(at), (1 << BITS) - 1 - k), np.ones(len(at))))
    at = np.flatnonzero(np.diff(words.first) == 0)
    out.append((at, np.full(len(at), (1 << BITS) - 9), np.ones(len(at))))
    return tuple(np.concatenate(x) for x in zip(*out))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(doc, self.weights[feature] * value, minlength=n)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. (one column each)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def _parts(found: pa.Table) -> tuple[list[tuple], np.ndarray]:
    """(first document, documents, document of each entry, slot, value) of about PART entries of the sample
    at a time, documents by doc_id, and the feature of each slot: those of LEAST_DOCS documents. The
    entries stay in Arrow's buffers until a part copies its own."""
    order = np.argsort(np.asarray(found.column("doc_id")), kind="stable")
    rows = [(x.as_buffer(), y.as_buffer()) for x, y in zip(found.column("feature"), found.column("value"))]
    times = np.zeros(1 << BITS, np.int64)
    for feature, _ in rows:
        np.add.at(times, np.frombuffer(feature, np.int32), 1)
    often = times >= max(1, min(LEAST_DOCS, len(rows)))
    used, slots = np.flatnonzero(often), np.cumsum(often, dtype=np.int32) - 1
    size = np.array([rows[k][0].size // 4 for k in order], np.int64)
    part = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)[:-1]]) // PART
    first = [*np.flatnonzero(np.diff(part, prepend=-1)), len(order)]
    out = []
    for a, b in zip(first[:-1], first[1:]):
        doc = np.repeat(np.arange(b - a, dtype=np.int32), size[a:b])
        feature, value = (np.concatenate([np.frombuffer(rows[k][c], kind) for k in order[a:b]]) for c, kind in ((0, np.int32), (1, np.float32)))
        kept = often[feature]
        out.append((int(a), int(b - a), doc[kept], slots[feature[kept]], value[kept]))
    return out, used


def fit_ordinal(parts: list[tuple], used: np.ndarray, grade: np.ndarray, grades: int = 3) -> OrdinalModel:
    """Full-batch Adam on the negative log-likelihood; a documents' grade is weighed by the inverse root of its frequency.
    Sums go on from part to part (see ``_parts``), so the model doesn't depend on where they are cut."""
    n = len(grade)
    w = np.zeros(len(used))
    b, gaps = -1.0, np.zeros(grades - 2)  # thresholds: b, b + e^gap, ...
    share = np.bincount(grade, minlength=grades) / max(n, 1)
    weight = 1 / np.sqrt(np.maximum(share[grade], 1e-9))
    weight /= weight.sum() or 1
    moments = [[np.zeros_like(w), np.zeros_like(w)], [np.zeros(grades - 1), np.zeros(grades - 1)]]
    for step in range(1, ROUNDS + 1):
        t = b + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.concatenate([np.bincount(doc, w[slot] * value, minlength=docs) for _, docs, doc, slot, value in parts])
        edge = np.concatenate([[-40.0], t, [40.0]])
        up, low = (1 / (1 + np.exp(-np.clip(e - score, -40, 40))) for e in (edge[grade + 1], edge[grade]))
        mass = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / mass, low * (1 - low) / mass
        g_score = weight * (d_up - d_low)
        g_w = np.zeros(len(used))
        for first, docs, doc, slot, value in parts:
            np.add.at(g_w, slot, g_score[first:first + docs][doc] * value)
        g_w += DECAY * w
        g_t = np.zeros(grades + 1)
        np.add.at(g_t, grade + 1, -weight * d_up)
        np.add.at(g_t, grade, weight * d_low)
        g_t = g_t[1:-1]
        g_b = np.concatenate([[g_t.sum()], [g_t[k + 1:].sum() * np.exp(gaps[k]) for k in range(grades - 2)]])
        moves = []
        for (m, v), g in zip(moments, (g_w, g_b)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            moves.append(RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8))
        w -= moves[0]
        b -= moves[1][0]
        gaps -= moves[1][1:]
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    return OrdinalModel(weights, b + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): the lowest grade any label row gives the document; null labels count as quality 0, not toxic; null ids are dropped."""
    grade = F.when(F.coalesce("toxic", F.lit(0)) != 0, 0).when(F.coalesce("quality", F.lit(0)) == 0, 1).otherwise(2)
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).alias("grade"))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> OrdinalModel | None:
    """Model from at most about ``sample`` labelled documents, chosen by a hash of doc_id; None where nothing is labelled."""
    grades = graded(labels)
    n = grades.count()
    if not n:
        return None
    chosen = grades.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / n))))
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def extract(batches):
        for piece in pieces(batches):
            doc, feature, value = features(piece)
            order = np.argsort(doc, kind="stable")
            cuts = np.searchsorted(doc[order], np.arange(1, piece.num_rows))
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("grade"),
                pa.array([x.astype(np.int32).tobytes() for x in np.split(feature[order], cuts)], pa.binary()),
                pa.array([x.astype(np.float32).tobytes() for x in np.split(value[order], cuts)], pa.binary())], ["doc_id", "grade", "feature", "value"])
    found = rows.mapInArrow(extract, "doc_id long, grade int, feature binary, value binary").toArrow()
    if not found.num_rows:
        return None
    grade = np.asarray(found.column("grade"), np.int64)[np.argsort(np.asarray(found.column("doc_id")), kind="stable")]
    parts, used = _parts(found)
    del found
    pa.default_memory_pool().release_unused()
    return fit_ordinal(parts, used, grade)


def rate_quality(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """The columns of ``docs`` and expected_grade, p_good, p_not_toxic, keep (new names replace columns of the same name).

    A document without words has no features but one of its own; null text is
    empty; repeated rows are rated alike; without a model (no labelled document)
    every document gets grade 2 and stays. An empty table gives no rows.
    """
    added = ["expected_grade", "p_good", "p_not_toxic", "keep"]
    docs = docs.drop(*added)
    if model is None:
        return docs.withColumns({"expected_grade": F.lit(2.0), "p_good": F.lit(1.0), "p_not_toxic": F.lit(1.0), "keep": F.lit(True)})
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches):
        for piece in pieces(batches):
            tails = sent.value.tails(sent.value.score(*features(piece), piece.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, 0]), pa.array(tails[:, -1] >= KEEP)], [*names, *added])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, expected_grade double, p_good double, p_not_toxic double, keep boolean")


def kept_quality(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """The rows of ``docs`` that the model keeps, all columns as they are, whatever their
    names. Null and empty texts are rated like texts without words; without a model
    every row stays; an empty table gives none."""
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for piece in pieces(batches):
            tails = sent.value.tails(sent.value.score(*features(piece), piece.num_rows))
            yield piece.filter(pa.array(tails[:, -1] >= KEEP))
    return docs.mapInArrow(run, docs.schema)
