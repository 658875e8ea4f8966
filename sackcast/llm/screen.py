"""Which anchors of a document occur anywhere else: one pass, one shuffle of hashes.

A task looks for repeats in the pack of documents it has at hand. What it finds
there is decided on the spot; each distinct anchor asks the others once a pack.
So a hot anchor sends one row a pack, however many documents hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import mix, pieces

#: Text bytes of a pack.
PACK_BYTES = 8 << 20

ALONE, ASKED, DECIDED = 0, 1, 2


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, at, version, text): ``at`` orders documents (null last); with
    ``version``, a short tag of the text (a long one where the id is null), it
    names a row's document and text."""
    tag = F.xxhash64("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("at"),
        F.when(F.col("doc_id").isNull(), tag).otherwise(tag.bitwiseAND(F.lit((1 << 20) - 1))).alias("version"), "text")


def packs(batches, column: str = "text", most: int = PACK_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """Pieces gathered into packs."""
    pack, size = [], 0
    for piece in pieces(batches, column):
        pack.append(piece)
        size += piece.column(column).nbytes
        if size >= most:
            yield pack
            pack, size = [], 0
    if pack:
        yield pack


def neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted values: which are the first of their kind, and which are not alone."""
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    alone = fresh.copy()
    alone[:-1] &= fresh[1:]
    return fresh, ~alone


def repeated_anchors(rows: DataFrame, anchors: Callable) -> DataFrame:
    """(at, version, anchor) of the anchors that occur more than once in all documents.

    ``anchors(piece)`` gives (row number, hash) pairs; each pair is an occurrence.
    """
    names = ["part", "at", "version", "anchor", "kind"]

    def run(batches):
        for pack in packs(batches):
            cells = [[], [], []]
            for piece in pack:
                row, found = anchors(piece)
                cells[0].append(np.asarray(piece.column("at"))[row])
                cells[1].append(np.asarray(piece.column("version"))[row])
                cells[2].append(found.astype(np.int64))
            at, version, found = (np.concatenate(x) for x in cells)
            order = np.argsort(found, kind="stable")
            at, version, found = at[order], version[order], found[order]
            fresh, more = neighbours(found)
            decided = np.flatnonzero(more)
            asking = np.flatnonzero(fresh)
            kind = np.concatenate([np.where(more[asking], ASKED, ALONE), np.full(len(decided), DECIDED)])
            row = np.concatenate([asking, decided])
            place = mix(at[row].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(kind == DECIDED, place, found[row])), pa.array(at[row]), pa.array(version[row]),
                pa.array(found[row], mask=kind != DECIDED), pa.array(kind, pa.int32())], names)
    asked = rows.select("at", "version", "text").mapInArrow(run, "part long, at long, version long, anchor long, kind int")
    same = Window.partitionBy("part").orderBy("kind")
    near = asked.withColumn("near", F.lag("kind").over(same).isNotNull() | F.lead("kind").over(same).isNotNull())
    return near.where(f"kind = {DECIDED} or kind = {ALONE} and near").select("at", "version", F.coalesce("anchor", "part").alias("anchor"))
