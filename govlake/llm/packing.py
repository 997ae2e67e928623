"""Packing documents into fixed-length sequences along a Hilbert curve.

A document's token counts are hashed to a vector of unit length and projected to three dimensions;
the cell of a grid it falls in gives its place on a Hilbert curve, so documents near each other on
the curve share words. Documents are range-sorted by that place and poured into sequences of
`limit` tokens one after the other. Only the end of each range is not full: it is cut into
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import tokens
from .shared import cut, partitions, text_of

HASHED, DIMENSIONS, DEPTH = 4096, 3, 16


@functools.lru_cache(maxsize=2)
def _projection(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each id is counted, and the directions of the counters."""
    rng = np.random.default_rng(1891)
    return rng.integers(0, HASHED, ids), rng.choice([-1.0, 1.0], (HASHED, DIMENSIONS))


def project(ids: np.ndarray, size: int) -> np.ndarray:
    """Three numbers of about unit variance; zeros for a document without ids."""
    bucket, directions = _projection(size)
    counts = np.sqrt(np.bincount(bucket[ids], minlength=HASHED))
    norm = np.sqrt((counts * counts).sum())
    return counts @ directions / norm if norm else np.zeros(DIMENSIONS)


def cells(points: np.ndarray) -> np.ndarray:
    """Grid cells of points, the same at every corpus: a logistic curve close to the normal one."""
    return np.minimum((2**DEPTH / (1 + np.exp(-1.702 * points))).astype(np.int64), 2**DEPTH - 1)


def hilbert(grid: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates, after Skilling's transform."""
    x = grid.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (depth - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (depth - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(depth - 1, -1, -1):
        for i in range(n):
            place = place << 1 | (x[i] >> b) & 1
    return place


def _keyed(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = tokens.word_ids(path, end_id)
        size = coded.tokenizer.get_vocab_size()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            raws = [coded.encode(t.as_py()) for t in batch.column("text")]
            points = np.array([project(coded.ids(r)[:-1], size) for r in raws]).reshape(-1, DIMENSIONS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hilbert(cells(points))),
                 pa.array(np.arange(row, row + len(raws))), pa.array(raws, pa.binary())],
                ["doc_id", "place", "row", "ids"])
            row += len(raws)

    return run


def pour(documents: Iterator[tuple[int | None, np.ndarray]], limit: int, first: int
         ) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, crc32, doc_tokens, sequence_id, offset) of documents in order.

    Only the open sequence is held, so memory does not grow with the documents.
    """
    held: list[tuple[int | None, int, np.ndarray, int]] = []
    filled, sequence = 0, first

    def closed(pieces, number):
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")), total, number, offset
            offset += len(ids)

    for doc_id, ids in documents:
        at = 0
        while at < len(ids):
            take = ids[at:at + limit - filled]
            held.append((doc_id, at, take, len(ids)))
            at += len(take)
            filled += len(take)
            if filled == limit:
                yield from closed(held, sequence)
                held, filled, sequence = [], 0, sequence + 1
    while filled:
        room = 1 << (filled.bit_length() - 1)
        filled -= room
        mine, rest = [], []
        for doc_id, start, ids, total in held:
            if room:
                mine.append((doc_id, start, ids[:room], total))
            if len(ids) > room:
                rest.append((doc_id, start + room, ids[room:], total))
            room -= min(room, len(ids))
        yield from closed(mine, sequence)
        held, sequence = rest, sequence + 1


def _poured(path: str, end_id: int, limit: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = tokens.word_ids(path, end_id)
        documents = ((d, coded.ids(raw.as_py())) for b in batches
                     for d, raw in zip(b.column("doc_id").to_pylist(), b.column("ids"), strict=True))
        pieces: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], names)

        for piece in pour(documents, limit, TaskContext.get().partitionId() << 40):
            pieces.append(piece)
            if len(pieces) == 20_000:
                yield batch()
                pieces.clear()
        if pieces:
            yield batch()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, limit: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, ids_crc32,
    doc_tokens, sequence_id and offset in that sequence.

    Every id of every whole text, and `end_id` after each, lies in exactly one piece; null and
    empty texts are their end id. Repeated rows and null doc_ids are packed like any other. Other
    columns are not read. No document is too long: it is cut where a sequence is full. Rows of one
    place on the curve are told apart by a row number, so copies spread over many tasks.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    keyed = cut(rows.mapInArrow(_keyed(tokenizer, end_id), "doc_id long, place long, row long, ids binary"))
    dealt = (keyed.repartitionByRange(partitions(docs.sparkSession), "place", "doc_id", "row")
             .sortWithinPartitions("place", "doc_id", "row").select("doc_id", "ids"))
    return dealt.mapInArrow(
        _poured(tokenizer, end_id, limit),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
