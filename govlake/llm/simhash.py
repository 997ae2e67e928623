"""SimHash near-duplicates by covering locality-sensitive hashing.

Positions of the 64-bit fingerprint are dealt evenly over the non-zero vectors m(i) of r + 1 bits.
Table v keeps the positions whose m(i) has odd overlap with v. The m of at most r differing
positions span at most r dimensions, so some non-zero v is orthogonal to all of them, and in that
table the pair agrees: every pair within the radius meets in one of 2^(r+1) - 1 tables, each of
which keeps about half of the bits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .components import components
from .shared import cut, partitions, text_of, unused

BITS = 64
#: Members of one table cell that are compared directly; larger cells are split by the same
#: construction over the bits that the cell leaves open, until nothing is left to split.
CELL = 4096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint_of(text: str | None, words: int = 4) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half of the shingle hashes (XXH64, seed 42)."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return 0
    line = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found))
    last = np.cumsum(size + 1) - 1
    first = last - size
    k = min(words, len(found))
    starts, ends = first[:len(found) - k + 1].tolist(), last[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], 42) for s, e in zip(starts, ends, strict=True)], np.dtype("<u8"))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at:at + 65_536]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.dtype("<u8"))[0])


def fingerprint(text: Column, words: int = 4) -> Column:
    """The fingerprint as a signed 64-bit number; null and blank texts give zero."""

    @F.pandas_udf(LongType())
    def made(texts: pd.Series) -> pd.Series:
        out = [fingerprint_of(t, words) for t in texts]
        return pd.Series(np.array(out, np.uint64).view(np.int64))

    return made(text)


@functools.lru_cache(maxsize=32)
def masks(radius: int, free: int = 2**BITS - 1) -> np.ndarray:
    """The covering masks over the bits set in `free`."""
    size = 2 ** (radius + 1)
    places = [i for i in range(BITS) if free >> i & 1]
    v = np.arange(1, size)

    def kept(m: np.ndarray) -> np.ndarray:
        return (np.bitwise_count(m[None, :] & v[:, None]) & 1).astype(bool)

    # Of some fixed dealings take the one whose smallest table keeps most bits. The first is the
    # first-order Reed-Muller code, by which all tables but one keep exactly half.
    n = len(places)
    rng = np.random.default_rng(2016)
    tries = [1 + 2 * (np.arange(n) % (size // 2))]
    tries += [np.resize(rng.permutation(v), n) for _ in range(64)]
    best = max((kept(m) for m in tries), key=lambda k: int(k.sum(axis=1).min()))
    bits = np.array([1 << p for p in places], np.uint64)
    return np.array([np.bitwise_or.reduce(bits[row], initial=np.uint64(0)) for row in best], np.uint64)


def _cell_key(parent: np.ndarray, table: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """64-bit key of a cell; two cells with one key are only compared in vain."""
    with np.errstate(over="ignore"):
        x = kept ^ (parent + np.uint64(0x9E3779B97F4A7C15) * (table + np.uint64(1)))
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(33))


@functools.lru_cache(maxsize=100_000)
def open_bits(path: int, radius: int) -> int:
    """The bits that the cell of a path of tables leaves open. A path is 0 at the top, and a
    table's path is that of the cell above it times 2^(r+1), plus 1 + the table's number."""
    if path == 0:
        return 2**BITS - 1
    above, table = divmod(path, 2 ** (radius + 1))
    free = open_bits(above, radius)
    return free & ~int(masks(radius, free)[table - 1])


def _spread(radius: int):
    """(fp, key, path) -> a row for each covering table over the bits its cell leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                fp, key, path = (batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64)
                                 for n in ("fp", "key", "path"))
                for kind in np.unique(path):
                    own = path == kind
                    m = masks(radius, open_bits(int(kind), radius))
                    n = len(m)
                    f = np.repeat(fp[own], n)
                    table = np.tile(np.arange(n, dtype=np.uint64), own.sum())
                    cell = _cell_key(np.repeat(key[own], n), table, f & np.tile(m, own.sum()))
                    below = kind * np.uint64(n + 1) + table + np.uint64(1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in (f, cell, below)], ["fp", "key", "path"])

    return run


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect just what links within the radius connect; each row is visited once."""
    left = np.arange(1, len(fps))
    edge = np.array([0])
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    while len(left):
        if not len(edge):
            edge, left = left[:1], left[1:]
            continue
        here, edge = edge[:64], edge[64:]
        near = np.bitwise_count(fps[left][:, None] ^ fps[here][None, :]) <= radius
        hit = near.any(axis=1)
        if hit.any():
            new = left[hit]
            a.append(here[near[hit].argmax(axis=1)])
            b.append(new)
            edge, left = np.concatenate([edge, new]), left[~hit]
    none = np.zeros(0, np.int64)
    return (fps[np.concatenate(a)], fps[np.concatenate(b)]) if a else (fps[none], fps[none])


def _cells(radius: int, cell: int):
    """Rows in the order of their cells -> links, and whole cells that are too large as they came."""

    def rows(a: np.ndarray, b: np.ndarray, key: np.ndarray, path: np.ndarray, big: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)) for x in (a, b, key, path)] + [pa.array(np.full(len(a), big))],
            ["a", "b", "key", "path", "big"])

    def compared(key, fp, path) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        each = np.repeat(size, size)
        # cells of up to 8 rows, all at once: row i against row i + lag
        for lag in range(1, 8):
            i = np.flatnonzero((key[lag:] == key[:-lag]) & (each[lag:] <= 8)) if len(key) > lag else []
            if len(i):
                x, y = fp[i], fp[i + lag]
                near = (np.bitwise_count(x ^ y) <= radius) & (x != y)
                if near.any():
                    yield rows(x[near], y[near], key[i][near], path[i][near], False)
        for at, n in zip(start[size > 8].tolist(), size[size > 8].tolist(), strict=True):
            x, y = forest(np.unique(fp[at:at + n]), radius)
            yield rows(x, y, np.zeros_like(x), np.zeros_like(x), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.uint64)] * 3
        overflow: int | None = None
        for batch in batches:
            now = [batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64)
                   for n in ("key", "fp", "path")]
            if overflow is not None:
                more = now[0] == overflow
                if more.any():
                    yield rows(now[1][more], now[1][more], now[0][more], now[2][more], True)
                now = [x[~more] for x in now]
                if not len(now[0]):
                    continue
                overflow = None
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            other = np.flatnonzero(now[0] != now[0][-1])
            tail = int(other[-1]) + 1 if len(other) else 0
            body, held = [x[:tail] for x in now], [x[tail:] for x in now]
            yield from emit(body)
            if len(held[0]) > cell:
                overflow = int(held[0][0])
                yield rows(held[1], held[1], held[0], held[2], True)
                held = [np.zeros(0, np.uint64)] * 3
        yield from emit(held)

    def emit(body) -> Iterator[pa.RecordBatch]:
        key, fp, path = body
        if not len(key):
            return
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.repeat(np.diff(np.r_[start, len(key)]), np.diff(np.r_[start, len(key)]))
        large = size > cell
        if large.any():
            yield rows(fp[large], fp[large], key[large], path[large], True)
        keep = (size > 1) & ~large
        if keep.any():
            yield from compared(key[keep], fp[keep], path[keep])

    return run


def links(fingerprints: DataFrame, radius: int = 4, cell: int = CELL) -> DataFrame:
    """Distinct `fp` -> (a, b) links whose components are those of all pairs within the radius.

    A cell over `cell` rows is dealt anew over the bits it leaves open. Each level keeps about half of
    those, so cells shrink to a few hundred fingerprints within three or four levels.
    """
    spark = fingerprints.sparkSession
    rows = fingerprints.select("fp", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("path"))
    found = None
    while True:
        spread = rows.mapInArrow(_spread(radius), "fp long, key long, path long")
        cells = spread.repartition(partitions(spark), "key").sortWithinPartitions("key", "fp")
        out = cut(cells.mapInArrow(_cells(radius, cell), "a long, b long, key long, path long, big boolean"))
        new = out.where("not big").select("a", "b")
        found = new if found is None else found.unionByName(new)
        rows = out.where("big").select(F.col("a").alias("fp"), "key", "path").distinct()
        if rows.isEmpty():
            return found


def classes(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: doc_id, text_hash, fp (signed), root (a fingerprint that names the
    group) and component_id, the smallest doc_id reachable over links of at most `radius` bits.

    Null and blank texts have fingerprint zero and link like any other. Repeated rows stay;
    rows without doc_id take part and get the component of the others (null if there are none).
    Equal fingerprints are one node, so copies cost one row each and never become pairs.
    """
    made = cut(docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"),
                           fingerprint(text_of(), words).alias("fp")))
    nodes = cut(made.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp"), radius))
    named = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "root").join(least, "root")
    return made.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def report(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """`classes` with the fingerprint as 16 lower-case hex digits."""
    return classes(docs, words, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One document of each near-duplicate group, columns as they came.

    The smallest doc_id stays; rows without doc_id stay only where a group has nothing else. Of
    several texts under that doc_id in one group, and of repeated rows, one stays. Null and blank
    texts are one group; an empty table stays empty.
    """
    found = classes(docs, words, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    counted = cut(found.groupBy("root", "doc_id", "text_hash").count())
    stay = counted.join(counted.groupBy("root").agg(F.min("text_hash").alias("text_hash")),
                        ["root", "text_hash"])
    names = dict(zip(("doc_id", "text_hash"), (unused(docs.columns, n) for n in ("stay_id", "stay_hash")),
                     strict=True))

    def rows_of(kept: DataFrame) -> DataFrame:
        keys = kept.select(*(F.col(n).alias(names[n]) for n in names)).distinct()
        return docs.join(keys, docs["doc_id"].eqNullSafe(F.col(names["doc_id"]))
                         & (F.xxhash64(text_of()) == F.col(names["text_hash"])), "left_semi")

    return (rows_of(stay.where("count = 1"))
            .unionByName(rows_of(stay.where("count > 1")).dropDuplicates(["doc_id", "text"])))
