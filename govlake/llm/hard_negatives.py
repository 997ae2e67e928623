"""Hard negatives from candidate blocks in Hilbert order, chosen by their zone maps.

Vectors are range-sorted by label and by their place on a Hilbert curve and written as Parquet
rows of up to CHUNK vectors of one label. Each has a zone map: the least and the greatest value of
every dimension in each of its blocks of BLOCK vectors. Interval arithmetic over a zone map bounds
the scores that an anchor can have in the block; only chunks with a block whose bounds meet a wanted
interval are read, and in them only such blocks are scored. The anchors of one chunk form a group,
which is the unit that is sent to chunks.

First each group looks at its own chunk, which gives a fifth best score to beat; then at the other
chunks of its label that may beat it; then, with the positives' scores known, at the chunks of other
labels that may hold something in a window. Results are exact whatever the bounds leave out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import cells, hilbert
from .shared import cut, folder, partitions

CHUNK, BLOCK = 4096, 128
#: Anchors in a group, at most; a chunk may have several groups.
GROUP = 512
#: Blocks whose zone maps are looked at together.
SHEET = 1024
#: Sheets whose names may be broadcast; beyond, the join shuffles.
BROADCAST_SHEETS = 1_000_000
DIMENSIONS, DEPTH = 6, 8
POSITIVES, NEGATIVES = 5, 3
EVERY = 50
_PARTS = -(-CHUNK // GROUP)
_TOP, _LOW = 2**63 - 1, -(2**63)
_NONE = np.zeros(0, np.int64)
_GROUP = "grp long, dim int, label long, anchors binary, vectors binary, r binary, ids binary, scores binary"


def _binary(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays]


@functools.lru_cache(maxsize=64)
def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(1891 + dim).choice([-1.0, 1.0], (dim, DIMENSIONS))


def places(vectors: np.ndarray) -> np.ndarray:
    """Place of each vector's direction on a Hilbert curve, the same at every corpus."""
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    points = vectors @ _directions(vectors.shape[1]) / np.where(norm > 0, norm, 1)
    return hilbert(cells(points) >> (16 - DEPTH), DEPTH)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; beyond 64 bits the nearest 64-bit number."""
    largest = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    wide = [np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, b)]
    found = np.array([[int(np.dot(x, y)) if len(x) else 0 for y in wide[1]] for x in wide[0]], object)
    return np.array([[min(max(v, _LOW), _TOP) for v in row] for row in found], np.int64).reshape(len(a), len(b))


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each row of `a` can have in each zone, a little wider than
    exact so that rounding never leaves a vector out."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T * 2.0**-40
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def windows(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative: 50 p <= 100 s <= 95 p."""
    return -(-positive // 2), positive // 20 * 19 + positive % 20 * 19 // 20


def best(r: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each r, by score from the highest, ties by smaller id."""
    order = np.lexsort((ids, ~score, r))
    own = r[order]
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else _NONE
    rank = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
    return order[rank < k]


def _highest(score: np.ndarray, ids: np.ndarray, wanted: np.ndarray, rows: np.ndarray, k: int):
    """The first k of the wanted entries of each row of a score matrix, as (r, ids, scores)."""
    masked = np.where(wanted, score, _LOW)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, -k]
        wanted = wanted & (masked >= least[:, None])
    i, j = np.nonzero(wanted)
    found = rows[i], ids[j], score[i, j]
    keep = best(*found, k)
    return tuple(x[keep] for x in found)


# --- the blocks ---------------------------------------------------------------------------------

def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding, label) of rows that take part -> whole-numbered vectors with their place."""
    for batch in batches:
        ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        lists = batch.column("embedding")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
        dims = lists.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(dims) - dims
        place, vectors = np.zeros(len(ids), np.int64), [b""] * len(ids)
        good = np.zeros(len(ids), bool)
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            x = np.floor(256 * flat[start[own, None] + np.arange(dim)])
            good[own] = fine = np.isfinite(x).all(axis=1)
            own, x = own[fine], x[fine]
            place[own] = places(x)
            for k, v in zip(own.tolist(), x, strict=True):
                vectors[k] = v.tobytes()
        moved = np.where(labels == _TOP, 8, np.fmod(labels + (labels < _TOP), 10))
        labels = np.where(np.fmod(ids, 7) == 0, moved, labels)
        ids, labels, dims, place = (x[good] for x in (ids, labels, dims, place))
        vectors = [v for v, g in zip(vectors, good.tolist(), strict=True) if g]
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims, pa.int32()), pa.array(labels, pa.int64()), pa.array(place), pa.array(ids, pa.int64()),
             pa.array(vectors, pa.binary())], ["dim", "label", "place", "vec_id", "vector"])


def _chunks(size: int, block: int):
    """Vectors in order -> chunks of one dimension and label, with zone maps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held_key, held_ids, held = None, [], []

        def closed() -> pa.RecordBatch:
            nonlocal number, held_ids, held
            x = np.frombuffer(b"".join(held)).reshape(len(held), held_key[0])
            starts = np.arange(0, len(x), block)
            low, high = (f.reduceat(x, starts, axis=0) if x.shape[1] else np.zeros((len(starts), 0))
                         for f in (np.minimum, np.maximum))
            out = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([held_key[0]], pa.int32()), pa.array([held_key[1]]),
                 pa.array([len(starts)], pa.int32()), pa.array([block], pa.int32()),
                 *_binary(np.array(held_ids, np.int64), x, low, high)],
                ["chunk", "dim", "label", "blocks", "block", "ids", "vectors", "low", "high"])
            number, held_ids, held = number + 1, [], []
            return out

        for batch in batches:
            for dim, label, i, v in zip(batch.column("dim").to_pylist(), batch.column("label").to_pylist(),
                                        batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                if held and (held_key != (dim, label) or len(held) >= size):
                    yield closed()
                held_key = (dim, label)
                held_ids.append(i)
                held.append(v.as_buffer())
        if held:
            yield closed()

    return run


def write_blocks(embeddings: DataFrame, path: str, size: int = CHUNK, block: int = BLOCK) -> None:
    """The candidate blocks of a table as Parquet, one row per chunk.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part.
    Rows that share a vec_id are one: the one of the least label and vector. Other columns are not
    read.
    """
    spark = embeddings.sparkSession
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding",
                              F.col("label").cast("long").alias("label"))
            .where("vec_id is not null and embedding is not null and label is not null"))
    made = cut(rows.mapInArrow(_cleaned, "dim int, label long, place long, vec_id long, vector binary"))
    if not made.groupBy("vec_id").count().where("count > 1").isEmpty():
        made = (made.groupBy("vec_id").agg(F.min(F.struct("dim", "label", "place", "vector")).alias("of"))
                .select("of.dim", "of.label", "of.place", "vec_id", "of.vector"))
    order = ["dim", "label", "place", "vec_id"]
    (made.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
     .mapInArrow(_chunks(min(size, CHUNK), block), "chunk long, dim int, label long, blocks int, block int, ids binary, "
                                                 "vectors binary, low binary, high binary")
     .write.parquet(path))


def _sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps of chunks -> sheets of the zone maps of several chunks of one dimension and label."""
    held: dict[tuple[int, int], list] = {}
    number = TaskContext.get().partitionId() << 32

    def closed(key) -> pa.RecordBatch:
        nonlocal number
        rows = held.pop(key)
        number += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([key[0]], pa.int32()), pa.array([key[1]]),
             *_binary(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int64)),
             pa.array([b"".join(r[2] for r in rows)], pa.binary()), pa.array([b"".join(r[3] for r in rows)], pa.binary())],
            ["sheet", "dim", "sheet_label", "chunks", "sizes", "low", "high"])

    for batch in batches:
        for row in batch.to_pylist():
            key = (row["dim"], row["label"])
            held.setdefault(key, []).append((row["chunk"], row["blocks"], row["low"], row["high"]))
            if sum(r[1] for r in held[key]) >= SHEET:
                yield closed(key)
    for key in list(held):
        yield closed(key)


# --- anchors and chunks -------------------------------------------------------------------------

def _array(row: dict, name: str, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(row[name], dtype)


def _vectors(row: dict, name: str, n: int) -> np.ndarray:
    """`n` vectors, also of no dimension."""
    return np.frombuffer(row[name]).reshape(n, row["dim"])


def _wanted(row: dict, n: int, how: str) -> tuple[np.ndarray, np.ndarray]:
    """Interval of scores that each anchor (and each of its positives) of a group looks for, as two
    arrays of n x width; an empty interval has its ends the wrong way round."""
    r, found = _array(row, "r"), _array(row, "scores")
    if how == "positives":
        low = np.full((n, 1), _LOW, np.int64)
        full = np.bincount(r, minlength=n) >= POSITIVES
        worst = np.full(n, _TOP, np.int64)
        np.minimum.at(worst, r, found)
        low[full, 0] = worst[full]
        return low, np.full((n, 1), _TOP, np.int64)
    low, high = np.full((n, POSITIVES), 1, np.int64), np.zeros((n, POSITIVES), np.int64)
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    low[r, rank], high[r, rank] = windows(found)
    return low, high


def _meets(a: np.ndarray, low: np.ndarray, high: np.ndarray, wanted) -> np.ndarray:
    """Which anchors may find something they want in which zones."""
    least, most = bounds(a, low, high)
    hit = np.zeros(least.shape, bool)
    for w in range(wanted[0].shape[1]):
        start, end = wanted[0][:, w, None], wanted[1][:, w, None]
        hit |= (most >= start.astype(np.float64) * (1 - 1e-15 * np.sign(start))) & (
            least <= end.astype(np.float64) * (1 + 1e-15 * np.sign(end))) & (start <= end)
    return hit


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks -> the group of anchors of each, with the best of their own chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = _array(row, "ids")
            x = _vectors(row, "vectors", len(ids))
            every = np.flatnonzero(ids % EVERY == 0)
            for part, first in enumerate(range(0, len(every), GROUP)):
                at = every[first:first + GROUP]
                found = _highest(scores(x[at], x), ids, ids[None, :] != ids[at, None], np.arange(len(at)), POSITIVES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"] * _PARTS + part]), pa.array([row["dim"]], pa.int32()),
                     pa.array([row["label"]]), *_binary(ids[at], x[at], *found)],
                    ["grp", "dim", "label", "anchors", "vectors", "r", "ids", "scores"])


def _asked(batches: Iterator[pa.RecordBatch], held: list[str]) -> Iterator[dict]:
    """Rows in the order of key and kind -> each asking row (kind 1) with the `held` columns of the row
    of kind 0 before it, which is sent once however many ask."""
    now: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                now = {c: row[c] for c in held}
            else:
                yield row | now


def _beside(payload: DataFrame, asking: DataFrame, key: str) -> DataFrame:
    """Both relations in one, each key's payload before those that ask for it."""
    def wide(df: DataFrame, other: DataFrame, kind: int) -> DataFrame:
        missing = [F.lit(None).cast(t).alias(c) for c, t in other.dtypes if c not in df.columns]
        return df.select("*", *missing, F.lit(kind).alias("kind"))

    both = wide(payload, asking, 0).unionByName(wide(asking, payload, 1))
    return both.repartition(partitions(payload.sparkSession), key).sortWithinPartitions(key, "kind")


def _chosen(how: str):
    """Groups behind sheets -> the chunks that each group has to read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _asked(batches, ["chunks", "sizes", "low", "high"]):
            n, dim = len(_array(row, "anchors")), row["dim"]
            chunks, sizes = _array(row, "chunks"), _array(row, "sizes")
            zones = [np.frombuffer(row[c]).reshape(int(sizes.sum()), dim) for c in ("low", "high")]
            hit = _meets(_vectors(row, "vectors", n), *zones, _wanted(row, n, how)).any(axis=0)
            read = np.logical_or.reduceat(hit, np.cumsum(sizes) - sizes)
            if how == "positives":
                read &= chunks != row["grp"] // _PARTS
            yield pa.RecordBatch.from_arrays([pa.array(np.full(read.sum(), row["grp"])), pa.array(chunks[read])],
                                             ["grp", "chunk"])

    return run


def _scored(how: str):
    """Groups behind the chunks they read -> the best of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _asked(batches, ["blocks", "block", "c_ids", "c_vectors", "low", "high"]):
            n, dim = len(_array(row, "anchors")), row["dim"]
            a, wanted = _vectors(row, "vectors", n), _wanted(row, n, how)
            ids = _array(row, "c_ids")
            x = np.frombuffer(row["c_vectors"]).reshape(len(ids), dim)
            zones = [np.frombuffer(row[c]).reshape(row["blocks"], dim) for c in ("low", "high")]
            hit = _meets(a, *zones, wanted)
            need, block = np.flatnonzero(hit.any(axis=1)), np.repeat(hit.any(axis=0), row["block"])[:len(ids)]
            made = scores(a[need], x[block])
            parts = [_highest(made, ids[block], (made >= wanted[0][need, w, None]) & (made <= wanted[1][need, w, None]),
                              need * wanted[0].shape[1] + w, POSITIVES if how == "positives" else NEGATIVES)
                     for w in range(wanted[0].shape[1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["grp"]]), *_binary(*(np.concatenate(p) for p in zip(*parts, strict=True)))],
                ["grp", "r", "ids", "scores"])

    return run


def _merged(k: int):
    """Parts of results in the order of their groups -> one result per group; only the best are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, (_NONE,) * 3

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), *_binary(*held)], ["grp", "r", "ids", "scores"])

        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["grp"] != now:
                    yield closed()
                    held = (_NONE,) * 3
                now = row["grp"]
                both = [np.concatenate([h, _array(row, c)]) for h, c in zip(held, ("r", "ids", "scores"), strict=True)]
                keep = best(*both, k)
                held = tuple(x[keep] for x in both)
        if now is not None:
            yield closed()

    return run


def _searched(groups: DataFrame, chunks: DataFrame, sheets: DataFrame, how: str, k: int) -> DataFrame:
    """The merged results (grp, r, ids, scores) of the chunks that each group has to read."""
    spark = groups.sparkSession
    body = groups.select("grp", "dim", "label", "anchors", "vectors", "r", "scores")
    names = sheets.select("sheet", F.col("dim").alias("sheet_dim"), "sheet_label")
    # each group meets the sheets of its dimension: the stated anchors against zone maps, not rows
    names = F.broadcast(names) if sheets.count() <= BROADCAST_SHEETS else names
    asking = body.join(names, (body["dim"] == names["sheet_dim"])
                       & ((body["label"] == names["sheet_label"]) if how == "positives"
                          else (body["label"] != names["sheet_label"]))).drop("sheet_dim", "sheet_label", "label")
    pairs = cut(_beside(sheets.select("sheet", "chunks", "sizes", "low", "high"), asking, "sheet")
                .mapInArrow(_chosen(how), "grp long, chunk long"))
    read = (chunks.select("chunk", "blocks", "block", F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"),
                          "low", "high").join(pairs.select("chunk").distinct(), "chunk", "left_semi"))
    parts = (_beside(read, pairs.join(body.drop("label"), "grp"), "chunk")
             .mapInArrow(_scored(how), "grp long, r binary, ids binary, scores binary"))
    if how == "positives":
        parts = parts.unionByName(groups.select("grp", "r", "ids", "scores"))
    return (parts.repartition(partitions(spark), "grp").sortWithinPartitions("grp")
            .mapInArrow(_merged(k), "grp long, r binary, ids binary, scores binary"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            anchors, r, ids, score = (_array(row, c) for c in ("anchors", "r", "ids", "scores"))
            first = np.searchsorted(r, np.arange(len(anchors)))
            n_r, n_ids, n_score = (_array(row, c) for c in ("n_r", "n_ids", "n_scores"))
            anchor, which = np.divmod(n_r, POSITIVES)
            of = first[anchor] + which
            rank = np.arange(len(n_r)) - np.searchsorted(n_r, n_r) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[anchor]), pa.array(ids[of]), pa.array(rank, pa.int32()), pa.array(n_ids),
                 pa.array(score[of]), pa.array(n_score)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def mine(embeddings: DataFrame, path: str | None = None, size: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by EVERY. A label grows by one modulo 10 first
    where vec_id is divisible by 7; components become floor(256 x). Positives are the first
    POSITIVES other rows of the anchor's label by integer inner product, negatives of a positive the
    first NEGATIVES rows of other labels whose score is at least half and at most 95 % of the
    positive's; ties go to the smaller vec_id. Vectors of another length than the anchor's are
    never compared with it. See `write_blocks` for nulls and repeated rows; an empty table, anchors
    without positives and windows without rows give no rows.
    """
    spark = embeddings.sparkSession
    path = path or folder(spark, "vector-blocks")
    write_blocks(embeddings, path, size, block)
    chunks = spark.read.parquet(path)
    sheets = cut(chunks.select("chunk", "dim", "label", "blocks", "low", "high").mapInArrow(
        _sheets, "sheet long, dim int, sheet_label long, chunks binary, sizes binary, low binary, high binary"))
    groups = cut(chunks.select("chunk", "dim", "label", "ids", "vectors").mapInArrow(_own, _GROUP))
    found = _searched(groups, chunks, sheets, "positives", POSITIVES)
    groups = cut(groups.drop("r", "ids", "scores").join(found, "grp"))
    negatives = _searched(groups, chunks, sheets, "negatives", NEGATIVES).select(
        "grp", *(F.col(c).alias(f"n_{c}") for c in ("r", "ids", "scores")))
    return (groups.select("grp", "anchors", "r", "ids", "scores").join(negatives, "grp")
            .select("anchors", "r", "ids", "scores", "n_r", "n_ids", "n_scores")
            .mapInArrow(_rows, "anchor_id long, positive_id long, rank int, negative_id long, "
                               "positive_score long, negative_score long"))
