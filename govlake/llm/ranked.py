"""Ranked lexical search over bit-sliced Bloom signatures.

The index is a table of blocks. A block has up to ROWS rows, one or several to a document, so that
no row has much more than FULL terms and long documents do not fill their signatures: a term's
hash says which of its document's rows it is in. For each of BITS positions a block has a slice, the
bitmap of the rows that set that position. A term sets HASHES positions, and again, under other
hashes, for every power of two up to its occurrences. The slices of a term, and-ed, are a bitmap of
the rows that may hold the term so often: it may name too many, never too few. So the weighted sum
over an item's terms of the most they can add is an upper bound of each document's score, made for
a whole block at a time.

The documents of highest bounds are scored exactly first, which gives each item a score to beat.
Then every document whose bound reaches it is scored exactly; all others are proven too low.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, folder, text_of

TOP = 50
BITS, HASHES = 8192, 2
#: Terms of a row, about; a document has a power of two of rows.
FULL = 512
#: Occurrences that have positions of their own: 1, 2, 4, 8, ...
LEVELS = 8
#: A block is closed at so many rows or bytes of text.
ROWS, TEXT_BYTES = 1024, 4 << 20
#: Words of items that are searched together; more items mean more passes over the index.
BATCH_WORDS = 50_000
_REMEMBERED = 200_000
#: ASCII letters and digits stay (A-Z in lower case), all other ASCII parts terms; others stay.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).translate(
    bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
_BLOCK = ("part int, number long, docs int, doc_ids array<long>, lengths binary, most binary, rows binary, slices binary, "
          "texts array<binary>, held binary")


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, with repeats, as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


class _Hashes(dict):
    """Term -> its 64-bit hash; a bounded memory."""

    def __missing__(self, term: bytes) -> int:
        made = xxhash.xxh64_intdigest(term)
        if len(term) <= 64:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[term] = made
        return made


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    return _Hashes()


def positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """HASHES positions of terms at a level, from their hashes."""
    with np.errstate(over="ignore"):
        x = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
    return np.stack([(x >> np.uint64(20 * k)) % np.uint64(bits) for k in range(HASHES)], axis=-1).astype(np.int64)


def rows_of(kinds: int, full: int) -> int:
    """Rows of a document with so many different terms."""
    return 1 << max(0, (kinds - 1) // full).bit_length()


class Block:
    """The documents of a block while they are gathered."""

    def __init__(self, bits: int, full: int):
        self.bits, self.full = bits, full
        self.ids: list = []
        self.texts: list[bytes] = []
        self.lengths: list[int] = []
        self.most: list[int] = []
        self.rows: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.filled = self.size = 0

    def add(self, name, raw: bytes, counts: Counter) -> None:
        known = _hashes()
        self.ids.append(name)
        self.texts.append(raw)
        self.hashes.append(np.fromiter(map(known.__getitem__, counts), np.uint64, len(counts)))
        self.times.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.lengths.append(counts.total())
        self.most.append(int(self.times[-1].max()))
        self.rows.append(rows_of(len(counts), self.full))
        self.filled += self.rows[-1]
        self.size += len(raw)

    def slices(self) -> np.ndarray:
        """Per position the bitmap of the rows that set it."""
        rows = np.array(self.rows, np.int64)
        n = [len(h) for h in self.hashes]
        hashes, times = np.concatenate(self.hashes), np.concatenate(self.times)
        row = np.repeat(np.cumsum(rows) - rows, n) + (hashes & np.repeat(rows - 1, n).astype(np.uint64)).astype(np.int64)
        set_ = np.zeros((self.bits, self.filled), bool)
        for level in range(LEVELS):
            often = times >= 1 << level
            for at in positions(hashes[often], level, self.bits).T:
                set_[at, row[often]] = True
        return np.packbits(set_, axis=1, bitorder="little")


def _blocks(wanted: list[bytes], bits: int, rows: int, full: int):
    """Documents -> blocks of the index. `held` counts, for each wanted term, the documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: k for k, t in enumerate(wanted)}
        asked = frozenset(wanted)
        part, number = TaskContext.get().partitionId(), 0
        now, held = Block(bits, full), np.zeros(len(wanted), np.int64)

        def closed() -> pa.RecordBatch:
            nonlocal number, now
            numbers = (np.array(x, np.int64) for x in (now.lengths, now.most, now.rows))
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number]), pa.array([len(now.ids)], pa.int32()),
                 pa.array([now.ids], pa.list_(pa.int64())),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (*numbers, now.slices())),
                 pa.array([now.texts], pa.list_(pa.binary())), pa.array([held.tobytes()], pa.binary())],
                ["part", "number", "docs", "doc_ids", "lengths", "most", "rows", "slices", "texts", "held"])
            number, now = number + 1, Block(bits, full)
            held[:] = 0
            return out

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = (text.as_py() or "").encode()
                counts = Counter(raw.translate(_FOLD).split())
                if not counts:
                    continue  # a document without terms is no document of the statistics and has no score
                found = [place[t] for t in asked.intersection(counts)]
                held[found] += 1
                now.add(name, raw, counts)
                if now.filled >= rows or now.size >= TEXT_BYTES:
                    yield closed()
        if now.ids:
            yield closed()

    return run


def damping(n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """m of documents with n terms."""
    return 100 - 50 + (50 * n * docs) // max(1, words)


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What tf occurrences add, before the weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


class Query:
    """Items as lists of places in a common list of terms with their weights."""

    def __init__(self, names: list, words: list[list[bytes]], known: list[bytes], weights: np.ndarray,
                 docs: int, total: int, bits: int = BITS):
        place = {t: k for k, t in enumerate(known)}
        self.names = names
        self.items = [np.array(sorted(place[t] for t in w), np.int64) for w in words]
        self.known, self.weights, self.docs, self.total, self.bits = known, weights, docs, total, bits

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(t) for t in self.known], np.uint64)

    @functools.cached_property
    def places(self) -> np.ndarray:
        """Positions of each term at each level: LEVELS x terms x HASHES."""
        return np.array([positions(self.hashes, k, self.bits) for k in range(LEVELS)])

    @functools.cached_property
    def holding(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The items of each term: all in a row, where each term's start, and how many they are."""
        flat = np.concatenate([*self.items, np.zeros(0, np.int64)])
        item = np.repeat(np.arange(len(self.items)), [len(x) for x in self.items])
        count = np.bincount(flat, minlength=len(self.known))
        return item[np.argsort(flat, kind="stable")], np.cumsum(count) - count, count

    def bounds(self, lengths: np.ndarray, most: np.ndarray, rows: np.ndarray, slices: np.ndarray) -> np.ndarray:
        """An upper bound of each item's score in each document of a block: items x docs."""
        slices = slices.reshape(self.bits, -1)
        docs, m = len(lengths), damping(lengths, self.docs, self.total)
        # at level k a term occurs less than 2^(k+1) times, and never more than the document's most
        adds = np.array([saturation(np.minimum(most, 2**(k + 1) - 1) if k < LEVELS - 1 else most, m)
                         for k in range(LEVELS)])
        doc_of, start = np.repeat(np.arange(docs), rows), np.cumsum(rows) - rows
        out = np.zeros(len(self.items) * docs)
        item, first, count = self.holding
        for at in range(0, len(self.known), 4096):
            some = slices[self.places[0, at:at + 4096, 0]]
            for k in range(1, HASHES):
                some = some & slices[self.places[0, at:at + 4096, k]]
            t, row = np.nonzero(np.unpackbits(some, axis=1, count=int(rows.sum()), bitorder="little"))
            t += at
            doc = doc_of[row]
            # a term is in one row of its document only
            own = (self.hashes[t] & (rows[doc] - 1).astype(np.uint64)).astype(np.int64) == row - start[doc]
            t, row, doc = t[own], row[own], doc[own]
            level, left = np.zeros(len(t), np.int64), np.arange(len(t))
            for k in range(1, LEVELS):
                more = np.ones(len(left), bool)
                for j in range(HASHES):
                    r = row[left]
                    more &= (slices[self.places[k, t[left], j], r >> 3] >> (r & 7).astype(np.uint8) & 1).astype(bool)
                left = left[more]
                level[left] = k
            value = (adds[level, doc] * self.weights[t]).astype(np.float64)  # sums stay far below 2^53
            n = count[t]
            of = np.repeat(first[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out += np.bincount(item[of] * docs + np.repeat(doc, n), weights=np.repeat(value, n), minlength=len(out))
        return out.reshape(-1, docs).astype(np.int64)

    def scores(self, raw: bytes, items: np.ndarray) -> np.ndarray:
        """Exact scores of some items in one document."""
        counts = Counter(raw.translate(_FOLD).split())
        m = int(damping(np.int64(counts.total()), self.docs, self.total))
        out = []
        for i in items.tolist():
            total = 0
            for t in self.items[i].tolist():
                tf = counts.get(self.known[t])
                if tf:
                    total += int(self.weights[t]) * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            out.append(total)
        return np.array(out, np.int64)


def _block_bounds(query: Query, row: dict) -> np.ndarray:
    return query.bounds(*(np.frombuffer(row[c], np.int64) for c in ("lengths", "most", "rows")),
                        np.frombuffer(row["slices"], np.uint8))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time as Python values, its texts still in Arrow."""
    for batch in batches:
        plain = [c for c in batch.schema.names if c != "texts"]
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in plain}
            if "texts" in batch.schema.names:
                row["texts"] = batch.column("texts")[k].values
            yield row


def _likely(query: Query, top: int):
    """Blocks -> for each item the documents of highest bounds in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = _block_bounds(query, row)
            k = min(top, found.shape[1])
            at = np.argpartition(found, found.shape[1] - k, axis=1)[:, found.shape[1] - k:]
            item = np.repeat(np.arange(len(found)), k)
            at = at.reshape(-1)
            value = found[item, at]
            some = value > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(item[some], pa.int32()), pa.array(value[some]), pa.array(np.full(some.sum(), row["part"]), pa.int32()),
                 pa.array(np.full(some.sum(), row["number"]), pa.int64()), pa.array(at[some], pa.int32())],
                ["item", "bound", "part", "number", "at"])

    return run


def _first(query: Query):
    """Blocks with the (item, at) pairs chosen from them -> exact scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            by_doc: dict[int, list[int]] = {}
            for pair in row["pairs"]:
                by_doc.setdefault(pair["at"], []).append(pair["item"])
            for at, items in by_doc.items():
                items = np.array(items)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int32()), pa.array(query.scores(row["texts"][at].as_py(), items))],
                    ["item", "score"])

    return run


def _reaching(query: Query, beat: np.ndarray):
    """Blocks -> exact scores of all documents that the bounds do not exclude, of those that reach the
    score to beat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hit = _block_bounds(query, row) >= beat[:, None]
            item, name, score = [], [], []
            for at in np.flatnonzero(hit.any(axis=0)).tolist():
                items = np.flatnonzero(hit[:, at])
                found = query.scores(row["texts"][at].as_py(), items)
                good = found >= beat[items]
                item += items[good].tolist()
                score += found[good].tolist()
                name += [row["doc_ids"][at]] * int(good.sum())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(name, pa.int64()),
                                              pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return run


def _batches(items: DataFrame, words: int) -> list[DataFrame]:
    """Items dealt to as many parts as keep each at about `words` words, by a hash of the item. An
    item counts as 20 words at least, so their number is bounded too."""
    sized = items.select("item_id", text_of().alias("text"), (F.length(text_of()) / 4 + 20).alias("words"))
    total = sized.agg(F.sum("words")).first()[0] or 0
    parts = max(1, math.ceil(total / words))
    return [sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) for k in range(parts)]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, path: str | None = None, bits: int = BITS,
           rows: int = ROWS, full: int = FULL, batch_words: int = BATCH_WORDS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's `top` documents by score, ties by doc_id.

    Null and empty texts have no terms, are not counted and score nothing; items without terms give
    no rows, and so do empty tables. A null doc_id comes last among equal scores. Repeated rows of
    documents are ranked each; rows of items that share item_id and text are one item, and several
    texts under one item_id are ranked apart, in the order of their hashes. Items are searched in
    parts of `batch_words` words, which is what the driver gathers and tasks are sent.
    """
    spark = docs.sparkSession
    path = path or folder(spark, "signatures")
    out = None
    for k, part in enumerate(_batches(items.select("item_id", "text").distinct(), batch_words)):
        asked = sorted(((r.item_id, sorted(set(terms(r.text))), xxhash.xxh64_intdigest(r.text)) for r in part.collect()),
                       key=lambda r: (r[0] is None, r[0] or 0, r[2]))
        asked = [r for r in asked if r[1]]
        found = _searched(docs, asked, top, f"{path}/{k}", bits, rows, full)
        out = found if out is None else out.unionByName(found)
    return out


def _searched(docs: DataFrame, asked: list[tuple], top: int, path: str, bits: int, rows: int,
              full: int) -> DataFrame:
    spark = docs.sparkSession
    known = sorted({t for _, words, _ in asked for t in words})
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
     .mapInArrow(_blocks(known, bits, rows, full), _BLOCK).write.option("parquet.block.size", 16 << 20)
     .option("parquet.block.size.row.check.min", 1).option("parquet.page.size.row.check.min", 1).parquet(path))
    index = spark.read.parquet(path)

    # document frequencies of the asked terms, added up in tasks
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, numbers = np.zeros(len(known), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for raw, n, lengths in zip(*(batch.column(c).to_pylist() for c in ("held", "docs", "lengths")), strict=True):
                held += np.frombuffer(raw, np.int64)
                numbers += (n, int(np.frombuffer(lengths, np.int64).sum()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(known))), pa.array(np.r_[numbers, held])],
                                         ["term", "n"])

    sums = dict(index.select("held", "docs", "lengths").mapInArrow(added, "term long, n long")
                .groupBy("term").agg(F.sum("n")).collect())
    n_docs, total = sums.get(-2, 0), sums.get(-1, 0)
    weights = np.array([weight(n_docs, sums.get(k, 0)) for k in range(len(known))], np.int64)
    query = Query([r[0] for r in asked], [r[1] for r in asked], known, weights, n_docs, total, bits)

    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "part", "number", "at")
    likely = (index.select("part", "number", "lengths", "most", "rows", "slices")
              .mapInArrow(_likely(query, 2 * top), "item int, bound long, part int, number long, at int")
              .withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= 2 * top))
    pairs = likely.groupBy("part", "number").agg(F.collect_list(F.struct("item", "at")).alias("pairs"))
    # at most 2 * `top` pairs for each item of the part, so the side that is sent is bounded
    first = (index.select("part", "number", "texts").join(F.broadcast(pairs), ["part", "number"])
             .select("texts", "pairs").mapInArrow(_first(query), "item int, score long"))
    ahead = Window.partitionBy("item").orderBy(F.desc("score"))
    beat = np.ones(len(asked), np.int64)
    for r in first.withColumn("place", F.row_number().over(ahead)).where(F.col("place") == top).collect():
        beat[r.item] = max(1, r.score)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = (index.select("doc_ids", "lengths", "most", "rows", "slices", "texts")
              .mapInArrow(_reaching(query, beat), "item int, doc_id long, score long")
              .withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top))
    names = spark.createDataFrame([(k, n) for k, n in enumerate(query.names)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
