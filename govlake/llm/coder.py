"""A context-mixing range coder for token ids, in independently reset and checksummed blocks.

For each id three models speak. Order 2 and order 1 name the id that followed the last two ids, or
the last one, before in this block, with a confidence that grows with hits and starts anew after a miss;
order 0 is the histogram of the segment. Their distributions are mixed linearly, with shares by the
two confidences and whether both name the same id; the shares are fitted to the segment. The mixed
distribution drives a carry-propagating range coder.

Blocks start with empty models and a fresh coder, so each can be decoded and checked alone with the
segment's header. Blocks of a segment advance together, one id per step, each as one lane of the
numpy arrays; all arithmetic is on integers, so every machine decodes alike.

Segment, little-endian: magic, version, header length, header CRC-32, header (zlib), then the
16-bit words of the blocks. The header holds the counts, document ids and lengths, the histogram,
the shares, and per block its number of words and the CRC-32 of its ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION = b"GVTK", 2
BLOCK = 2048
#: A short segment has shorter blocks, so that many still advance together.
LANES, SHORTEST = 512, 256
_HEAD = struct.Struct("<4sHII")
_COUNTS = struct.Struct("<QQIIQ")
_U = np.uint64
_LEAST, _WORD, _UPPER = _U(1 << 48), _U(16), _U(48)
_BITS0 = 20
#: An interval is in parts of 2^36 of the range: a share of 2^16, and of that one of order 0's 2^20.
_PARTS, _ORDER0 = _U(36), _U(_BITS0)
_SLOTS1, _SLOTS2 = 512, 2048
_TO1, _TO2, _SPREAD = np.uint32(23), np.uint32(21), np.uint32(2_654_435_761)
#: Steps whose intervals are computed at once.
_AHEAD = 64
#: Lanes whose models are computed at once.
_ABREAST = 64


class Damaged(ValueError):
    """A segment or block does not match its checksum."""


class _Models:
    """What each lane has learnt: slots of id * 8 + confidence, order 1 (row 0) before order 2 (row 1)."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype=np.int64)
        self.at = np.stack([lane * _SLOTS1, lanes * _SLOTS1 + lane * _SLOTS2])
        self.table = np.zeros(lanes * (_SLOTS1 + _SLOTS2), np.uint32)
        self.key = np.zeros((2, lanes), np.uint32)
        self.before = np.zeros(lanes, np.uint32)

    def predict(self, k: int) -> None:
        """For the first k lanes: slots, named ids, confidences and the context of the mix."""
        self.slot = self.at[:, :k] + self.key[:, :k]
        self.entry = self.table.take(self.slot)
        self.named, self.trust = self.entry >> 3, self.entry & 7
        self.context = self.trust[1] << 4 | self.trust[0] << 1 | (self.named[0] == self.named[1])

    def learn(self, k: int, ids: np.ndarray) -> None:
        self.table[self.slot] = np.where(self.named == ids, self.entry + (self.trust < 7), ids << 3 | 1)
        spread = ids * _SPREAD
        self.key[0, :k] = spread >> _TO1
        self.key[1, :k] = (spread + self.before[:k]) >> _TO2
        self.before[:k] = spread * np.uint32(3)


def _in_slots(slots: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """What `_Models` names at each id of whole blocks (rows), times 16, plus twice its confidence, plus 1
    where it is right: sorted by slot and step, each id follows the one that its slot names."""
    block = ids.shape[1]
    step = np.arange(block, dtype=np.uint32)
    order = slots * np.uint32(BLOCK) | step
    order.sort(axis=1)
    at = (order & np.uint32(BLOCK - 1)) + np.arange(0, ids.size, block)[:, None]
    same = (order[:, 1:] ^ order[:, :-1]) < BLOCK
    met, named, missed = ids.reshape(-1).take(at), np.zeros_like(ids), np.zeros(ids.shape, np.uint16)
    named[:, 1:] = met[:, :-1] * same
    hit = named == met
    np.multiply(~(hit[:, 1:] & same), step[1:].astype(np.uint16), out=missed[:, 1:])
    run = step.astype(np.uint16) - np.maximum.accumulate(missed, axis=1)
    trust = (np.minimum(run, 6) + np.uint16(1)) << 1
    said = named << 4 | hit
    said[:, 1:] |= trust[:, :-1] * same
    out = np.empty_like(said)
    out.reshape(-1)[at] = said
    return out


def _said(ids: np.ndarray) -> np.ndarray:
    """For each id of whole blocks (rows): the context of the mix * 4, and which orders name the id."""
    spread = ids * _SPREAD
    slots1, slots2 = np.zeros_like(ids), np.zeros_like(ids)
    slots1[:, 1:] = spread[:, :-1] >> _TO1
    slots2[:, 1:] = spread[:, :-1]
    slots2[:, 2:] += spread[:, :-2] * np.uint32(3)
    one, two = _in_slots(slots1, ids), _in_slots(slots2 >> _TO2, ids)
    context = (two & 14) << 3 | one & 14 | ((one ^ two) < 16)
    return context << 2 | (two & 1) << 1 | one & 1


def _histogram(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a segment and their shares of 2^20, each at least 1."""
    counts = np.bincount(ids)
    known = np.flatnonzero(counts)
    share = np.maximum(1, counts[known] * ((1 << _BITS0) - len(known)) // max(1, len(ids)))
    if len(known):
        share[int(share.argmax())] += (1 << _BITS0) - int(share.sum())
    return known, share


def _by_id(known: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = int(known[-1]) + 1 if len(known) else 1
    freq, start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
    freq[known] = share
    start[known] = np.cumsum(share) - share
    return freq, start


def _shares(seen: np.ndarray) -> np.ndarray:
    """Of 2^16, by context: the share of what order 2 names, and of what only order 1 names. At least
    32 are left for order 0, so an id takes 11 + 20 bits at most: two words."""
    seen = seen + 1
    part = np.maximum(16, seen[:, :2] * (65_536 - 64) // seen.sum(axis=1, keepdims=True))
    return part.astype("<u2")


def _intervals(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By context * 4 and which orders named the id (2: order 2, 1: order 1), in parts of 2^36: where
    its interval begins, how wide it is, and the share by which order 0 moves and widens it."""
    share2, share1 = part[:, 0].astype(np.uint64), part[:, 1].astype(np.uint64)
    none, rest = np.zeros_like(share2), _U(1 << 16) - share2 - share1
    begin = np.stack([share2 + share1, share2, none, none], axis=1) << _ORDER0
    wide = np.stack([none, share1, share2, share2], axis=1) << _ORDER0
    more = np.stack([rest, none, none, none], axis=1)
    return begin.reshape(-1), wide.reshape(-1), more.reshape(-1)


def encode_segment(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    n = len(ids)
    block = int(min(BLOCK, max(SHORTEST, n // LANES)))
    lanes = -(-n // block)
    last = n - (lanes - 1) * block
    known, share = _histogram(ids)
    freq0, start0 = _by_id(known, share)
    blocks = np.zeros((lanes, block), np.uint32)
    blocks.reshape(-1)[:n] = ids
    active = [lanes if t < last else lanes - 1 for t in range(block)] if lanes else []
    active = active[:active.index(0)] if 0 in active else active

    # what the models say does not depend on the mix, so they go first and the mix is fitted
    said = np.zeros((block, lanes), np.uint16)
    for i in range(0, lanes, _ABREAST):
        said[:, i:i + _ABREAST] = _said(blocks[i:i + _ABREAST]).T
    said[last:, lanes - 1:] = 0
    seen = np.bincount(said.reshape(-1), minlength=512)
    seen[0] -= said.size - n
    part = _shares(np.stack([seen[2::4] + seen[3::4], seen[1::4], seen[0::4]], axis=1))
    steps = np.ascontiguousarray(blocks.T)
    begin, wide, more = _intervals(part)

    words = np.zeros((lanes, 2 * block + 8), np.int32)
    flat, row = words.reshape(-1), np.arange(lanes, dtype=np.int64) * words.shape[1]
    pos = row.copy()
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, _U(2**64 - 1))
    for t, k in enumerate(active):
        ahead = t % _AHEAD
        if not ahead:
            x, c = steps[t:t + _AHEAD], said[t:t + _AHEAD]
            rest = more.take(c)
            starts = begin.take(c) + rest * start0.take(x)
            widths = wide.take(c) + rest * freq0.take(x)
        r = rng[:k] >> _PARTS
        add = r * starts[ahead, :k]
        low[:k] += add
        over = np.flatnonzero(low[:k] < add)
        if len(over):
            flat[pos.take(over) - 1] += 1
        rng[:k] = r * widths[ahead, :k]
        # every lane writes a word, and those that are done with it go on to the next
        slim = rng < _LEAST
        flat[pos] = low >> _UPPER
        pos += slim
        shift = slim * _WORD
        low <<= shift
        rng <<= shift
        slim = np.flatnonzero(rng < _LEAST)
        while len(slim):
            at, x, room = pos.take(slim), low.take(slim), rng.take(slim) << _WORD
            flat[at] = x >> _UPPER
            pos[slim] = at + 1
            low[slim] = x << _WORD
            rng[slim] = room
            slim = slim[room < _LEAST]
    # one word names a number inside the last range, as that is at least 2^48 wide
    end = (low >> _UPPER) + ((low & (_LEAST - _U(1))) > 0)
    over = end > _U(0xFFFF)
    flat[pos[over] - 1] += 1
    flat[pos] = end & _U(0xFFFF)
    sizes = pos - row + 1
    longest = int(sizes.max()) if lanes else 0
    over = np.flatnonzero(flat > 0xFFFF)
    while len(over):
        carry = flat.take(over) >> 16
        flat[over] &= 0xFFFF
        over -= 1
        flat[over] += carry
        over = over[flat.take(over) > 0xFFFF]
    words = words[:, :longest]
    body = words[np.arange(longest)[None, :] < sizes[:, None]].astype("<u2").tobytes()
    raw = np.ascontiguousarray(ids, "<u4")
    sums = np.array([zlib.crc32(raw[i * block:(i + 1) * block]) for i in range(lanes)], "<u4")
    missing = np.array([d is None for d in doc_ids], np.uint8)
    head = zlib.compress(b"".join([
        _COUNTS.pack(n, len(doc_ids), block, lanes, len(known)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), missing.tobytes(),
        np.array(lengths, "<u8").tobytes(), known.astype("<u4").tobytes(), share.astype("<u4").tobytes(),
        part.tobytes(), sizes.astype("<u4").tobytes(), sums.tobytes()]), 1)
    return _HEAD.pack(MAGIC, VERSION, len(head), zlib.crc32(head)) + head + body


def decode_segment(data: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """Ids, document ids and document lengths; raises Damaged where a checksum fails."""
    if len(data) < _HEAD.size:
        raise Damaged("not a segment")
    magic, version, size, check = _HEAD.unpack_from(data)
    packed = data[_HEAD.size:_HEAD.size + size]
    if magic != MAGIC or version != VERSION or zlib.crc32(packed) != check:
        raise Damaged("not a segment, or its header is damaged")
    head = zlib.decompress(packed)
    n, docs, block, lanes, kinds = _COUNTS.unpack_from(head)
    at = _COUNTS.size

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(head, dtype, count, at)
        at += out.nbytes
        return out

    names, missing, lengths = take("<i8", docs), take("u1", docs), take("<u8", docs)
    known, share = take("<u4", kinds).astype(np.int64), take("<u4", kinds).astype(np.int64)
    part = take("<u2", 256).reshape(128, 2)
    share2, share12 = part[:, 0].astype(np.uint64) << _ORDER0, part.sum(axis=1, dtype=np.uint64) << _ORDER0
    rest = (_U(1 << 36) - share12) >> _ORDER0
    sizes, sums = take("<u4", lanes).astype(np.int64), take("<u4", lanes)
    stored = np.frombuffer(data, "<u2", offset=_HEAD.size + size)
    if len(stored) != sizes.sum():
        raise Damaged("a segment is cut off")
    # each lane is followed by the zeros its coder reads past its end
    words = np.zeros(len(stored) + 4 * lanes + 8, np.uint16)
    begin = np.cumsum(sizes + 4) - (sizes + 4)
    words[np.arange(len(stored)) + np.repeat(4 * np.arange(lanes), sizes)] = stored
    freq0, start0 = _by_id(known, share)
    by_share = np.repeat(known.astype("<u2" if len(known) and known[-1] < 1 << 16 else "<u4"), share)
    models = _Models(lanes)
    code = np.zeros(lanes, np.uint64)
    for j in range(4):
        code = code << _WORD | words[begin + j]
    pos = begin + 4
    rng = np.full(lanes, _U(2**64 - 1))
    steps = np.zeros((block, lanes), np.uint32)
    last = n - (lanes - 1) * block
    for t in range(block if lanes else 0):
        k = lanes if t < last else lanes - 1
        if not k:
            break
        models.predict(k)
        r = rng[:k] >> _PARTS
        value, upto, more = code[:k] // r, share12.take(models.context), rest.take(models.context)
        # as if order 0 had named every id; the few others are put right
        place = ((value - upto) // more).view(np.int64) & ((1 << _BITS0) - 1)
        now = by_share.take(place).astype(np.uint32)
        start, wide = upto + more * start0.take(now), more * freq0.take(now)
        few = np.flatnonzero(value < upto)
        first, both = share2.take(models.context.take(few)), upto.take(few)
        two = value.take(few) < first
        now[few] = np.where(two, models.named[1].take(few), models.named[0].take(few))
        start[few] = np.where(two, _U(0), first)
        wide[few] = np.where(two, first, both - first)
        code[:k] -= r * start
        rng[:k] = r * wide
        slim = rng < _LEAST
        shift = slim * _WORD
        rng <<= shift
        code <<= shift
        code |= words.take(pos, mode="clip") * slim
        pos += slim
        slim = np.flatnonzero(rng < _LEAST)
        while len(slim):
            at, wide = pos.take(slim), rng.take(slim) << _WORD
            code[slim] = code.take(slim) << _WORD | words.take(at, mode="clip")
            pos[slim] = at + 1
            rng[slim] = wide
            slim = slim[wide < _LEAST]
        steps[t, :k] = now
        models.learn(k, now)
    ids = np.ascontiguousarray(steps.T).reshape(-1)[:n].astype("<u4")
    for i in range(lanes):
        if zlib.crc32(ids[i * block:(i + 1) * block]) != sums[i]:
            raise Damaged(f"block {i} does not match its checksum")
    return ids, [None if m else int(d) for d, m in zip(names, missing, strict=True)], lengths.astype(np.int64)
