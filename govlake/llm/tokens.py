"""Token ids from tokenizer files, through a bounded memory of pieces already encoded.

The files are read by path on every executor; they are never trained or copied.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer

#: Pieces in each of the two generations a worker remembers; about 200 bytes each.
REMEMBERED = 500_000
#: Short pieces in the table that whole windows of text are looked up in, and ids it may hold.
SLOTS, HELD = 1 << 20, 1 << 22
#: Bytes of text after which a window is closed.
WINDOW = 1 << 20
#: Stands for the end of a document between pieces; no UTF-8 text holds this byte.
END = b"\xff"


@functools.lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes in order from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_LETTERS = byte_letters()
LETTERS = "".join(BYTE_LETTERS[b] for b in range(256))
#: Pieces whose normalisation and pre-tokens are plain to see: printable ASCII and Latin-1 letters.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
LATIN_WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
PLAIN_PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def latin(text: str) -> bool:
    """Whether all characters are in Latin-1. None of them combines with a neighbour, so lower-casing
    A-Z before the pieces are looked up changes no id, and spares a memory of each spelling."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def cut(data: np.ndarray, finely: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces between ASCII white space start and end; finely: cut also where a letter meets
    another ASCII character, as pre-tokens end there, but not after an apostrophe ('s, 'll)."""
    space = (data == 0x20) | (data - np.uint8(9) < 5)
    first, last = space[:-1] & ~space[1:], space[1:] & ~space[:-1]
    if finely:
        letter = (data | np.uint8(0x20)) - np.uint8(0x61) < 26
        other = (data < 0x80) & ~letter & ~space
        accented = (data >= 0x80) & (data != 0x97) & (data != 0xB7)  # after 0xC3: letters, but for two signs
        accented[1:] &= data[:-1] == 0xC3
        inside = (letter | accented)[:-1] & other[1:]
        inside |= (other & (data != 0x27))[:-1] & letter[1:]
        first |= inside
        last |= inside
    return np.flatnonzero(first) + 1, np.flatnonzero(last) + 1


class Short:
    """Pieces of up to 15 bytes -> where their ids are in a pool; a piece met later takes the place
    of another one with its slot. Whole pieces are compared, so none is taken for another."""

    MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
    MIX, TURN, SIZE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 29, 56))

    def __init__(self, dtype: np.dtype):
        self.head, self.tail = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.at, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.down = np.uint64(65 - SLOTS.bit_length())
        self.pool = np.zeros(0, dtype)

    def keys(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bytes 0 to 7, bytes 8 to 14 with the size (16: longer) above them, and the slot."""
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        head = eight[starts] & self.MASK.take(np.minimum(sizes, 8))
        tail = eight[starts + 8] & self.MASK.take(np.clip(sizes - 8, 0, 7))
        tail |= np.minimum(sizes, 16).astype(np.uint64) << self.SIZE
        slot = (head ^ (tail * self.MIX)) * self.MIX
        slot ^= slot >> self.TURN
        return head, tail, (slot * self.MIX >> self.down).view(np.int64)


class WordIds(dict):
    """Bytes between ASCII white space -> their ids as little-endian bytes.

    Holds for tokenizers that lower-case, compose and drop white space (their pre-tokens never
    span it, and neither normalisation nor added tokens look across it), so the ids of a text are
    the ids of its pieces in a row. Pre-tokens of plain pieces go straight to the merges; any other
    piece goes through the whole library.
    """

    def __init__(self, path: str, end_id: int):
        super().__init__()
        self.tokenizer = load(path)
        self.merge = self.tokenizer.model.tokenize
        self.end_id = end_id
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.old: dict[bytes, bytes] = {}
        self.short = Short(self.dtype)

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.kind, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def merged(self, word: bytes) -> bytes:
        return self.packed([t.id for t in self.merge(codecs.charmap_decode(word, "strict", LETTERS)[0])])

    def made(self, piece: bytes) -> bytes:
        if piece == END:
            return self.end
        if piece.isalpha() and len(piece) <= 64:  # ASCII letters alone are one pre-token
            return self.merged(piece) if piece.islower() else self[piece.lower()]
        if len(piece) <= 64 and LATIN_WORD.fullmatch(piece):
            return self.merged(piece)
        text = piece.decode()
        if len(text) > 64 or not PLAIN.fullmatch(text) or "<|" in text:
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        found = PLAIN_PRE_TOKEN.findall(text.lower())
        return self.merged(piece) if found == [text] else b"".join([self[w.encode()] for w in found])

    def __missing__(self, piece: bytes) -> bytes:
        """A piece not met lately; what the older generation knows moves to the newer one, so
        common pieces stay when the newer one is full and becomes the older."""
        out = self.old.get(piece)
        if out is None:
            out = self.made(piece)
        if len(piece) <= 256:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out

    def folded(self, text: str | None) -> bytes:
        text = text or ""
        raw = text.encode()
        return raw.lower() if "<|" not in text and latin(text) else raw

    def encode(self, text: str | None) -> bytes:
        """The ids of one whole document and its end id; a null text has the end id alone."""
        return b"".join(map(self.__getitem__, self.folded(text).split())) + self.end

    def windows(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of whole documents as `encode` has them, some documents at a time: all their ids
        in a row, and the number of each."""
        parts: list[bytes] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def closed() -> tuple[np.ndarray, np.ndarray]:
            held.append(self._looked_up(parts))
            before = np.cumsum([0] + [len(ids) for ids, _ in held[:-1]])
            ends = [ends + n for (_, ends), n in zip(held, before, strict=True)]
            return np.concatenate([ids for ids, _ in held]), np.diff(np.concatenate(ends), prepend=0)

        for text in texts:
            raw, at = self.folded(text), 0
            while len(raw) - at > 2 * WINDOW and (space := raw.find(b" ", at + WINDOW)) >= 0:
                held.append(self._looked_up([*parts, raw[at:space]]))
                parts, at = [], space
            parts += [raw[at:], END]
            size += len(raw)
            if size >= WINDOW:
                yield closed()
                parts, held, size = [], [], 0
        if parts:
            yield closed()

    def _looked_up(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts and END marks in a row, and the number of ids up to each mark."""
        whole = b"".join([b" ", b" ".join(parts), b" " * 17])
        data = np.frombuffer(whole, np.uint8)
        starts, ends = cut(data, b"<|" not in whole)
        sizes, short = ends - starts, self.short
        head, tail, slot = short.keys(data, starts, sizes)
        at, count = short.at.take(slot), short.count.take(slot)
        new = np.flatnonzero((short.head.take(slot) != head) | (short.tail.take(slot) != tail))
        if len(new):
            pieces = [whole[s:e] for s, e in zip(starts.take(new).tolist(), ends.take(new).tolist(), strict=True)]
            number = {piece: k for k, piece in enumerate(dict.fromkeys(pieces))}
            made = list(map(self.__getitem__, number))
            counts = np.array([len(m) for m in made]) // self.dtype.itemsize
            which = np.array([number[piece] for piece in pieces])
            count[new] = counts.take(which)
            at[new] = (len(short.pool) + counts.cumsum() - counts).take(which)
            short.pool = np.concatenate([short.pool, self.ids(b"".join(made))])
            kept = new[sizes.take(new) <= 15]
            for table, values in ((short.head, head), (short.tail, tail), (short.at, at), (short.count, count)):
                table[slot.take(kept)] = values.take(kept)
        upto = count.cumsum()
        places = np.repeat(at - upto + count, count)
        places += np.arange(len(places))
        ids = short.pool.take(places)
        if len(short.pool) > HELD:
            self.short = Short(self.dtype)
        return ids, upto[head == END[0]]

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.dtype)


@functools.lru_cache(maxsize=4)
def word_ids(path: str, end_id: int) -> WordIds:
    """One per worker process, kept between batches."""
    return WordIds(path, end_id)
