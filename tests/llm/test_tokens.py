"""Token counts, packing and token files against the library itself."""

import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from govlake.llm import coder, packing, token_counts, token_files, tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_counts_are_the_librarys(docs_of, prose):
    library = Tokenizer.from_file(BYTES)
    df = token_counts.document_counts(docs_of(enumerate(prose), extra=True), BYTES)
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    for r in df.collect():
        text = prose[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)


def test_pre_tokens_agree_on_every_sure_character():
    table = token_counts.costs(BYTES)
    letters = {v: k for k, v in tokens.BYTE_LETTERS.items()}
    sure = [chr(c) for c in range(0x110000)
            if not 0xD800 <= c < 0xE000 and not token_counts.UNSURE.search(chr(c))]
    text = "".join(f"a{c}1" for c in sure)
    pieces = [bytes(letters[x] for x in p).decode() for p, _ in table.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    assert pieces == token_counts.PRE_TOKEN.findall(text)


def test_proven_tokens_are_whole():
    table = token_counts.costs(BYTES)
    assert len(table.whole) > 40_000
    for piece in table.whole[::97]:
        assert len(table.tokenizer.encode(piece, add_special_tokens=False).ids) == 1


def test_small_memory_gives_the_same(monkeypatch, prose, word_library):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    coded = tokens.WordIds(WORDS, 1)
    for text in prose:
        assert coded.ids(coded.encode(text)).tolist() == ids_of(word_library, text)
        assert len(coded) <= 5


def odd_texts(n):
    """Texts in which pre-tokens, composition, added tokens and pieces of any size meet."""
    rng = np.random.default_rng(5)
    bits = ["a", "it", "s", "ll", "'", "''", "'s", "'LL", "'re", ".", ",.", "%%%", "1", "42", "é", "É", "ß", "Þ", "×", "÷",
            "ª", "µ", "º", "«", "\xa0", "\x85", "\x1c", "\0", "\x7f", " ", " ", " ", "\n", "\t", "<", "|", "(", "Word", "WORD",
            "fourteenletter", "sixteenlettersxy", "x" * 65, "y" * 260]
    more = ["H\u0331", "\u0331", "<\u0338", "e\u0301", "K", "İ", "Σ", "字", "🙂", "—", "<|endoftext|>", "<|ENDOFTEXT|>"]
    for i in range(n):
        yield "".join(rng.choice(bits + more * (i % 2), int(rng.integers(0, 40))).tolist())


@pytest.mark.parametrize(("slots", "held", "window"), [(1 << 20, 1 << 22, 1 << 20), (8, 1 << 22, 1), (64, 200, 500)])
def test_windows_are_the_librarys(monkeypatch, prose, word_library, slots, held, window):
    for name, value in (("SLOTS", slots), ("HELD", held), ("WINDOW", window)):
        monkeypatch.setattr(tokens, name, value)
    coded = tokens.WordIds(WORDS, 1)
    texts = [*prose, *odd_texts(1500), None, *prose]
    got = list(coded.windows(texts))
    ids = np.concatenate([x for x, _ in got])
    lengths = np.concatenate([x for _, x in got])
    want = [ids_of(word_library, t) for t in texts]
    assert lengths.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]
    assert [coded.ids(coded.encode(t)).tolist() for t in texts] == want
    assert list(coded.windows([])) == []


def test_forms_of_a_word_are_merged_once():
    """Each word goes through the merges once, whatever its case and the signs around it."""
    coded = tokens.WordIds(WORDS, 1)
    merge, merged = coded.merge, []
    coded.merge = lambda word: merged.append(word) or merge(word)
    list(coded.windows(["glorptang Glorptang, (GLORPTANG) glorptang. chßzußé Chßzußé!", "«glorptang» glorptang;glorptang"]))
    assert len(merged) == len(set(merged))
    assert sum("glorptang" in m for m in merged) == 1
    assert not any(b"glorptang," in piece for piece in coded)


def test_sorted_models_are_those_of_the_decoder():
    """The encoder's view of whole blocks against the slots that the decoder fills step by step."""
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.2, (5, 2048)), 60_000).astype(np.uint32)
    ids[:, ::5] = 0
    ids[1] = 7
    ids[2, 1000:] = ids[2, :1048]
    models, said = coder._Models(5), coder._said(ids)
    for t in range(2048):
        models.predict(5)
        hits = models.named == ids[:, t]
        assert (said[:, t] == (models.context << 2 | hits[1] * 2 | hits[0])).all()
        models.learn(5, ids[:, t])


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000, 140_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_407).astype(np.uint16)
    ids[n // 2:n // 2 + n // 4] = ids[:n // 4]
    lengths = [n // 3, 0, n - n // 3]
    data = coder.encode_segment(ids, [5, None, -3], lengths)
    back, names, sizes = coder.decode_segment(data)
    assert (back == ids).all() and names == [5, None, -3] and sizes.tolist() == lengths
    if n > 1000:
        assert len(data) < ids.nbytes


def test_coder_extremes():
    for ids in (np.full(9000, 7), np.arange(9000), np.array([2**28 - 1, 0, 2**28 - 1]), np.tile([3, 4], 4000)):
        back, _, _ = coder.decode_segment(coder.encode_segment(ids.astype(np.uint32), [1], [len(ids)]))
        assert (back == ids).all()


def test_coder_notices_damage():
    data = coder.encode_segment(np.arange(3000).astype(np.uint16) % 50, [1], [3000])
    for at in (0, 20, len(data) - 9):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises(coder.Damaged):
            coder.decode_segment(bytes(broken))
    with pytest.raises(coder.Damaged):
        coder.decode_segment(data[:-2])


def test_blocks_reset():
    """A changed block leaves the ids of the others."""
    ids = (np.arange(4000) * 7919 % 300).astype(np.uint16)
    other = ids.copy()
    other[:256] = ids[:256][::-1]  # same histogram
    a, b = (coder.decode_segment(coder.encode_segment(x, [1], [4000]))[0] for x in (ids, other))
    assert (a[256:] == b[256:]).all()


def test_files_read_back(spark, tmp_path, docs_of, prose, word_library):
    rows = [(i * 3, t) for i, t in enumerate(prose)] + [(None, "no id"), (None, None), (6, prose[2])]
    place = str(tmp_path / "ids")
    token_files.write(docs_of(rows, extra=True), place, WORDS)
    got = token_files.read(spark, place, with_ids=True).orderBy("start").collect()
    assert len(got) == len(rows)
    names = [r.doc_id for r in got]
    assert names == sorted(names, key=lambda d: (d is not None, d or 0))
    want = sorted((d is not None, d or 0, ids_of(word_library, t)) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), crc(r.ids))
        at += r.n_tokens


def test_files_of_nothing(spark, tmp_path, docs_of):
    place = str(tmp_path / "none")
    token_files.write(docs_of([]), place, WORDS)
    assert token_files.read(spark, place).collect() == []


def test_packing_is_whole_and_tight(docs_of, prose, word_library):
    rows = list(enumerate(prose)) + [(None, "no id"), (3, prose[3])]
    got = packing.pack(docs_of(rows, extra=True), WORDS, limit=256).collect()
    wanted = {}
    for d, t in rows:
        wanted.setdefault(d, []).append(ids_of(word_library, t))
    pieces = {}
    for r in got:
        ids = next(x for x in wanted[r.doc_id] if len(x) == r.doc_tokens
                   and crc(x[r.start:r.start + r.length]) == r.ids_crc32)
        pieces.setdefault((r.doc_id, r.doc_tokens), []).extend(range(r.start, r.start + r.length))
        assert len(ids[r.start:r.start + r.length]) == r.length > 0
    for (d, n), places in pieces.items():
        copies = sum(len(x) == n for x in wanted[d])
        assert sorted(places) == sorted(list(range(n)) * copies)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256 and at & (at - 1) == 0  # no padding: full, or a power of two


def test_packing_nothing(docs_of):
    assert packing.pack(docs_of([]), WORDS).collect() == []


def test_hilbert_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = packing.hilbert(grid, 3)
    assert sorted(place) == list(range(512))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
