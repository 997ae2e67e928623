"""Ranked search against every document scored in plain Python, and what the bounds leave out."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from govlake.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items, top=50):
    split = [(d, Counter(TERM.findall((t or "").translate(FOLD)))) for d, t in rows]
    split = [(d, c) for d, c in split if c]
    n_docs, total = len(split), sum(c.total() for _, c in split)
    out = []
    for item, text in items:
        wanted = set(TERM.findall((text or "").translate(FOLD)))
        scored = []
        for d, c in split:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            s = 0
            for t in wanted & c.keys():
                df = sum(t in x for _, x in split)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (
                    1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    df = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in ranked.search(docs, df, **kw).collect()), key=repr)


@pytest.fixture(scope="module")
def asked(prose):
    rnd = random.Random(3)
    items = [(k, " ".join(rnd.sample((prose[k] or "x").split() or ["x"], min(12, len((prose[k] or "x").split()) or 1))))
             for k in range(0, 60, 7)]
    return [*items, (100, None), (101, ""), (102, "The THE the"), (103, "数字と文字 12 🙂 nothing_else"), (104, "zzz qqq"),
            (105, "ß İ Ǆ x\x00y")]


@pytest.mark.parametrize("top", [50, 3])
def test_equals_every_document_scored(spark, docs_of, prose, asked, top):
    rows = [*enumerate(prose), (None, "no id ha nd"), (None, None), (500, prose[3]), (7, prose[7])]
    assert found(spark, docs_of(rows, extra=True), asked, top=top) == brute(rows, asked, top)


def test_small_signatures_and_blocks_change_nothing(spark, docs_of, prose, asked):
    rows = list(enumerate(prose))
    assert found(spark, docs_of(rows), asked, top=5, bits=64, rows=7, full=20) == brute(rows, asked, 5)


def test_items_in_parts(spark, docs_of, prose, asked):
    rows = list(enumerate(prose))
    assert found(spark, docs_of(rows), asked, top=4, batch_words=60) == brute(rows, asked, 4)


def test_many_ties(spark, docs_of):
    rows = [(k, "same words here") for k in range(300, 0, -1)] + [(1000, "other")]
    items = [(1, "words"), (2, "other same")]
    assert found(spark, docs_of(rows), items) == brute(rows, items)


def test_empty_tables(spark, docs_of, asked):
    assert found(spark, docs_of([]), asked) == []
    assert found(spark, docs_of([(1, "a b")]), []) == []
    assert found(spark, docs_of([(1, None), (2, " ")]), asked) == []


def test_bounds_hold_and_exclude():
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rnd.choices(words, weights=[1 / (k + 1) for k in range(3000)], k=rnd.randint(20, 400)))
             for _ in range(600)]
    texts = [t.encode() for t in texts]
    counts = [Counter(t.split()) for t in texts]
    block = ranked.Block(ranked.BITS, 100)
    for k, c in enumerate(counts):
        block.add(k, texts[k], c)
    assert set(block.rows) == {1, 2, 4}
    known = sorted({w for c in counts for w in c})
    weights = np.array([ranked.weight(600, sum(w in c for c in counts)) for w in known], np.int64)
    items = [sorted({w.encode() for w in rnd.choices(words, k=15)} & set(known)) for _ in range(20)]
    query = ranked.Query(list(range(20)), items, known, weights, 600, sum(block.lengths))
    bound = query.bounds(*(np.array(x) for x in (block.lengths, block.most, block.rows)), block.slices())
    exact = np.array([query.scores(t, np.arange(20)) for t in texts]).T
    assert (bound >= exact).all()
    beat = np.sort(exact, axis=1)[:, -10]
    left = (bound >= beat[:, None]).sum(axis=1)
    assert left.mean() < 30
