"""Fingerprints and edited texts against a plain version."""

import hashlib
import re

import pytest

from govlake.llm import spotsigs


def plain_set(text, common):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content = [w for w in words if w not in common]
    out, before = set(), 0
    if words:
        out.add(("^", *content[:3]))
    for w in words:
        if w in common:
            out.add((w, *content[before:before + 3]))
        else:
            before += 1
    return out


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    texts = [t or "" for _, t in rows]
    for i, (d, _) in enumerate(rows):
        nxt, own = texts[(i + 1) % len(rows)], texts[i]
        half = len(own) // 2
        yield d, own, nxt, own[:len(own) - half] + nxt[:half]


def test_pairs(docs_of, prose):
    texts = [t for t in prose if t is None or not re.search("[^\x00-ӿ]", t)]
    rows = [(i * 2, t) for i, t in enumerate(texts)]
    docs = docs_of(rows, extra=True)
    common = set(spotsigs.anchors(docs, 12))
    got = {r.doc_id: r for r in spotsigs.edited_pairs(docs, 12).collect()}
    assert len(got) == len(rows)
    for d, own, nxt, changed in edited(rows):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
        a, b, c = (plain_set(t, common) for t in (own, changed, nxt))
        assert len(r.fingerprint) == 8 * len(a) and len(r.edited_fingerprint) == 8 * len(b)
        assert r.near_edited == pytest.approx(alike(a, b)) and r.near_next == pytest.approx(alike(a, c))
    prints = {}
    for d, t in rows:
        assert prints.setdefault(t, got[d].fingerprint) == got[d].fingerprint


def test_repeated_and_null_rows(docs_of):
    rows = [(3, "the one of three words"), (3, "the one of three words"), (None, "no id"), (None, None), (1, "and last")]
    got = spotsigs.edited_pairs(docs_of(rows)).collect()
    assert len(got) == 5 and len({tuple(r) for r in got if r.doc_id == 3}) == 1
    assert {r.n_chars for r in got if r.doc_id is None} == {0, 5}
    alone = spotsigs.edited_pairs(docs_of([(9, "just this one")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert spotsigs.edited_pairs(docs_of([])).collect() == []


def test_pruning_and_partitions(spark):
    a, b = list(range(10)), list(range(8))
    df = spark.createDataFrame([(a, b), (a, a), (a, [1]), ([], []), ([], a)], "a array<int>, b array<int>")
    rows = df.select(spotsigs.likeness(df.a, df.b).alias("x"), spotsigs.likeness(df.a, df.b, 0.5).alias("y")).collect()
    assert [r.x for r in rows] == [0.8, 1.0, 0.1, 1.0, 0.0]
    assert [r.y for r in rows] == [0.8, 1.0, 0.0, 1.0, 0.0]
    sizes = spark.range(1, 400).selectExpr("cast(id as int) as n")
    part = {r.n: r.p for r in sizes.select("n", spotsigs.length_part(sizes.n, 0.8).alias("p")).collect()}
    assert all(abs(part[n] - part[m]) <= 1 for n in part for m in part if m >= n >= 0.8 * m)


def test_every_language_has_anchors(spark):
    rows = [(i, " ".join(f"en{c} stone{i}{c}" for c in "abcdefghij"), "en") for i in range(40)]
    rows += [(100 + i, " ".join(f"de{c} stein{i}{c}" for c in "abcdefghij"), "de") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {f"{x}{c}" for x in ("en", "de") for c in "abcdefghij"} == set(spotsigs.anchors(docs, 10))
    assert len(spotsigs.anchors(docs.drop("lang"), 10)) == 10
    sizes = {r.doc_id: len(r.fingerprint) // 8 for r in spotsigs.edited_pairs(docs, 10).collect()}
    assert set(sizes.values()) == {11}


def test_anchors_are_bounded_whatever_stands_in_lang(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "LANGUAGES", 3)
    rows = [(i, f"w{i % 50} common", f"lang{i}") for i in range(200)] + [(1000 + i, "der und", "de") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = spotsigs.anchors(docs, 4)
    assert len(found) <= 4 * 4 and {"der", "und", "commo"} & set(found) == {"der", "und"}
