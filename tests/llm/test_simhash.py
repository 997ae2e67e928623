"""Fingerprints, covering tables, links and groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from govlake.llm import components, simhash


def plain_fingerprint(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    k = min(words, len(found))
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i:i + k]), 42) for i in range(len(found) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, near):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("radius", [1, 2, 4, 6])
def test_masks_cover_the_radius(radius):
    rnd = random.Random(radius)
    for free in (2**64 - 1, 0x5555_0F0F_3333_FFFF, 0xFF):
        places = [i for i in range(64) if free >> i & 1]
        masks = [int(m) for m in simhash.masks(radius, free)]
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(300):
            differ = sum(1 << p for p in rnd.sample(places, min(radius, len(places))))
            assert any(m & differ == 0 for m in masks)
    assert min(int(m).bit_count() for m in simhash.masks(radius)) >= 32


def test_fingerprints(prose):
    for t in prose:
        assert simhash.fingerprint_of(t) == plain_fingerprint(t)


def test_classes_are_those_of_all_pairs(docs_of, prose):
    rows = list(enumerate(prose, start=100)) + [(None, prose[0]), (7, "")]
    got = simhash.report(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    group = groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (d, _), g in zip(rows, group, strict=True):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    want = sorted((str(d), f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, group, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("cell", [4096, 16])
def test_dense_clusters_through_small_cells(spark, cell):
    rnd = random.Random(3)
    values = set()
    for n in (400, 60, 12):
        centre = rnd.getrandbits(64)
        while n:
            v = centre
            for p in rnd.sample(range(64), rnd.randint(0, 4)):
                v ^= 1 << p
            n -= v not in values
            values.add(v)
    values |= {rnd.getrandbits(64) for _ in range(200)}
    values = list(values)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, cell)
    roots = dict(components.components(links).collect())
    group = groups(values, lambda a, b: (a ^ b).bit_count() <= 4)
    seen = {}
    for v, g in zip(signed, group, strict=True):
        assert seen.setdefault(g, roots.get(v, v)) == roots.get(v, v)
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(9)
    ids = [rnd.randint(-2**63, 2**63 - 1) for _ in range(120)]
    pairs = {"path": list(zip(ids, ids[1:], strict=False)), "star": [(ids[0], x) for x in ids[1:]],
             "random": [tuple(rnd.sample(ids, 2)) for _ in range(70)], "none": []}[shape]
    df = spark.createDataFrame([*pairs, *pairs[:3], (ids[5], ids[5]), (None, ids[1])], "a long, b long")
    got = dict(components.components(df).collect())
    linked = {frozenset(p) for p in pairs}
    nodes = sorted({x for p in pairs for x in p})
    group = groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert set(got) == set(nodes)
    assert len({(g, got[n]) for n, g in zip(nodes, group, strict=True)}) == len(set(group)) == len(set(got.values()))


def test_plans_do_not_grow_with_rounds(spark, monkeypatch):
    rnd = random.Random(5)
    ids = [rnd.randint(-2**63, 2**63 - 1) for _ in range(400)]
    rounds = []
    monkeypatch.setattr(components, "kept", lambda df, keep=components.kept: rounds.append(df) or keep(df))
    roots = components.components(spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long"))
    assert len(rounds) > 12  # over five rounds
    for df in [*rounds, roots]:
        plan = df._jdf.queryExecution().optimizedPlan()
        assert plan.stats().sizeInBytes().bit_length() < 400
        assert plan.toString().count("Join") <= components.JOINS
    found = dict(roots.collect())
    assert set(found) == set(ids) and len(set(found.values())) == 1


def test_one_of_each_group_stays(docs_of, prose):
    rows = list(enumerate(prose, start=1)) + [(None, "no id at all here"), (None, prose[1]), (5, prose[4])]
    docs = docs_of(rows, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    found = simhash.classes(docs).select("doc_id", "text_hash", "root", "component_id").collect()
    assert len(got) == len({r.root for r in found})
    assert sum(d is None for d, _ in got) == 1 and (5, prose[4]) in got
    copies = {t for t in prose if prose.count(t) > 1}
    assert all(sum(t == c for _, t in got) <= 1 for c in copies)
    assert simhash.keep_one(docs_of([])).collect() == []


def test_empty_table(docs_of):
    assert simhash.report(docs_of([])).collect() == []


def test_near_copies_are_found(docs_of, prose):
    long = [t for t in prose if t and len(t.split()) > 60][:8]
    rows = []
    for i, t in enumerate(long):
        words = t.split()
        words[20] = "edited"
        rows += [(i, t), (100 + i, " ".join(words))]
    kept = {r.doc_id for r in simhash.keep_one(docs_of(rows)).select(F.col("doc_id")).collect()}
    prints = [simhash.fingerprint_of(t) for _, t in rows]
    least = {}
    for (d, _), g in zip(rows, groups(prints, lambda a, b: (a ^ b).bit_count() <= 4), strict=True):
        least[g] = min(d, least.get(g, d))
    assert kept == set(least.values())
