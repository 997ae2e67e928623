"""Hard negatives against every pair written out, and what the zone maps may leave out."""

import math
import random

import numpy as np
import pytest

from govlake.llm import hard_negatives as hn

KIND = "vec_id long, embedding array<float>, label int, rank int, grp string, ids long"


def brute(rows):
    """The definition, over Python numbers."""
    clean = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = int(math.fmod(y + 1, 10)) if i % 7 == 0 else y
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        clean[i] = min(clean.get(i, (len(q), y, q)), (len(q), y, q), key=lambda r: r[:2])
    out = []
    for a, (n, y, q) in clean.items():
        if a % 50:
            continue
        scored = sorted((-sum(s * t for s, t in zip(q, r, strict=True)), i, z) for i, (m, z, r) in clean.items()
                        if m == n and i != a)
        for p, j, _ in [s for s in scored if s[2] == y][:5]:
            near = [(s, i) for s, i, z in scored if z != y and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, j, k + 1, i, -p, -s) for k, (s, i) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 7, "x", 8) for r in rows], KIND)
    return sorted(tuple(r) for r in hn.mine(df, **kw).collect())


def vectors(n, dim, seed, clusters=5, spread=.2):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(clusters, dim)) / math.sqrt(dim)
    x = centres[rnd.integers(0, clusters, n)] + rnd.normal(size=(n, dim)) * spread / math.sqrt(dim)
    return [(int(i) * 5, x[i].tolist(), int(rnd.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize(("dim", "clusters", "spread"), [(8, 5, .2), (3, 2, .01), (16, 300, 1.)])
def test_equals_every_pair(spark, dim, clusters, spread):
    rows = vectors(600, dim, dim, clusters, spread)
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows, size=64, block=16) == want


def test_odd_rows(spark):
    rows = vectors(150, 4, 3)
    rows += [(1000, None, 1), (None, [1., 2., 3., 4.], 1), (1050, [1., None, 2., 3.], 1), (1100, [1., math.nan, 2., 3.], 0),
             (1150, [math.inf, 0., 0., 0.], 0), (1200, [1., 2., 3., 4.], None), (1250, [], 1), (1300, [], 1), (1301, [], 2),
             (1350, [.5, .25], 1), (1351, [.5, .25], 1), (1352, [.3, .2], 2), (1353, [.3, .2], 3), rows[10], rows[10],
             (rows[20][0], rows[20][1], 9), (-50, rows[3][1], 1), (-7, rows[3][1], -5)]
    assert mined(spark, rows) == brute(rows)


def test_one_vector_many_times_and_ties(spark):
    rows = [(i, [.5, .5, .25], 0) for i in range(1, 300)] + [(i, [.4, .4, .2], 1) for i in range(300, 500)]
    assert mined(spark, rows, size=32, block=8) == brute(rows)


def test_huge_components(spark):
    rows = [(50, [3e9, 1.], 1), (51, [2e9, 1.], 1), (52, [1e9, 5.], 2), (53, [1.6e9, 5.], 2), (54, [1e30, 0.], 1)]
    got = mined(spark, rows)
    assert all(p <= 2**63 - 1 and n <= 2**63 - 1 for *_, p, n in got)
    small = [(50, [3e6, 1.], 1), (51, [2e6, 1.], 1), (52, [1e6, 5.], 2), (53, [1.6e6, 5.], 2)]
    assert mined(spark, small) == brute(small)


def test_empty_table(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.], 1)]) == []


def test_bounds_hold_and_leave_blocks_out():
    rnd = np.random.default_rng(5)
    a = np.floor(rnd.normal(size=(20, 6)) * 100)
    blocks = [np.floor(rnd.normal(size=6) * 200 + rnd.normal(size=(40, 6)) * 10) for _ in range(30)]
    low, high = np.array([b.min(axis=0) for b in blocks]), np.array([b.max(axis=0) for b in blocks])
    least, most = hn.bounds(a, low, high)
    for j, b in enumerate(blocks):
        s = a @ b.T
        assert (least[:, j] <= s.min(axis=1)).all() and (s.max(axis=1) <= most[:, j]).all()
    best = np.sort(most, axis=1)[:, -5]
    assert (most < best[:, None]).mean() > .5


def test_near_blocks_only_are_read(spark):
    """With clusters the zone maps leave most chunks unread."""
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(4. * (i % 40 == k), .05) for k in range(40)], 1) for i in range(2560)]
    path = hn.folder(spark, "blocks")
    hn.write_blocks(spark.createDataFrame([(*r, 7, "x", 8) for r in rows], KIND), path, 64, 32)
    chunks = spark.read.parquet(path).toPandas()
    a = np.floor(256 * np.array(rows[0][1], np.float32).astype(float))[None, :]
    low, high = (np.concatenate([np.frombuffer(v).reshape(-1, 40) for v in chunks[c]]) for c in ("low", "high"))
    _, most = hn.bounds(a, low, high)
    x = np.concatenate([np.frombuffer(v).reshape(-1, 40) for v in chunks["vectors"]])
    fifth = np.sort((x @ a.T)[:, 0])[-6]
    assert (most[0] >= fifth).mean() < .25


def test_places_keep_neighbours_together():
    rnd = np.random.default_rng(9)
    x = np.repeat(rnd.normal(size=(20, 16)), 50, axis=0) + rnd.normal(size=(1000, 16)) * .02
    order = np.argsort(hn.places(x), kind="stable")
    assert (order[1:] // 50 == order[:-1] // 50).mean() > .9


def test_scores_take_random_rows():
    rnd = random.Random(2)
    a, b = (np.array([[rnd.randrange(-2**40, 2**40) for _ in range(5)] for _ in range(4)], float) for _ in "ab")
    want = [[max(min(sum(int(s) * int(t) for s, t in zip(x, y, strict=True)), 2**63 - 1), -2**63) for y in b] for x in a]
    assert hn.scores(a, b).tolist() == want
