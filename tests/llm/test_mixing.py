"""The mix against targets written out, and the tree against draws without replacement."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from govlake.llm import mixing

KIND = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, part int, number int"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 3, "r", "s", 1, 2) for d, t, s in rows], KIND)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def wanted(rows):
    """Targets by sharing again and again what is over the limit."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size_of(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if each[s] > 2 * sizes[s]]
        if not over:
            return sizes, full | each
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    made = [(k, " ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.choice([3, 20, 300, 900]))),
             rnd.choice(["hot"] * 4 + ["b", "Z", "é", "𝔘", None, "tiny"])) for k in range(160)]
    return [*made, (500, None, "b"), (501, "", "void"), (502, "a\x1cb\x85 c\x0bd", "tiny"), (None, "x y z", None), *made[:3], *made[:1]]


def test_words_near_targets_and_no_document_twice_over(spark, rows):
    got = mixing.report(table(spark, rows)).collect()
    sizes, target = wanted(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, size_of(t)) for d, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    by_size = defaultdict(list)
    for r in got:
        by_size[r.source_size, round(r.target, 6)].append(r.taken)
    assert {k[0] for k in by_size} == set(sizes.values())
    for s, n in sizes.items():
        assert by_size[n, round(target[s], 6)] and abs(sum(by_size[n, round(target[s], 6)]) - target[s]) <= .5
    again = mixing.report(table(spark, rows[::-1]).repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


@pytest.mark.parametrize("bundles", [256, 2])
def test_shards_are_disjoint_and_alike(spark, rows, bundles):
    of = mixing.sized(table(spark, rows))
    sources, pieces = mixing.mix(of, block=16, shard=40, bundles=bundles)
    got = pieces.collect()
    assert len({(r.row, r.copy, r.block) for r in got}) == len(got)
    shards = Counter(r.shard for r in got)
    k = 2 ** math.ceil(math.log2(len(got) / 40))
    assert set(shards) == set(range(k)) and max(shards.values()) - min(shards.values()) <= 1
    target = {r.number: r.target for r in sources.collect()}
    words = Counter()
    for r in got:
        words[r.number] += r.words
    assert all(abs(words[n] - t) <= .5 for n, t in target.items())
    # every shard has about its share of the largest source
    big, n = Counter(r.number for r in got).most_common(1)[0]
    share = n / len(got)
    for s, size in shards.items():
        own = sum(r.shard == s and r.number == big for r in got)
        assert abs(own - size * share) < 6 * math.sqrt(size * share * (1 - share)) + 1
    assert len({(r.shard, r.place) for r in got}) == len(got)


def test_the_mix_itself(spark, rows):
    docs = table(spark, rows)
    of = mixing.sized(docs)
    _, pieces = mixing.mix(of, block=16, shard=40)
    made = mixing.in_shards(docs, pieces, of, 16).collect()
    taken = {(r.doc_id, r.taken) for r in mixing.report(docs, block=16, shard=40).where("taken > 0").collect()}
    words = Counter()
    for r in made:
        words[r.doc_id] += len(r.text.split(" "))
    single = {d for d, n in Counter(d for d, *_ in rows).items() if n == 1}
    assert {(d, n) for d, n in words.items() if d in single} == {x for x in taken if x[0] in single}


def inverse(own, rest, draws, u):
    total = math.comb(rest, draws)
    acc = 0.0
    for x in range(max(0, draws - (rest - own)), min(draws, own) + 1):
        acc += math.comb(own, x) * math.comb(rest - own, draws - x) / total
        if acc >= u:
            return x


def test_draws_are_hypergeometric(spark):
    rnd = random.Random(1)
    asked = []
    for _ in range(200):
        rest = rnd.choice([1, 5, 40, 900])
        asked.append((rnd.randint(0, rest), rest, rnd.randint(0, rest), rnd.random() * .998 + .001))
    df = spark.createDataFrame(asked, "own long, rest long, draws long, u double")
    got = df.select("*", mixing.drawn(F.col("own"), F.col("rest"), F.col("draws"), F.col("u")).alias("x")).collect()
    assert [r.x for r in got] == [inverse(*a) for a in asked]
    large = spark.createDataFrame([(10**9, 3 * 10**9, 10**9 + 7, .5)], "own long, rest long, draws long, u double")
    x = large.select(mixing.drawn(*(F.col(c) for c in large.columns))).first()[0]
    assert abs(x - (10**9 + 7) / 3) < 50_000


def test_the_tree_keeps_quotas(spark):
    rnd = random.Random(2)
    quotas = {b: rnd.choice([0, 1, 7, 500, 3000]) for b in range(30)}
    df = spark.createDataFrame(list(quotas.items()), "bundle int, blocks long")
    got = mixing.shards(df, 5).collect()
    for b, n in quotas.items():
        own = sorted((r.start, r.blocks) for r in got if r.bundle == b)
        assert [s for s, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
        assert sum(x for _, x in own) == n
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.blocks
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_empty_and_wordless(spark):
    assert mixing.report(table(spark, [])).collect() == []
    got = mixing.report(table(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
