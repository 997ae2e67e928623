"""Fixpoints, access of members, revenue deltas, the lattice and digests against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from support import rows
from govlake.design import ALL_USERS, OWNERS
from govlake.operators import access, anonymize, evolve, gold, graph, lineage, tags
from govlake.principal import Principal


def walked(edges, start):
    """Least hops and whether a shortest path keeps the name, by breadth-first search."""
    out = {}
    for origin, first in start:
        known, level, hops = {first: True}, {first: True}, 0
        for o, f in start:
            if o == origin:
                known[f] = True
                level[f] = True
        while level:
            hops += 1
            new = {}
            for a, b, same in edges:
                if a in level and b not in known:
                    new[b] = new.get(b, False) or (level[a] and same)
            known |= new
            for node, kept in new.items():
                out.setdefault((origin, node), (hops, kept))
            level = new
    return {(o, n, h, k) for (o, n), (h, k) in out.items()}


@pytest.mark.parametrize("seed", range(3))
def test_reach_equals_breadth_first_search(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    edges = {(f"n{rnd.randrange(30)}", f"n{rnd.randrange(30)}"): rnd.random() < .5 for _ in range(45)}
    edges = [(a, b, s) for (a, b), s in edges.items() if a != b]
    start = [("x", "n0"), ("x", "n3"), ("y", "n7")]
    df = spark.createDataFrame([*edges, *edges[:5], ("n1", "n1", True), (None, "n2", True)], "src string, dst string, same boolean")
    first = spark.createDataFrame([*start, start[0], ("z", None)], "origin string, node string")
    if seed:
        monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in graph.reach(df, first).collect()} == walked(edges, start)
    assert graph.reach(df.limit(0), first).collect() == [] and graph.reach(df, first.limit(0)).collect() == []


def test_highest_flows_around_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "e"), ("x", "d")], "src string, dst string")
    values = spark.createDataFrame([("a", 1), ("b", 3), ("d", 1), ("x", 2), ("f", None)], "node string, value int")
    assert rows(graph.highest(edges, values), "node", "value") == [("a", 3), ("b", 3), ("c", 3), ("d", 3), ("x", 2)]


@pytest.mark.parametrize("hashed", [0, 10**6])
def test_large_rounds_give_what_small_ones_give(spark, hashed, monkeypatch):
    rnd = random.Random(8)
    pairs = [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(40)}") for _ in range(70)]
    edges = spark.createDataFrame([(a, b, i % 3 > 0) for i, (a, b) in enumerate(pairs)], "src string, dst string, same boolean")
    start = spark.createDataFrame([(o, f"n{rnd.randrange(40)}") for o in "xyz"], "origin string, node string")
    values = spark.createDataFrame([(f"n{i}", i % 4) for i in range(0, 40, 5)], "node string, value int")
    small = rows(graph.reach(edges, start)), rows(graph.highest(edges, values))
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(graph, "HASHED_ROWS", hashed)
    assert (rows(graph.reach(edges, start)), rows(graph.highest(edges, values))) == small


def test_edges_are_made_once_for_several_states_of_the_tags(spark):
    made = spark.sparkContext.accumulator(0)

    def tap(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    edges = spark.createDataFrame([("s.a", "x", "s.b", "y"), ("s.b", "y", "s.c", "z"), ("s.b", "y", "s.c", "z")], lineage.COLUMN_EDGES)
    held = spark.createDataFrame([("s", "a", "x", "classification", "restricted")], tags.TAG_SCHEMA)
    flow = graph.plain(lineage.column_graph(edges.mapInPandas(tap, edges.schema)))
    raised = tags.assign(held, tags.raise_along(flow, held))
    assert rows(tags.gaps_along(flow, held), "table_name", "inherited") == [("b", "restricted"), ("c", "restricted")]
    assert tags.gaps_along(flow, raised).collect() == []
    assert made.value == 3


def test_identifiers_are_followed_through_renames_and_cycles(spark):
    edges = [("s.a", "email", "s.b", "email"), ("s.b", "email", "s.c", "mail"), ("s.c", "mail", "s.d", "contact"),
             ("s.d", "contact", "s.a", "email"), ("s.a", "email", "s.c", "email_hash"), ("s.a", "city", "s.e", "city")]
    df = spark.createDataFrame(edges, lineage.COLUMN_EDGES)
    got = rows(lineage.identifier_reach(df), "identifier", "table_name", "column_name", "hops", "path_class")
    assert got == [("email", "s.c", "email_hash", 1, "renamed"), ("email", "s.c", "mail", 1, "renamed"),
                   ("email", "s.d", "contact", 2, "renamed")]
    held = spark.createDataFrame([("s", "a", "email", "classification", "restricted"), ("s", "d", "contact", "classification", "internal"),
                                  ("s", "e", "city", "classification", "secret"), ("s", "a", "city", "pii_type", "x")], tags.TAG_SCHEMA)
    gaps = rows(tags.inheritance_gaps(df, held), "table_name", "column_name", "classification", "inherited")
    assert gaps == [("b", "email", None, "restricted"), ("c", "email_hash", None, "restricted"), ("c", "mail", None, "restricted"),
                    ("d", "contact", "internal", "restricted")]
    mended = tags.assign(held, tags.raise_inherited(df, held))
    assert tags.inheritance_gaps(df, mended).collect() == []


def test_members_see_what_principals_see(spark):
    rnd = random.Random(4)
    objects = [(f"c{i % 2}", f"s{i % 5}", f"t{i}", rnd.choice([OWNERS, "g1", "u3", None])) for i in range(40)]
    tables = spark.createDataFrame(objects, "table_catalog string, table_schema string, table_name string, table_owner string")
    grants = []
    for _ in range(60):
        c, s, t, _ = rnd.choice(objects)
        level = rnd.choice(["CATALOG", "SCHEMA", "TABLE"])
        grants.append((rnd.choice(["g0", "g1", "g2", "u1", ALL_USERS]),
                       rnd.choice(["USE_CATALOG", "USE_SCHEMA", "SELECT", "BROWSE", "ALL_PRIVILEGES", "MODIFY"]), level,
                       {"CATALOG": c, "SCHEMA": f"{c}.{s}", "TABLE": f"{c}.{s}.{t}"}[level], "NONE"))
    privileges = spark.createDataFrame(grants, access.GRANT_SCHEMA)
    nested = {"team0": {"g0"}, "team1": {"team0", "g2"}, "team2": {"team1"}, "g1": {"team1"}, "g2": {"team2"}}
    people = {"u0": {"team0"}, "u1": {"team2"}, "u2": {"g1"}, "u3": {"lonely"}, "u4": {OWNERS}, "u5": {"team1", "g1"}}

    def closure(names):
        known = set()
        while names:
            known |= names
            names = set().union(*(nested.get(n, set()) for n in names)) - known
        return known

    members = spark.createDataFrame([(m, g) for m, gs in people.items() for g in gs], "member string, group_name string")
    groups = spark.createDataFrame([(g, p) for g, ps in nested.items() for p in ps], "group_name string, parent string")
    got = {r.member: (r.objects_visible, r.objects_readable) for r in access.access_of_members(tables, privileges, members, groups).collect()}
    for m, first in people.items():
        who = Principal.of(m, *closure(set(first)), m, ALL_USERS)
        seen = access.effective(tables, privileges, who).collect()
        assert got[m] == (sum(r.can_see for r in seen), sum(r.can_read for r in seen)), m


def test_members_of_equal_groups_are_worked_out_once(spark):
    """Forty members in two groups, three of them with grants of their own, are two classes."""
    tables = spark.createDataFrame([("c", "s", f"t{i}", OWNERS) for i in range(6)],
                                   "table_catalog string, table_schema string, table_name string, table_owner string")
    grants = [("g0", "USE_CATALOG", "CATALOG", "c"), ("g0", "USE_SCHEMA", "SCHEMA", "c.s"), ("g1", "ALL_PRIVILEGES", "CATALOG", "c"),
              ("g0", "SELECT", "TABLE", "c.s.t0"), ("u0", "SELECT", "TABLE", "c.s.t1"), ("u2", "SELECT", "TABLE", "c.s.t0"),
              ("u1", "BROWSE", "TABLE", "c.s.t1"), ("lone", "BROWSE", "TABLE", "c.s.t2")]
    privileges = spark.createDataFrame([(*g, "NONE") for g in grants], access.GRANT_SCHEMA)
    members = spark.createDataFrame([(f"u{i}", f"g{i % 2}") for i in range(40)] + [(f"u{i}", "unused") for i in range(9)] + [("lone", "unused")],
                                    "member string, group_name string")
    groups = spark.createDataFrame([], "group_name string, parent string")
    _, parts = access.signatures(tables, privileges)
    belongs, classes = access.member_classes(access.memberships(members, groups), parts)
    assert belongs.select("class").distinct().count() == 2 and classes.count() == 2
    assert belongs.count() == 40
    got = {r.member: (r.objects_visible, r.objects_readable)
           for r in access.access_of_members(tables, privileges, members, groups).collect()}
    assert got == {f"u{i}": (6, 6 if i % 2 else 2 if i == 0 else 1) for i in range(40)} | {"lone": (1, 0)}


def test_deltas_give_what_a_recomputation_gives(spark):
    rnd = random.Random(6)
    def order(i):
        return (f"O{i}", f"C{rnd.randrange(30)}", rnd.choice(["2024-01-05", "2024-01-20", "2024-02-01"]), f"{rnd.randrange(9999)}.25",
                rnd.choice(["EUR", "USD"]), rnd.choice(["completed", "completed", "refunded"]))

    def frame(data):
        made = spark.createDataFrame(list(data), "a string, b string, c string, d string, e string, f string")
        return made.selectExpr("a AS order_id", "b AS customer_id", "date(c) AS order_date", "CAST(d AS DECIMAL(12,2)) AS amount", "e AS currency", "f AS status")

    orders = {i: order(i) for i in range(400)}
    people = {f"C{i}": rnd.choice(["asia", "europe"]) for i in range(30)}

    def homes_of(p):
        return spark.createDataFrame(list(p.items()), "customer_id string, region string")

    home = gold.homes(homes_of(people))
    parts = gold.partials(frame(orders.values()))
    groups = gold.revenue_state(parts, home)
    for _ in range(3):
        delta = []
        for i in rnd.sample(sorted(orders), 30):
            old = orders.pop(i)
            delta.append((*old, -1))
            if rnd.random() < .6:
                orders[i] = order(i)
                delta.append((*orders[i], 1))
        moved = []
        for c in rnd.sample(sorted(people), 4):
            moved.append((c, people[c], -1))
            people[c] = rnd.choice(["asia", "europe", "africa"])
            moved.append((c, people[c], 1))
        change = None
        for sign in (1, -1):
            part = frame([d[:-1] for d in delta if d[-1] == sign]).withColumn("weight", F.lit(sign))
            change = part if change is None else change.unionByName(part)
        parts, groups = gold.apply_orders(parts, groups, home, change)
        home, groups = gold.apply_customers(parts, groups, home, spark.createDataFrame(moved, "customer_id string, region string, weight int"))
    whole = gold.revenue_groups(frame(orders.values()), homes_of(people))
    columns = ["region", "order_month", "currency", "orders", "customers_active", "revenue"]
    assert rows(groups, *columns) == rows(whole, *columns)
    assert rows(gold.published(groups, 3), *columns) == rows(whole.where("customers_active >= 3"), *columns)


def test_a_delta_is_read_once_and_meets_rows_without_a_currency(spark):
    """Deltas replace stored sums whose currency is null too, and no row of a delta is made twice."""
    made = spark.sparkContext.accumulator(0)

    def tap(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    def frame(data):
        return (spark.createDataFrame(data, "a string, d string, e string, weight int").selectExpr(
            "a AS customer_id", "date'2024-01-05' AS order_date", "CAST(d AS DECIMAL(12,2)) AS amount",
            "e AS currency", "'completed' AS status", "weight"))

    home = gold.homes(spark.createDataFrame([("C1", "asia"), ("C2", "asia")], "customer_id string, region string"))
    parts = gold.partials(frame([("C1", "5", None, 1), ("C2", "7", None, 1), ("C2", "1", "EUR", 1)]))
    groups = gold.revenue_state(parts, home)
    change = frame([("C1", "5", None, -1), ("C2", "2", None, 1), ("C2", "1", "EUR", -1)])
    after, groups = gold.apply_orders(parts, groups, home, change.mapInPandas(tap, change.schema))
    assert [(r.currency, r.orders, r.customers_active, r.revenue) for r in groups.collect()] == [(None, 2, 1, 9)]
    assert rows(after, "customer_id", "n", "total") == [("C2", 2, 9)]
    assert made.value == 3


def test_lattice_lists_all_minimal_generalisations(spark):
    rnd = random.Random(9)
    data = [(rnd.randrange(20), rnd.choice("abcd"), rnd.choice(["x", None])) for _ in range(150)]
    df = spark.createDataFrame(data, "n int, c string, z string")
    levels = {"n": [lambda r: r[0], lambda r: r[0] // 5, lambda r: "*"], "c": [lambda r: r[1], lambda r: r[1] < "c", lambda r: "*"],
              "z": [lambda r: r[2], lambda r: "*"]}
    columns = {"n": {"0": F.col("n"), "1": F.floor(F.col("n") / 5), "2": F.lit("*")},
               "c": {"0": F.col("c"), "1": F.col("c") < "c", "2": F.lit("*")}, "z": {"0": F.col("z"), "1": F.lit("*")}}
    safe = {}
    for a in range(3):
        for b in range(3):
            for c in range(2):
                sizes = {}
                for r in data:
                    key = (levels["n"][a](r), levels["c"][b](r), levels["z"][c](r))
                    sizes[key] = sizes.get(key, 0) + 1
                if min(sizes.values()) >= 5:
                    safe[a, b, c] = (len(sizes), min(sizes.values()), 150)
    least = {v: s for v, s in safe.items() if not any(o != v and all(x <= y for x, y in zip(o, v, strict=True)) for o in safe)}
    want = sorted((f"n={a}, c={b}, z={c}", *s) for (a, b, c), s in least.items())
    assert sorted(tuple(r) for r in anonymize.lattice(df, columns, 5).collect()) == want and want
    assert anonymize.lattice(df, columns, 1000).collect() == []


def test_digest_sees_swaps_doubles_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5), (3, None, 2.5), (3, None, 2.5)], "i int, s string, d double")

    def unequal(other):
        return [item for item, same in rows(evolve.digest_diff(df, other), "item", "equal") if not same]

    assert unequal(df.select("d", "s", "i").repartition(3)) == []
    assert unequal(df.withColumn("s", F.when(F.col("i") == 1, "b").when(F.col("i") == 2, "a").otherwise(F.col("s")))) == ["*"]
    assert unequal(df.unionByName(df.limit(1))) == ["*", "d", "i", "s"]
    assert unequal(df.dropDuplicates()) == ["*", "d", "i", "s"]
    assert unequal(df.withColumn("d", F.coalesce("d", F.lit(0.0)))) == ["*", "d"]
    assert unequal(df.drop("d")) == ["*", "d"]
