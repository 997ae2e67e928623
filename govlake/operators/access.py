"""Privileges as rows: grants at catalog, schema or table level, and what they reach.

Grant relation columns: grantee, privilege_type, object_type (CATALOG | SCHEMA | TABLE),
object_key (`catalog[.schema[.table]]`), inherited_from (`'NONE'` for a direct grant).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.design import ALL_USERS, CATALOG, OWNERS
from govlake.functions.rows import literal
from govlake.operators import graph
from govlake.operators.evolve import snapshot_diff
from govlake.operators.joins import lookup
from govlake.principal import AccessDenied, Principal
from govlake.session import cut

GRANT_SCHEMA = ("grantee string, privilege_type string, object_type string, "
                "object_key string, inherited_from string")
_GRANT = ["grantee", "privilege_type", "object_type", "object_key"]


def grant_rows(spark: SparkSession, grants: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    return literal(spark, [(*g, "NONE") for g in grants], GRANT_SCHEMA)


def grant(privileges: DataFrame, grants: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Add direct grants; one already held is not held twice.

    The few new grants are looked for by broadcasting them, so the relation is not shuffled.
    """
    new = grant_rows(privileges.sparkSession, grants)
    held = (privileges.where(F.col("inherited_from") == "NONE")
            .join(F.broadcast(new.select(*_GRANT)), _GRANT, "left_semi")
            .select(*_GRANT).distinct())
    return privileges.unionByName(new.join(held, _GRANT, "left_anti"))


def revoke(privileges: DataFrame, grants: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Remove direct grants at exactly the named level; elsewhere nothing changes."""
    gone = grant_rows(privileges.sparkSession, grants).select(*_GRANT)
    held = F.col("inherited_from") == "NONE"
    return (privileges.where(held).join(F.broadcast(gone), _GRANT, "left_anti")
            .unionByName(privileges.where(~held)))


def direct_grants(privileges: DataFrame) -> DataFrame:
    """Direct grants as canonical `grantee | privilege | level | object` strings."""
    return (privileges.where(F.col("inherited_from") == "NONE")
            .select(F.concat_ws(" | ", *_GRANT).alias("grant")).distinct())


def matrix_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Grants on one side only: `missing` from the system, or `extra` to the design."""
    diff = snapshot_diff(expected, actual, ["grant"], [])
    return diff.select(F.when(F.col("in_before"), "missing").otherwise("extra").alias("side"),
                       "grant")


def is_forbidden(grantee: str = ALL_USERS, privilege: str = "BROWSE") -> Column:
    return ((F.col("object_type") == "CATALOG") & (F.col("grantee") == grantee)
            & (F.col("privilege_type") == privilege))


def forbidden(privileges: DataFrame, grantee: str = ALL_USERS,
              privilege: str = "BROWSE") -> DataFrame:
    """Catalog-level grants that must not exist (the platform's default for everyone)."""
    return privileges.where(is_forbidden(grantee, privilege))


def held_levels(privileges: DataFrame) -> DataFrame:
    """How many direct grants sit at each level, by privilege."""
    return (privileges.where(F.col("inherited_from") == "NONE").select(*_GRANT).distinct()
            .groupBy("object_type", "privilege_type")
            .agg(F.count(F.lit(1)).alias("grants"),
                 F.count_distinct("grantee").alias("grantees")))


ALL = "ALL_PRIVILEGES"


def _holds(privilege: str):
    return F.bool_or(F.col("privilege_type").isin(privilege, ALL))


def effective(tables: DataFrame, privileges: DataFrame, principal: Principal,
              catalog_owner: str = OWNERS) -> DataFrame:
    """Per table: can the principal read it, see its metadata, and which level is missing?"""
    return effective_for(tables, privileges, [principal], catalog_owner).drop("who")


def effective_for(tables: DataFrame, privileges: DataFrame, principals: Sequence[Principal],
                  catalog_owner: str = OWNERS) -> DataFrame:
    """`effective` for several principals in one plan, with `who` in front.

    Traversal needs USE_CATALOG and USE_SCHEMA (held there or above), then SELECT at table,
    schema or catalog. BROWSE reveals metadata only. The owner of a table or of the catalog
    needs nothing. Grants meet the principals' group memberships and are folded to one row per
    principal and object. What is held on catalogs and schemas is worked out per distinct schema
    and looked up, so objects are never dealt by their few catalog or schema names.
    """
    members = [(p.name, g) for p in principals for g in sorted(p.grantees)]
    groups = {}
    for who, group in members:
        groups.setdefault(group, []).append(who)
    belongs = F.create_map(*(F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x))
                             for pair in groups.items() for x in pair)) if groups else None
    # the principals a grant or an ownership reaches: a lookup in a short list, no join
    reached = (lambda c: belongs[F.col(c)]) if groups else (lambda c: F.lit(None).cast("array<string>"))
    mine = privileges.withColumn("who", F.explode(reached("grantee")))

    def at(level: str, prefix: str) -> DataFrame:
        return (mine.where(F.col("object_type") == level)
                .groupBy(F.concat_ws("|", "who", "object_key").alias(f"{prefix}_key"))
                .agg(_holds("USE_CATALOG").alias(f"{prefix}_use_catalog"),
                     _holds("USE_SCHEMA").alias(f"{prefix}_use_schema"),
                     _holds("SELECT").alias(f"{prefix}_select"),
                     _holds("BROWSE").alias(f"{prefix}_browse")))

    def held(*columns: str):
        flags = [F.coalesce(F.col(c), F.lit(False)) for c in columns]
        out = flags[0]
        for flag in flags[1:]:
            out = out | flag
        return out

    place = F.concat_ws(".", "table_catalog", "table_schema")
    names = F.array(*(F.lit(p.name) for p in principals))

    def keyed(df: DataFrame) -> DataFrame:
        return (df.withColumn("who", F.explode(names))
                .withColumn("s_key", F.concat_ws("|", "who", place)))

    schemas = (keyed(tables.select("table_catalog", "table_schema").distinct())
               .select("s_key", F.concat_ws("|", "who", "table_catalog").alias("c_key"))
               .join(at("CATALOG", "c"), "c_key", "left").join(at("SCHEMA", "s"), "s_key", "left")
               .drop("c_key"))
    objects = keyed(tables.select("table_catalog", "table_schema", "table_name", "table_owner")).withColumn(
        "t_key", F.concat_ws("|", "who", F.concat_ws(".", place, "table_name")))
    joined = lookup(objects, schemas, "s_key").join(at("TABLE", "t"), "t_key", "left")
    rulers = [p.name for p in principals if p.holds(catalog_owner)]
    owner = F.coalesce(F.array_contains(reached("table_owner"), F.col("who")), F.lit(False)) | F.col("who").isin(rulers)
    use_catalog = held("c_use_catalog")
    use_schema = held("s_use_schema", "c_use_schema")
    select = held("t_select", "s_select", "c_select")
    missing = (F.when(owner, F.lit(None).cast("string"))
               .when(~use_catalog, "USE_CATALOG").when(~use_schema, "USE_SCHEMA")
               .when(~select, "SELECT"))
    sees = owner | held("c_browse", "s_browse", "t_browse") | (
        use_catalog & (use_schema | held("t_select")))
    return joined.select("who", "table_catalog", "table_schema", "table_name",
                         missing.isNull().alias("can_read"), sees.alias("can_see"),
                         missing.alias("missing_level"))


# ---- members as a relation: any number of people, nested groups, objects by what is granted ---

# what a grantee holds on an object, as bits
_USE_CATALOG, _USE_SCHEMA, _SELECT, _BROWSE, _ON_TABLE, _OWNS = (1 << i for i in range(6))
_AT = {"CATALOG": {"USE_CATALOG": _USE_CATALOG, "USE_SCHEMA": _USE_SCHEMA, "SELECT": _SELECT, "BROWSE": _BROWSE},
       "SCHEMA": {"USE_SCHEMA": _USE_SCHEMA, "SELECT": _SELECT, "BROWSE": _BROWSE},
       "TABLE": {"SELECT": _SELECT | _ON_TABLE, "BROWSE": _BROWSE}}


def group_closure(groups: DataFrame) -> DataFrame:
    """`groups` (group_name, parent) -> group_name, holds: every group it belongs to, itself too."""
    names = groups.select("group_name").unionByName(groups.select(F.col("parent").alias("group_name"))).distinct()
    start = names.select(F.col("group_name").alias("origin"), F.col("group_name").alias("node"))
    edges = groups.select(F.col("group_name").alias("src"), F.col("parent").alias("dst"), F.lit(True).alias("same"))
    return (graph.reach(edges, start).select(F.col("origin").alias("group_name"), F.col("node").alias("holds"))
            .unionByName(names.select("group_name", F.col("group_name").alias("holds"))))


def memberships(members: DataFrame, groups: DataFrame) -> DataFrame:
    """`members` (member, group_name) and nested `groups` -> member, grantee: each name a member is
    granted under, its own included. The closure is taken over groups alone, which are few."""
    closed = group_closure(groups)
    return (members.join(closed, "group_name", "left")
            .select("member", F.coalesce("holds", "group_name").alias("grantee"))
            .unionByName(members.select("member", F.col("member").alias("grantee"))).distinct())


def signatures(tables: DataFrame, privileges: DataFrame, catalog_owner: str = OWNERS) -> tuple[DataFrame, DataFrame]:
    """Objects folded by what is granted on them.

    The first relation has the number `n` of objects of each signature; the second, per signature,
    grantee and mask: who holds what there, from the catalog, the schema and the table, and who owns
    it. Objects of equal grants share a signature, so access is worked out once for all of them. Grants
    of catalogs and schemas are folded per schema, and only tables with grants of their own add to that.
    """
    kind, privilege = F.col("object_type"), F.col("privilege_type")
    mask = F.lit(0)
    for level, bits in _AT.items():
        for name, bit in bits.items():
            mask = F.when((kind == level) & (privilege == name), bit).otherwise(mask)
        every = 0
        for bit in bits.values():
            every |= bit
        mask = F.when((kind == level) & (privilege == ALL), every).otherwise(mask)
    held = (privileges.select("object_type", "object_key", "grantee", mask.alias("mask")).where("mask > 0")
            .groupBy("object_type", "object_key", "grantee").agg(F.bit_or("mask").alias("mask")))

    def listed(df: DataFrame, key: str) -> DataFrame:
        """One row per key: its grants in order, and their digest."""
        rows = df.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("grantee", "mask"))).alias(f"{key}_grants"))
        return rows.withColumn(f"{key}_digest", F.sha2(F.to_json(f"{key}_grants"), 256))

    place = F.concat_ws(".", "table_catalog", "table_schema")
    schemas = tables.select("table_catalog", place.alias("s")).distinct()
    above = (schemas.join(held.where(kind == "CATALOG"), F.col("table_catalog") == F.col("object_key"))
             .select("s", "grantee", "mask")
             .unionByName(schemas.join(held.where(kind == "SCHEMA"), F.col("s") == F.col("object_key"))
                          .select("s", "grantee", "mask"))
             .groupBy("s", "grantee").agg(F.bit_or("mask").alias("mask")))
    by_schema = listed(above, "s")
    by_table = listed(held.where(kind == "TABLE").select(F.col("object_key").alias("t"), "grantee", "mask"), "t")
    objects = tables.select("table_catalog", "table_schema", "table_name", "table_owner", place.alias("s"),
                            F.concat_ws(".", place, "table_name").alias("t"))
    objects = (lookup(objects, by_schema.select("s", "s_digest"), "s").join(by_table.select("t", "t_digest"), "t", "left")
               .withColumn("signature", F.sha2(F.to_json(F.struct("s_digest", "t_digest", "table_owner")), 256)))
    kinds = cut(objects.groupBy("signature").agg(
        F.first("s_digest").alias("s_digest"), F.first("t_digest").alias("t_digest"),
        F.first("table_owner").alias("table_owner"), F.count(F.lit(1)).alias("n")))
    owners = F.array_compact(F.array("table_owner", F.lit(catalog_owner)))

    def once(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(f"{key}_digest").agg(F.first(f"{key}_grants").alias(f"{key}_grants"))

    parts = (kinds.select("signature", F.explode(owners).alias("grantee"), F.lit(_OWNS).alias("mask"))
             .unionByName(kinds.join(once(by_schema, "s"), "s_digest").select("signature", F.inline("s_grants")))
             .unionByName(kinds.join(once(by_table, "t"), "t_digest").select("signature", F.inline("t_grants"))))
    return kinds.select("signature", "n"), parts.groupBy("signature", "grantee").agg(F.bit_or("mask").alias("mask"))


def _has(mask: Column, bit: int) -> Column:
    return mask.bitwiseAND(F.lit(bit)) > 0


def can_read(mask: Column) -> Column:
    return _has(mask, _OWNS) | (_has(mask, _USE_CATALOG) & _has(mask, _USE_SCHEMA) & _has(mask, _SELECT))


def can_see(mask: Column) -> Column:
    return _has(mask, _OWNS) | _has(mask, _BROWSE) | (
        _has(mask, _USE_CATALOG) & (_has(mask, _USE_SCHEMA) | _has(mask, _ON_TABLE)))


def missing_of(mask: Column) -> Column:
    """The first level that is missing, null where the object can be read."""
    return (F.when(can_read(mask), F.lit(None).cast("string")).when(~_has(mask, _USE_CATALOG), "USE_CATALOG")
            .when(~_has(mask, _USE_SCHEMA), "USE_SCHEMA").otherwise("SELECT"))


def member_classes(grantees: DataFrame, parts: DataFrame, everyone: str = ALL_USERS) -> tuple[DataFrame, DataFrame]:
    """(member, class) and (class, grantee): members told apart only by the groups that hold something.

    A member's own name is left out, as it is granted to one member and would make a class for each.
    """
    granting = parts.where(F.col("grantee") != everyone).select("grantee").distinct()
    through = (grantees.where("grantee <> member").join(granting, "grantee", "left_semi")
               .groupBy("member").agg(F.array_sort(F.collect_set("grantee")).alias("names")))
    through = cut(through.withColumn("class", F.sha2(F.to_json("names"), 256)))
    return (through.select("member", "class"),
            through.groupBy("class").agg(F.first("names").alias("names")).select("class", F.explode("names").alias("grantee")))


def class_masks(parts: DataFrame, classes: DataFrame, everyone: str = ALL_USERS) -> tuple[DataFrame, DataFrame]:
    """(signature, base) what everyone holds, and (signature, class, mask) for classes that hold
    something besides; mask includes the base. What is granted to everyone meets no class.

    Few grantees may hold most of the grants, so signatures of a grantee are dealt over all tasks by
    their hash, and its classes go to each deal."""
    base = parts.groupBy("signature").agg(F.bit_or(F.when(F.col("grantee") == everyone, F.col("mask")).otherwise(0)).alias("base"))
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (parts.where(F.col("grantee") != everyone).withColumn("deal", F.pmod(F.xxhash64("signature"), F.lit(n)))
             .repartition(n, "grantee", "deal"))
    met = classes.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    own = dealt.join(met, ["grantee", "deal"]).groupBy("signature", "class").agg(F.bit_or("mask").alias("mask"))
    return base, own.join(base, "signature").select("signature", "class", F.col("mask").bitwiseOR(F.col("base")).alias("mask"))


def access_of_members(tables: DataFrame, privileges: DataFrame, members: DataFrame, groups: DataFrame,
                      catalog_owner: str = OWNERS, everyone: str = ALL_USERS) -> DataFrame:
    """member, objects_visible, objects_readable for each member.

    Worked out over signatures x classes of members, never over objects or members: a member's
    numbers are those of everyone, what its groups add, and what is granted to it by its own name
    adds on the signatures that name it, each weighted by how many objects share a signature.
    """
    sizes, parts = signatures(tables, privileges, catalog_owner)
    parts = cut(parts)
    people = members.select("member").distinct()
    belongs, classes = member_classes(memberships(members, groups), parts, everyone)
    base, own = class_masks(parts, classes, everyone)
    base = cut(sizes.join(base, "signature", "left").select("signature", "n", F.coalesce("base", F.lit(0)).alias("base")))
    own = cut(own)
    n, mask, before = F.col("n"), F.col("mask"), F.col("base")

    def added(flag) -> Column:
        return F.sum(F.when(flag(mask) & ~flag(before), n).otherwise(0))

    more = own.join(base, "signature").groupBy("class").agg(added(can_see).alias("see"), added(can_read).alias("read"))
    named = (parts.where(F.col("grantee") != everyone).select("signature", F.col("grantee").alias("member"), F.col("mask").alias("named"))
             .join(people, "member").join(belongs, "member", "left").join(base, "signature").join(own, ["signature", "class"], "left")
             .select("member", "n", "named", F.coalesce("mask", "base").alias("base"))
             .withColumn("mask", F.col("named").bitwiseOR(F.col("base"))))
    alone = named.groupBy("member").agg(added(can_see).alias("see_alone"), added(can_read).alias("read_alone"))
    totals = base.agg(F.coalesce(F.sum(F.when(can_see(before), n)), F.lit(0)).alias("see"),
                      F.coalesce(F.sum(F.when(can_read(before), n)), F.lit(0)).alias("read")).first()

    def number(name: str, everyones: int) -> Column:
        return (F.coalesce(name, F.lit(0)) + F.coalesce(f"{name}_alone", F.lit(0)) + F.lit(everyones)).cast("bigint")

    return (people.join(belongs, "member", "left").join(more, "class", "left").join(alone, "member", "left")
            .select("member", number("see", totals.see).alias("objects_visible"),
                    number("read", totals.read).alias("objects_readable")))


def visible_schemas(tables: DataFrame, privileges: DataFrame, principal: Principal) -> DataFrame:
    """Schemas whose objects the principal can see, with how many it can read."""
    return visible_schemas_for(tables, privileges, [principal]).drop("who")


def visible_schemas_for(tables: DataFrame, privileges: DataFrame, principals: Sequence[Principal]) -> DataFrame:
    """`visible_schemas` for several principals at once."""
    seen = effective_for(tables, privileges, principals).where("can_see")
    return seen.groupBy("who", "table_schema").agg(F.count(F.lit(1)).alias("objects_visible"),
                                                   F.count_if("can_read").alias("objects_readable"))


def visible(relation: DataFrame, tables: DataFrame, privileges: DataFrame,
            principal: Principal) -> DataFrame:
    """A metadata relation as the principal sees it: rows of objects it may not see are absent.
    Where the relation names its catalog, an object of another catalog is another object."""
    keys = [c for c in ("table_catalog", "table_schema", "table_name") if c in relation.columns]
    seen = effective(tables, privileges, principal).where("can_see").select(*keys)
    return relation.join(seen, keys, "left_semi")


def missing_level(grants: Iterable[tuple[str, str, str, str]], principal: Principal,
                  catalog: str, schema: str, table: str, owner: str | None = None,
                  catalog_owner: str = OWNERS) -> str | None:
    """The same rule for one table and the few grants on its path; None means readable."""
    if principal.holds(catalog_owner) or (owner is not None and owner in principal.grantees):
        return None
    path = {catalog: "CATALOG", f"{catalog}.{schema}": "SCHEMA",
            f"{catalog}.{schema}.{table}": "TABLE"}
    held = {(each, level) for grantee, privilege, level, key in grants
            if grantee in principal.grantees and path.get(key) == level
            for each in (("USE_CATALOG", "USE_SCHEMA", "SELECT") if privilege == ALL
                         else (privilege,))}
    if ("USE_CATALOG", "CATALOG") not in held:
        return "USE_CATALOG"
    if not held & {("USE_SCHEMA", "SCHEMA"), ("USE_SCHEMA", "CATALOG")}:
        return "USE_SCHEMA"
    if not any(privilege == "SELECT" for privilege, _ in held):
        return "SELECT"
    return None


def check(grants: Iterable[tuple[str, str, str, str]], principal: Principal, table: str,
          owner: str | None = None, catalog: str = CATALOG) -> None:
    schema, name = table.split(".")
    level = missing_level(grants, principal, catalog, schema, name, owner)
    if level:
        where = {"USE_CATALOG": catalog, "USE_SCHEMA": f"{catalog}.{schema}",
                 "SELECT": f"{catalog}.{table}"}[level]
        raise AccessDenied(f"{principal.name} does not hold {level} on {where}")
