"""Tag-driven access policies: which masks and row filters apply to whom, and applying them.

A policy names tags, never columns, so a table is covered as soon as its columns are tagged.
Resolution for one read happens on the driver, over the tags of that one table. The result is
one Filter under one Project: no shuffle, no Python in the rows, columns still pruned.

Boundary: protection holds for reads through `GovernedCatalog` and the views it registers, not
for someone who opens the files. Spark does not promise that a reader's own predicate runs
after the row filter; ask for `barrier=True` where that matters.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.design import (ALL_USERS, CATALOG, GRANTS, OWNERS, PERSONAS, POLICIES, TAG_VOCABULARY, VIEWS,
                            ColumnMask, RowFilter)
from govlake.functions.masks import FUNCTIONS
from govlake.functions.rows import literal
from govlake.operators import access
from govlake.operators.tags import require_allowed
from govlake.principal import Principal
from govlake.session import prepare_checkpoints

Policy = ColumnMask | RowFilter
Tags = Mapping[str, Mapping[str, str]]


class PolicyConflict(PermissionError):
    """Two masks match one column for one reader: access is blocked, neither is chosen."""


class MaskTypeMismatch(TypeError):
    """A mask's result does not fit the column's type (the CAST_INVALID_INPUT class)."""


class PolicyInUse(RuntimeError):
    """A policy cannot be retired while a column still carries a tag value it matches."""


@dataclass(frozen=True)
class Plan:
    """What one reader gets from one table."""

    masks: tuple[tuple[str, ColumnMask], ...] = ()
    filters: tuple[tuple[str, RowFilter], ...] = ()

    def mask_of(self, column: str) -> ColumnMask | None:
        return dict(self.masks).get(column)


def create(policy: Policy, vocabulary: Mapping[str, tuple[str, ...]] = TAG_VOCABULARY) -> Policy:
    """Validate a policy the way the catalog would: known tag values, known function, arity.

    A mask receives the matched column and then its extra arguments; a filter likewise.
    """
    for key, value in policy.match:
        require_allowed({key: value}, vocabulary)
    if policy.function not in FUNCTIONS:
        raise ValueError(f"policy {policy.name}: function {policy.function!r} does not exist")
    _, _, result, arity = FUNCTIONS[policy.function]
    given = 1 + len(policy.args)
    if given != arity:
        raise ValueError(f"policy {policy.name} passes {given} argument(s), but "
                         f"{policy.function} takes {arity}")
    if isinstance(policy, RowFilter) and result != "BOOLEAN":
        raise ValueError(f"row filter {policy.name} needs a BOOLEAN function")
    return policy


def applies_to(policy: Policy, principal: Principal) -> bool:
    exempt = policy.exempt is not None and principal.holds(policy.exempt)
    return principal.holds(policy.to) and not exempt


def _matches(policy: Policy, tags: Mapping[str, str]) -> bool:
    return any(tags.get(key) == value for key, value in policy.match)


def _base(type_name: str) -> str:
    return type_name.upper().split("(")[0].strip()


def fits(policy: ColumnMask, column_type: str) -> bool:
    """Does the column's type go in and the mask's type come out unchanged?

    `mask_full` takes and gives text; on any non-text column it would make reads fail.
    """
    _, takes, gives, _ = FUNCTIONS[policy.function]
    return _base(column_type) == takes == gives


def resolve(table: str, columns: Mapping[str, str], tags: Tags, policies: Sequence[Policy],
            principal: Principal) -> Plan:
    """Policies that act on `table` for `principal`; raises on a conflict or a type mismatch."""
    masks, filters = [], []
    for column, type_name in columns.items():
        carried = tags.get(column, {})
        hits = [p for p in policies if applies_to(p, principal) and _matches(p, carried)]
        column_masks = [p for p in hits if isinstance(p, ColumnMask)]
        if len(column_masks) > 1:
            names = ", ".join(p.name for p in column_masks)
            raise PolicyConflict(f"{table}.{column}: several masks apply ({names})")
        for p in column_masks:
            if not fits(p, type_name):
                raise MaskTypeMismatch(
                    f"{table}.{column} is {type_name}, but {p.name} works on "
                    f"{FUNCTIONS[p.function][1]} (CAST_INVALID_INPUT)")
            masks.append((column, p))
        filters += [(column, p) for p in hits if isinstance(p, RowFilter)]
    return Plan(tuple(masks), tuple(filters))


def _call(policy: Policy, column: str) -> Column:
    return FUNCTIONS[policy.function][0](F.col(column), *policy.args)


def filter_rows(df: DataFrame, plan: Plan) -> DataFrame:
    """Row filters, on raw values; a NULL verdict removes the row."""
    for column, policy in plan.filters:
        df = df.where(_call(policy, column))
    return df


def mask_columns(df: DataFrame, plan: Plan) -> DataFrame:
    masked = dict(plan.masks)
    return df.select(*[_call(masked[c], c).alias(c) if c in masked else F.col(c)
                       for c in df.columns])


def apply(df: DataFrame, plan: Plan) -> DataFrame:
    return mask_columns(filter_rows(df, plan), plan)


def sql_types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString().upper() for f in df.schema.fields}


@dataclass(frozen=True)
class GovernedCatalog:
    """Tables behind privileges and policies. `read` is the only way in.

    `tags` maps table -> column -> {tag: value}. A view listed in `views` is published with its
    owner's rights: privileges are checked, policies are not applied.
    """

    tables: Mapping[str, DataFrame]
    tags: Mapping[str, Tags]
    policies: Sequence[Policy] = POLICIES
    grants: Sequence[tuple[str, str, str, str]] = GRANTS
    owner: str = OWNERS
    views: Sequence[str] = VIEWS
    catalog: str = CATALOG

    def plan(self, table: str, principal: Principal) -> Plan:
        if table in self.views:
            return Plan()
        return resolve(table, sql_types(self.tables[table]), self.tags.get(table, {}),
                       self.policies, principal)

    def read(self, table: str, principal: Principal, barrier: bool = False) -> DataFrame:
        """Privilege check, row filter on raw values, masks. Lazy unless `barrier`.

        `barrier` checkpoints the filtered rows (spark.checkpoint.dir) before the caller's own
        predicates can be planned next to the filter.
        """
        access.check(self.grants, principal, table, self.owner, self.catalog)
        plan = self.plan(table, principal)
        rows = filter_rows(self.tables[table], plan)
        if barrier and plan.filters:
            prepare_checkpoints(rows.sparkSession)
            rows = rows.checkpoint()
        return mask_columns(rows, plan)

    def register(self, principal: Principal, prefix: str = "") -> list[str]:
        """Temp views over every table the principal may read, for use from SQL."""
        made = []
        for table, df in self.tables.items():
            schema, name = table.split(".")
            if access.missing_level(self.grants, principal, self.catalog, schema, name,
                                    self.owner) is None:
                view = prefix + table.replace(".", "_")
                self.read(table, principal).createOrReplaceTempView(view)
                made.append(view)
        return made

    def with_tags(self, table: str, tags: Tags) -> "GovernedCatalog":
        return replace(self, tags={**self.tags, table: tags})


def tags_of(meta: DataFrame, table: str) -> dict[str, dict[str, str]]:
    """Tags of one table as a mapping (action; as many rows as the table has tagged columns)."""
    schema, name = table.split(".")
    rows = (meta.where((F.col("table_schema") == schema) & (F.col("table_name") == name))
            .select("column_name", "tag_name", "tag_value").distinct().toLocalIterator())
    out: dict[str, dict[str, str]] = {}
    for r in rows:
        out.setdefault(r.column_name, {})[r.tag_name] = r.tag_value
    return out


class StoredTags(Mapping):
    """The tags of a stored relation by table; those of one table are read when asked for."""

    def __init__(self, meta: DataFrame):
        self.meta = meta

    def __getitem__(self, table: str) -> Tags:
        found = tags_of(self.meta, table)
        if not found:
            raise KeyError(table)
        return found

    def __iter__(self):
        names = F.concat_ws(".", "table_schema", "table_name").alias("name")
        return (r.name for r in self.meta.select(names).distinct().toLocalIterator())

    def __len__(self) -> int:
        return self.meta.select("table_schema", "table_name").distinct().count()


# ---- policies as rows: the same rules over every column of a catalog ------------------------

def policy_rows(spark: SparkSession, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """One row per policy and tag pair it matches."""
    rows = []
    for p in policies:
        kind = "COLUMN_MASK" if isinstance(p, ColumnMask) else "ROW_FILTER"
        takes, gives = FUNCTIONS[p.function][1:3] if p.function in FUNCTIONS else (None, None)
        rows += [(p.name, kind, p.function, k, v, p.to, p.exempt or "", takes, gives)
                 for k, v in p.match]
    return literal(spark, rows, (
        "policy_name string, kind string, function_name string, tag_name string, "
        "tag_value string, granted_to string, exempt string, takes string, gives string"))


def matched(tags: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """Every (column, policy) match. The policy list is a handful of literal rows, so the tag
    relation is not shuffled whichever tag value dominates it."""
    return (tags.join(F.broadcast(policy_rows(tags.sparkSession, policies)),
                      ["tag_name", "tag_value"])
            .select("table_schema", "table_name", "column_name", "policy_name", "kind",
                    "function_name", "takes", "gives", "granted_to", "exempt").distinct())


def usage(tags: DataFrame, policies: Sequence[Policy] = POLICIES,
          routines: Iterable[str] = ()) -> DataFrame:
    """Policy and function inventory, both ways: which function each policy calls, how many
    columns it reaches, functions no policy calls, policies whose function is missing."""
    spark = tags.sparkSession
    hits = (tags.groupBy("tag_name", "tag_value").agg(F.count(F.lit(1)).alias("n")))
    per_policy = (policy_rows(spark, policies).join(hits, ["tag_name", "tag_value"], "left")
                  .groupBy("policy_name", "kind", "function_name")
                  .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("columns_matched")))
    known = literal(spark, [(r,) for r in routines], "function_name string")
    joined = per_policy.join(known.withColumn("_known", F.lit(True)), "function_name", "full")
    return joined.select(
        "policy_name", "kind", "function_name",
        F.coalesce("columns_matched", F.lit(0)).alias("columns_matched"),
        F.when(F.col("_known").isNull(), "function missing")
         .when(F.col("policy_name").isNull(), "function unused").otherwise("ok").alias("status"))


def overlapping(a: Policy, b: Policy, members: Iterable[Iterable[str]] = PERSONAS.values()) -> bool:
    """Can one reader get both? Never where one acts on just those whom the other exempts; for sure
    where they name one group or everyone; else where a known member list holds both groups."""
    if a.to == b.exempt or b.to == a.exempt:
        return False
    return a.to == b.to or ALL_USERS in (a.to, b.to) or any({a.to, b.to} <= set(m) for m in members)


def lint(columns: DataFrame, tags: DataFrame, policies: Sequence[Policy] = POLICIES,
         regional: Column | None = None) -> DataFrame:
    """What would deny or surprise a reader, found without reading as one.

    `conflict`: several masks on a column for overlapping readers. `type mismatch`: a mask that
    takes or gives another type. `function missing`: a mask whose function does not exist.
    `unfiltered region`: a region column no row filter reaches; `regional` says which columns
    those are, by default the ones named region.
    """
    key = ["table_schema", "table_name", "column_name"]
    every = matched(tags, policies)
    folded = every.where(F.col("kind") == "COLUMN_MASK").groupBy(*key).agg(
        F.collect_set(F.struct("policy_name", "takes", "gives")).alias("masks"))
    base = F.upper(F.split_part(F.col("data_type"), F.lit("("), F.lit(1)))
    names = F.transform("masks", lambda m: m["policy_name"])
    conflict = F.lit(False)
    masks = [p for p in policies if isinstance(p, ColumnMask)]
    for i, one in enumerate(masks):
        for other in masks[i + 1:]:
            if overlapping(one, other):
                conflict = conflict | (F.array_contains(names, one.name) & F.array_contains(names, other.name))
    wrong = F.exists("masks", lambda m: (m["takes"] != base) | (m["gives"] != base))
    on_masked = columns.join(folded, key).select(*key, F.explode(F.array_compact(F.array(
        F.when(conflict, "conflict"), F.when(wrong, "type mismatch"),
        F.when(F.exists("masks", lambda m: m["takes"].isNull()), "function missing")))).alias("issue"))
    filtered = every.where(F.col("kind") == "ROW_FILTER").select(*key).distinct()
    bare = (columns.where(F.col("column_name") == "region" if regional is None else regional).select(*key)
            .join(filtered, key, "left_anti").withColumn("issue", F.lit("unfiltered region")))
    return on_masked.unionByName(bare)


def retire(name: str, meta: DataFrame, policies: Sequence[Policy],
           vocabulary: Mapping[str, tuple[str, ...]]) -> tuple[list[Policy], dict]:
    """Remove a policy together with the tag values only it used (action: checks the tags).

    Order matters: a value still carried by a column stops everything; then the policy goes,
    then its values leave the vocabulary so they cannot be assigned again. An unknown name is
    an error, so a second run is not mistaken for a first.
    """
    found = [p for p in policies if p.name == name]
    if not found:
        raise KeyError(f"no policy named {name!r}")
    policy, rest = found[0], [p for p in policies if p.name != name]
    still = [pair for pair in policy.match if not any(pair in p.match for p in rest)]
    for key, value in still:
        user = (meta.where((F.col("tag_name") == key) & (F.col("tag_value") == value))
                .limit(1).first())
        if user is not None:
            raise PolicyInUse(f"{user.table_schema}.{user.table_name}.{user.column_name} still "
                              f"carries {key}={value}; {name} stays")
    smaller = {k: tuple(v for v in values if (k, v) not in still)
               for k, values in vocabulary.items()}
    return rest, smaller


def unused_functions(policies: Sequence[Policy]) -> list[str]:
    """Functions left without a policy; they go after the policy, never before."""
    used = {p.function for p in policies}
    return sorted(set(FUNCTIONS) - used)
