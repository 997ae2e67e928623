"""Writing governed tables: stage, check, swap.

Parquet tables have no transactions, so every write goes to a new version folder first, is
checked there, and only then becomes the table by one change of its location. A failed check
leaves the published version untouched. CHECK rules belong to the table: they are kept as rows of
RULES and read by every write, whoever calls it. Readers of the old version keep their files; removing
old versions is left to the platform's retention job.

Every step requires an exempt principal: a masked identity would store masked values.

What a lake knows about itself (objects, columns, tags, rules, lineage) is kept in books: rows under
its root that are only ever appended, each writer to a folder of its own, so writers never lose each
other's rows and no row passes one task. A state is the last row of each key; a removed tag or rule
is a row too, which is how a build knows that it must not come back.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.design import Constraint, Expectation
from govlake.functions.rows import literal
from govlake.operators import evolve, quality, tags
from govlake.principal import Principal, require_exempt


# where a lake keeps its own metadata as rows, outside the layers: it outlives the session
BOOKS = "bookkeeping"
RULES, TAGS, TABLE_TAGS = f"{BOOKS}.table_rules", f"{BOOKS}.column_tags", f"{BOOKS}.table_tags"
LINEAGE, COLUMN_LINEAGE = f"{BOOKS}.lineage", f"{BOOKS}.column_lineage"
OBJECTS, COLUMNS = f"{BOOKS}.objects", f"{BOOKS}.columns"
_OBJECT = "table_schema string, table_name string"
#: Columns of each book, and those that name a thing; a book without any is a history.
_BOOK = {
    RULES: ("table_name string, constraint_name string, expression string", ["table_name", "constraint_name"]),
    TAGS: (f"{_OBJECT}, column_name string, tag_name string, tag_value string",
           ["table_schema", "table_name", "column_name", "tag_name"]),
    TABLE_TAGS: (f"{_OBJECT}, tag_name string, tag_value string", ["table_schema", "table_name", "tag_name"]),
    OBJECTS: (f"{_OBJECT}, table_type string", ["table_schema", "table_name"]),
    COLUMNS: (f"{_OBJECT}, column_name string, data_type string, comment string",
              ["table_schema", "table_name", "column_name"]),
    LINEAGE: ("source_table string, source_path string, source_type string, target_schema string, "
              "target_table string, event_time timestamp", []),
    COLUMN_LINEAGE: ("source_table string, source_column string, target_table string, target_column string, "
                     "event_time timestamp", []),
}
_STAMP = "_at bigint, _gone boolean"


class SchemaMismatch(ValueError):
    """Columns offered to a table are not the columns it has."""


@dataclass(frozen=True)
class RunReport:
    """What one publish did: rows written, expectation counts, where the version is."""

    table: str
    version: str
    rows: int
    metrics: Mapping[str, int] = field(default_factory=dict)


def _name(table: str, env: str = "") -> str:
    schema, name = table.split(".")
    return f"`{env}{schema}`.`{name}`"


def _is(table: str) -> Column:
    schema, name = table.split(".")
    return (F.col("table_schema") == schema) & (F.col("table_name") == name)


@dataclass(frozen=True)
class Lake:
    """Databases under one root folder; `env` prefixes database names (one per environment)."""

    spark: SparkSession
    root: str
    env: str = ""

    def database(self, schema: str) -> str:
        return f"`{self.env}{schema}`"

    def create_schemas(self, *schemas: str) -> None:
        for schema in schemas:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(schema)} "
                           f"LOCATION '{self.root}/{schema}'")

    def drop_schema(self, schema: str) -> None:
        """Only an empty schema goes; one that holds tables is an error."""
        self.spark.sql(f"DROP DATABASE {self.database(schema)} RESTRICT")

    def exists(self, table: str) -> bool:
        if table in _BOOK:
            return self._is_folder(self._place(table))
        schema, name = table.split(".")
        return self.spark.catalog.tableExists(f"{self.database(schema)}.`{name}`")

    def read(self, table: str) -> DataFrame:
        """A table; of a book what it holds now, or all its rows where it is a history."""
        if table in _BOOK:
            return self.held(table) if _BOOK[table][1] else self.noted(table).drop("_at", "_gone")
        return self.spark.table(_name(table, self.env))

    def create_view(self, view: str, query: str, comments: Mapping[str, str]) -> None:
        """A stored view, read with the rights of whoever created it; columns as commented."""
        listed = ", ".join(f"`{c}` COMMENT '{text.replace(chr(39), chr(39) * 2)}'"
                           for c, text in comments.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {_name(view, self.env)} ({listed}) AS {query}")
        self._record(view, "VIEW", comments)

    def drop(self, table: str) -> None:
        """Remove a table from the catalog and from the books; its files, tags and rules stay."""
        self.spark.sql(f"DROP TABLE {_name(table, self.env)}")
        for book in (OBJECTS, COLUMNS):
            self.note(book, self.held(book).where(_is(table)), gone=True)

    def objects(self, *schemas: str) -> DataFrame:
        """Objects per schema, for a before/after comparison by name; from the books, however many."""
        return self.held(OBJECTS).where(F.col("table_schema").isin(list(schemas)))

    def columns(self, *schemas: str) -> DataFrame:
        """Columns of the listed schemas with their types and comments, from the books."""
        return self.held(COLUMNS).where(F.col("table_schema").isin(list(schemas)))

    def rules(self, table: str) -> list[Constraint]:
        """The CHECK rules bound to a table; a handful, read for each write to it."""
        kept = self.held(RULES).where(F.col("table_name") == table).orderBy("constraint_name")
        return [Constraint(r.constraint_name, r.table_name, r.expression) for r in kept.collect()]

    # ---- books ---------------------------------------------------------------------------

    def _place(self, book: str) -> str:
        return posixpath.join(self.root, *book.split("."))

    def note(self, book: str, rows: DataFrame, gone: bool = False) -> None:
        """Append rows to a book (action), in a folder of this writer alone; with `gone` they say that
        their keys hold nothing any more."""
        now = time.time_ns()
        columns = [c.split()[0] for c in _BOOK[book][0].split(", ")]
        (rows.select(*columns).withColumn("_at", F.lit(now)).withColumn("_gone", F.lit(gone))
         .write.mode("errorifexists").parquet(f"{self._place(book)}/run={now}-{uuid.uuid4().hex}"))

    def noted(self, book: str) -> DataFrame:
        """All rows ever appended, with `_at` and `_gone`; none where nothing was."""
        kind = f"{_BOOK[book][0]}, {_STAMP}"
        if not self._is_folder(self._place(book)):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(self._place(book)).drop("run")

    def held(self, book: str) -> DataFrame:
        """What a book says now: the last row of each key, unless that is a removal. Combined
        map-side, so a key noted a million times costs one row per task."""
        kind, keys = _BOOK[book]
        rest = [c.split()[0] for c in kind.split(", ") if c.split()[0] not in keys]
        last = self.noted(book).groupBy(*keys).agg(F.max(F.struct("_at", "_gone", *rest)).alias("_last"))
        return last.where("not _last._gone").select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest))

    def note_new(self, book: str, rows: DataFrame) -> None:
        """Note the rows whose keys the book has never seen, removed ones included (action)."""
        keys = _BOOK[book][1]
        new = rows.join(self.noted(book).select(*keys).distinct(), keys, "left_anti")
        if not new.isEmpty():
            self.note(book, new)

    def _record(self, table: str, kind: str, comments: Mapping[str, str] | None = None) -> None:
        """Note a new object and its columns."""
        schema, name = table.split(".")
        self.note(OBJECTS, literal(self.spark, [(schema, name, kind)], _BOOK[OBJECTS][0]))
        self.note(COLUMNS, literal(self.spark, [
            (schema, name, f.name, f.dataType.simpleString().upper(), (comments or {}).get(f.name))
            for f in self.read(table).schema.fields], _BOOK[COLUMNS][0]))

    def _is_folder(self, path: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(place)

    def delete_folder(self, path: str) -> None:
        """Remove a folder that no table points to."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)

    def schemas(self) -> DataFrame:
        names = [(d.name.removeprefix(self.env),) for d in self.spark.catalog.listDatabases()
                 if d.name.startswith(self.env) and d.name != f"{self.env}{BOOKS}"]
        return literal(self.spark, names, "schema_name string")

    def describe(self, table: str, comments: Mapping[str, str]) -> None:
        for column, text in comments.items():
            text = text.replace("'", "''")
            self.spark.sql(f"ALTER TABLE {_name(table, self.env)} ALTER COLUMN `{column}` "
                           f"COMMENT '{text}'")
        said = F.create_map(*(F.lit(x) for pair in comments.items() for x in pair))
        now = self.held(COLUMNS).where(_is(table) & F.col("column_name").isin(list(comments)))
        self.note(COLUMNS, now.withColumn("comment", said[F.col("column_name")]))

    # ---- staging -------------------------------------------------------------------------

    def _stage(self, table: str, df: DataFrame) -> str:
        version = posixpath.join(self.root, *table.split("."), f"v={uuid.uuid4().hex}")
        df.write.mode("errorifexists").parquet(version)
        return version

    def _swap(self, table: str, version: str) -> None:
        if not self.exists(table):
            self.spark.sql(f"CREATE TABLE {_name(table, self.env)} USING parquet "
                           f"LOCATION '{version}'")
            self._record(table, "MANAGED")
        else:
            self.spark.sql(f"ALTER TABLE {_name(table, self.env)} SET LOCATION '{version}'")
        self.spark.catalog.refreshTable(_name(table, self.env))


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def require_same_columns(target: DataFrame, offered: DataFrame, table: str) -> None:
    """Same names and types, in any order: the write then matches by name.

    By position, values would move between same-typed columns without an error.
    """
    have, new = _types(target), _types(offered)
    if have != new or len(target.columns) != len(offered.columns):
        wrong = sorted(set(have.items()) ^ set(new.items()))
        raise SchemaMismatch(f"{table} and the offered rows differ in {wrong}")


def add_constraint(lake: Lake, rule: Constraint, principal: Principal) -> None:
    """Bind a CHECK rule to its table (action). Rows already stored must pass; from then on every
    write has to. A second rule of one name on a table is refused."""
    require_exempt(principal)
    if any(r.name == rule.name for r in lake.rules(rule.table)):
        raise ValueError(f"{rule.table} has a CHECK named {rule.name} already")
    if lake.exists(rule.table):  # a rule for a table to come is resolved by the first write
        quality.enforce(lake.read(rule.table), [rule])
    lake.note(RULES, quality.constraint_rows(lake.spark, [rule]))


def drop_constraint(lake: Lake, table: str, name: str, principal: Principal) -> None:
    """Unbind a rule; later writes are no longer held to it, and no later build binds it again
    (action)."""
    require_exempt(principal)
    gone = [r for r in lake.rules(table) if r.name == name]
    if not gone:
        raise ValueError(f"{table} has no CHECK named {name}")
    lake.note(RULES, quality.constraint_rows(lake.spark, gone), gone=True)


def tag(lake: Lake, table: str, column: str, values: Mapping[str, str], principal: Principal) -> None:
    """Set tags of a column in the lake's book (action); values have to be in the vocabulary."""
    require_exempt(principal)
    tags.require_allowed(values)
    lake.note(TAGS, literal(lake.spark, [(*table.split("."), column, k, v) for k, v in values.items()], tags.TAG_SCHEMA))


def untag(lake: Lake, table: str, column: str, names: Sequence[str], principal: Principal) -> None:
    """Remove tags of a column (action); a later build does not set them again."""
    require_exempt(principal)
    lake.note(TAGS, literal(lake.spark, [(*table.split("."), column, k, None) for k in names], tags.TAG_SCHEMA), gone=True)


def tag_tables(lake: Lake) -> None:
    """Store each table's sensitivity, the highest of its columns', as a table tag (action). Tables
    whose stored tag says so already get no new row, and one without a classified column loses it."""
    now = tags.table_sensitivity(lake.held(TAGS)).select(
        "table_schema", "table_name", F.lit("sensitivity").alias("tag_name"), F.col("classification").alias("tag_value"))
    kept = lake.held(TABLE_TAGS)
    keys = _BOOK[TABLE_TAGS][1]
    new = now.join(kept, [*keys, "tag_value"], "left_anti")
    old = kept.where(F.col("tag_name") == "sensitivity").join(now, keys, "left_anti")
    for rows, gone in ((new, False), (old, True)):
        if not rows.isEmpty():
            lake.note(TABLE_TAGS, rows, gone)


def _rules(lake: Lake, table: str, more: Sequence[Constraint]) -> list[Constraint]:
    bound = lake.rules(table)
    return bound + [r for r in more if r.table == table and r not in bound]


def _discard(lake: Lake, version: str, check: Callable[[], None]) -> None:
    """Run a check on a staged version; if it fails, the version's files go."""
    try:
        check()
    except Exception:
        lake.delete_folder(version)
        raise


def publish(lake: Lake, df: DataFrame, table: str, principal: Principal,
            constraints: Sequence[Constraint] = (), expectations: Sequence[Expectation] = (),
            replace: bool = False) -> RunReport:
    """First build or full refill of a table (action).

    A refill matches columns by name against the existing table; `replace=True` lets the
    columns change. Expectations act on the rows as they are written and are counted in the
    same pass. The table's CHECK rules, and those given, are counted on the staged files, reading
    only their columns; an offending row is looked for only after a failure.
    """
    require_exempt(principal)
    spark = lake.spark
    if lake.exists(table) and not replace:
        target = lake.read(table)
        require_same_columns(target, df, table)
        df = df.select(*target.columns)
    metrics: dict[str, int] = {}
    if expectations:
        df, observed = quality.apply(df, expectations)
        version = lake._stage(table, df)
        metrics = dict(observed.get)
        _discard(lake, version, lambda: quality.raise_on_failed(expectations, metrics))
    else:
        version = lake._stage(table, df)
    staged = spark.read.schema(df.schema).parquet(version)
    rules = _rules(lake, table, constraints)
    found: dict = {}
    _discard(lake, version, lambda: found.update(quality.counted(staged, rules)))
    if replace and lake.exists(table) and list(_types(lake.read(table)).items()) != list(
            _types(df).items()):
        lake.drop(table)                # other columns need a new definition; files stay
    lake._swap(table, version)
    return RunReport(table, version, found["rows"], metrics)


def append(lake: Lake, rows: DataFrame, table: str, principal: Principal,
           constraints: Sequence[Constraint] = ()) -> RunReport:
    """Add rows after checking only them; a bad batch fails whole and leaves the table as it was.

    The batch is staged first, so what is checked is what is added. Columns not offered are NULL.
    The files are added to the current version.
    """
    require_exempt(principal)
    target = lake.read(table)
    have, offered = _types(target), _types(rows)
    wrong = sorted(c for c, kind in offered.items() if have.get(c) != kind)
    if wrong:
        raise SchemaMismatch(f"{table}: columns {wrong} are unknown or of another type")
    full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None))
                         .cast(f.dataType).alias(f.name) for f in target.schema.fields])
    batch = lake._stage(f"{table}_batch", full)
    try:
        staged = lake.spark.read.schema(full.schema).parquet(batch)
        found = quality.counted(staged, _rules(lake, table, constraints))
        staged.select(*target.columns).write.insertInto(_name(table, lake.env))
    finally:
        lake.delete_folder(batch)
    return RunReport(table, "", found["rows"])


def rewrite(lake: Lake, table: str, change: Callable[[DataFrame], DataFrame],
            principal: Principal, constraints: Sequence[Constraint] = ()) -> RunReport:
    """Update, delete or reshape in place: the changed rows become a new version."""
    return publish(lake, change(lake.read(table)), table, principal, constraints, replace=True)


def update(lake: Lake, table: str, column: str, value: Column, principal: Principal,
           where: Column | None = None, constraints: Sequence[Constraint] = ()) -> RunReport:
    """Set a column; with `where`, only on rows where it is TRUE."""
    new = value if where is None else F.when(where, value).otherwise(F.col(column))
    return rewrite(lake, table, lambda df: df.withColumn(column, new), principal, constraints)


def delete(lake: Lake, table: str, where: Column, principal: Principal) -> RunReport:
    """Remove rows for which the predicate is TRUE; a NULL verdict keeps the row."""
    return rewrite(lake, table, lambda df: df.where(~F.coalesce(where, F.lit(False))), principal)


def add_column(lake: Lake, table: str, column: str, value: Column,
               principal: Principal) -> RunReport:
    """Append a column at the end."""
    return rewrite(lake, table, lambda df: df.withColumn(column, value), principal)


def drop_column(lake: Lake, table: str, column: str, principal: Principal) -> RunReport:
    evolve.require_column(lake.read(table), column)
    df = lake.read(table)
    held = [r.name for r in lake.rules(table) if column.lower() in quality.columns_read(df, r.expr)]
    if held:
        raise ValueError(f"{column} of {table} is read by CHECK {', '.join(held)}: drop those first")
    return rewrite(lake, table, lambda df: df.drop(column), principal)


def migrate(lake: Lake, table: str, old: str, new: str, expression: Column,
            principal: Principal, derivation: Column | None = None,
            expected: Mapping[str, object] | None = None) -> RunReport:
    """Replace `old` by the coarser `new`, proved equal, in one swap (actions).

    Refuses to start when `old` is gone, so a second run changes nothing. Both columns are staged
    and read back before anything is published, and the stored one is proved twice: against
    `derivation`, which reads the old column another way (the expression itself where none is
    given), row by row, and by its fingerprint against one taken earlier (`expected`) or, without
    one, of the derivation on the published rows.
    """
    require_exempt(principal)
    before = lake.read(table)
    evolve.require_column(before, old)
    other = expression if derivation is None else derivation
    wanted = evolve.fingerprint(before, other).first().asDict() if expected is None else dict(expected)
    staging = lake._stage(f"{table}_migration", before.withColumn(new, expression))
    try:
        both = lake.spark.read.parquet(staging)
        mismatches = evolve.equivalent(both, new, other).first().mismatches
        got = evolve.fingerprint(both, new).first().asDict()
        if mismatches or got != wanted:
            raise evolve.MigrationRefused(f"{new} is not equivalent to {old}: {mismatches} mismatches, "
                                          f"{got} against {wanted}")
        return publish(lake, both.drop(old), table, principal, replace=True)
    finally:
        lake.delete_folder(staging)


def refresh_view(lake: Lake, name: str, query: DataFrame, principal: Principal,
                 expectations: Sequence[Expectation] = ()) -> tuple[RunReport, list[str]]:
    """Recompute a materialized view, and name every object the step leaves behind.

    The step owns its target and its expectation log; dropping the target does not drop the
    log, which is why callers compare object sets by name and not by count.
    """
    report = publish(lake, query, name, principal, expectations=expectations, replace=True)
    made = [name]
    if expectations:
        log = f"{name}_expectations"
        rows = quality.metric_rows(lake.spark, report.version.rsplit("=", 1)[-1], name,
                                   expectations, report.metrics)
        if lake.exists(log):
            append(lake, rows, log, principal)
        else:
            publish(lake, rows, log, principal)
        made.append(log)
    return report, made
