"""Data quality in four modes: prevent, drop, observe, preserve.

NULL differs by mode, on purpose: a filter drops NULL, a CHECK lets NULL pass, an expectation
counts NULL as a failure. Every report here is one aggregate over one scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from govlake.design import Constraint, Expectation
from govlake.functions.rows import literal


class ConstraintViolation(ValueError):
    """A write broke a CHECK rule; nothing of the batch was published."""


class ExpectationFailed(ValueError):
    """A fail-mode expectation was broken; nothing of the batch was published."""


class UnsafeConstraint(ValueError):
    """A CHECK expression whose answer could change without the row changing."""


# ---- preserve: classify once, split in two -------------------------------------------------

def classify(df: DataFrame, rules: Sequence[tuple[str, Column]],
             column: str = "reject_reason") -> DataFrame:
    """Add the name of the first rule a row fails, NULL where it fails none."""
    reason = F.lit(None).cast("string")
    for name, failed in reversed(rules):
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    return df.withColumn(column, reason)


def split(labelled: DataFrame, column: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted without the label, rejected with it)."""
    accepted = labelled.where(F.col(column).isNull()).drop(column)
    return accepted, labelled.where(F.col(column).isNotNull())


def reject_report(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row, one count per table, each read without any of its columns."""
    first, *rest = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    return first.select(first.columns[0], *[r.scalar().alias(r.columns[0]) for r in rest])


def reconcile(name: str, source: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Source, kept and quarantined counts; the difference must be zero."""
    counts = row_counts(bronze_rows=source, silver_rows=kept, quarantined=rejected)
    return counts.select(
        F.lit(name).alias("tbl"), "bronze_rows", "silver_rows", "quarantined",
        (F.col("silver_rows") + F.col("quarantined") - F.col("bronze_rows"))
        .alias("difference_must_be_zero"))


def reconcile_outcomes(name: str, source: DataFrame, outcomes: DataFrame) -> DataFrame:
    """`reconcile` where kept and quarantined come as counts per reason (NULL = kept)."""
    kept = F.col("reject_reason").isNull()
    counts = outcomes.agg(
        F.coalesce(F.sum(F.when(kept, F.col("n_rows"))), F.lit(0)).alias("silver_rows"),
        F.coalesce(F.sum(F.when(~kept, F.col("n_rows"))), F.lit(0)).alias("quarantined"))
    total = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(
        F.lit(name).alias("tbl"), total.alias("bronze_rows"), "silver_rows", "quarantined",
        (F.col("silver_rows") + F.col("quarantined") - total).alias("difference_must_be_zero"))


def cast_loss(raw: DataFrame, casts: dict[str, Column]) -> DataFrame:
    """Per typed column: NULLs after typing, and how many of them had a value before."""
    source = {name: F.col(name) for name in casts}
    aggregates = []
    for name, typed in casts.items():
        aggregates += [F.count_if(typed.isNull()).alias(f"{name}_null"),
                       F.count_if(typed.isNull() & source[name].isNotNull())
                       .alias(f"{name}_unparseable")]
    return raw.agg(*aggregates)


def referential(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent. Both sides shrink to distinct keys first, so a key
    held by most of the children travels once per map task."""
    keys = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (keys.join(parent.select(key).distinct(), key, "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans")))


def unique(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows_total"),
                  F.count_distinct(key).alias("keys_distinct"))


def leading_zeros(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).like("0%")).alias(f"{c}_leading_zero") for c in columns])


def fidelity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, rescued rows and surviving zeros in front: did ingestion change anything?"""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_rescued_data").isNotNull()).alias("rescued_rows"),
        *[F.count_if(F.col(c).like("0%")).alias(f"{c}_leading_zero") for c in columns])


def _counted(df: DataFrame, column: str, weight: str | None) -> DataFrame:
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(F.col(column).alias("value")).agg(n.alias("n"))


def profile(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """value, count and share of all rows; the total is summed over the groups, not rescanned.

    `weight` names a count column when `df` is already grouped."""
    groups = _counted(df, column, weight)
    total = groups.agg(F.sum("n")).scalar()
    return groups.select("value", "n", F.round(F.col("n") / total, 4).alias("share"))


def vocabulary_diff(df: DataFrame, column: str, allowed: Sequence[str],
                    weight: str | None = None) -> DataFrame:
    """Values in the data against the approved list: ok, unexpected, or absent."""
    listed = (literal(df.sparkSession, [(v,) for v in allowed], "value string")
              .select("value", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("listed")))
    found = _counted(df, column, weight).select("value", "n", F.lit(False).alias("listed"))
    merged = found.unionByName(listed).groupBy("value").agg(
        F.sum("n").alias("n"), F.bool_or("listed").alias("listed"))
    return merged.select("value", "n", F.when(~F.col("listed"), "unexpected")
                         .when(F.col("n") == 0, "absent").otherwise("ok").alias("status"))


# ---- prevent: CHECK on write ---------------------------------------------------------------

def _condition(df: DataFrame, expression: str):
    """The predicate as Spark resolves it against the columns of `df`; nothing is run."""
    return df.where(F.expr(expression))._jdf.queryExecution().analyzed().condition()


def columns_read(df: DataFrame, expression: str) -> set[str]:
    """Lower-case names of the columns that a predicate reads, by its resolved references: a name in
    a text literal or a field of a struct is none."""
    found = _condition(df, expression).references().toSeq()
    return {found.apply(i).name().lower() for i in range(found.size())}


def validate_constraint(rule: Constraint, df: DataFrame) -> Constraint:
    """A CHECK may look at one row only. The resolved predicate tells what it does: an answer that
    depends on chance or on where it runs is marked nondeterministic, one that depends on time, user
    or session carries the mark of the values that Spark fills in per query, subqueries are plans,
    and aggregates and windows do not resolve in a predicate. No function is known by its name."""
    try:
        found = _condition(df, rule.expr)
    except AnalysisException as wrong:
        raise UnsafeConstraint(f"CHECK {rule.name} is no predicate over one row: {wrong}") from wrong
    pattern = df.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    faults = {"chance or place": not found.deterministic(),
              "time, user or session": found.containsPattern(pattern.CURRENT_LIKE()),
              "other rows": found.containsPattern(pattern.PLAN_EXPRESSION())}
    if any(faults.values()):
        raise UnsafeConstraint(f"CHECK {rule.name} ({rule.expr}) depends on "
                               f"{', '.join(k for k, v in faults.items() if v)}: only deterministic "
                               "expressions over one row are allowed")
    return rule


def _broken(expression: str) -> Column:
    return F.coalesce(~F.expr(expression), F.lit(False))


def violation_aggregates(df: DataFrame, rules: Sequence[Constraint]) -> list[Column]:
    """Per rule a count and one offending row as JSON (the smallest, so it is repeatable)."""
    row = F.to_json(F.struct(*df.columns))
    out = []
    for i, rule in enumerate(rules):
        bad = _broken(validate_constraint(rule, df).expr)
        out += [F.count_if(bad).alias(f"n{i}"), F.min(F.when(bad, row)).alias(f"sample{i}")]
    return out


def check(df: DataFrame, rules: Sequence[Constraint]) -> DataFrame:
    """name, expression, violations, sample: one row per rule, from one aggregate."""
    counts = df.agg(*violation_aggregates(df, rules))
    entries = [F.struct(F.lit(r.name).alias("name"), F.lit(r.expr).alias("expression"),
                        F.col(f"n{i}").alias("violations"), F.col(f"sample{i}").alias("sample"))
               for i, r in enumerate(rules)]
    return counts.select(F.inline(F.array(*entries)))


def raise_on(rules: Sequence[Constraint], found: dict) -> None:
    """Raise for the first broken rule of an aggregate made by `violation_aggregates`."""
    for i, rule in enumerate(rules):
        if found[f"n{i}"]:
            raise ConstraintViolation(
                f"CHECK {rule.name} ({rule.expr}) on {rule.table} violated by "
                f"{found[f'n{i}']} row(s), e.g. {found[f'sample{i}']}")


def counted(df: DataFrame, rules: Sequence[Constraint]) -> dict:
    """`rows` of a frame whose rules all hold, from one scan of the rules' columns; else raise, for
    which one offending row is fetched (actions)."""
    found = df.agg(F.count(F.lit(1)).alias("rows"),
                   *[F.count_if(_broken(validate_constraint(r, df).expr)).alias(f"n{i}")
                     for i, r in enumerate(rules)]).first().asDict()
    if any(found[f"n{i}"] for i in range(len(rules))):
        enforce(df, rules)
    return found


def enforce(df: DataFrame, rules: Sequence[Constraint]) -> None:
    """Check now and raise, naming the rule, its expression and an offending row (action)."""
    if rules:
        raise_on(rules, df.agg(*violation_aggregates(df, rules)).first().asDict())


def constraint_rows(df_or_session, rules: Iterable[Constraint]) -> DataFrame:
    spark = getattr(df_or_session, "sparkSession", df_or_session)
    return literal(spark, [(r.table, r.name, r.expr) for r in rules],
                   "table_name string, constraint_name string, expression string")


def constraint_diff(actual: DataFrame, expected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rules missing, extra or weakened (same name, other expression), against the design; `by` names
    further keys of both relations."""
    def tagged(df: DataFrame, side: str) -> DataFrame:
        other = "expected" if side == "actual" else "actual"
        return df.select(*by, "table_name", "constraint_name",
                         F.col("expression").alias(side),
                         F.lit(None).cast("string").alias(other))
    both = (tagged(actual, "actual").unionByName(tagged(expected, "expected"))
            .groupBy(*by, "table_name", "constraint_name")
            .agg(F.max("expected").alias("expected"), F.max("actual").alias("actual")))
    status = (F.when(F.col("actual").isNull(), "missing")
               .when(F.col("expected").isNull(), "extra")
               .when(F.col("actual") != F.col("expected"), "changed").otherwise("ok"))
    return both.withColumn("status", status)


# ---- drop and observe: expectations of a build step ----------------------------------------

def _met(expression: str) -> Column:
    return F.coalesce(F.expr(expression), F.lit(False))


def expectation_counts(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """expectation, mode, passed, failed over the incoming rows, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count_if(~_met(r.expr)).alias(f"f{i}") for i, r in enumerate(rules)])
    entries = [F.struct(F.lit(r.name).alias("expectation"), F.lit(r.mode).alias("mode"),
                        (F.col("n") - F.col(f"f{i}")).alias("passed"),
                        F.col(f"f{i}").alias("failed")) for i, r in enumerate(rules)]
    return counts.select(F.inline(F.array(*entries)))


def drop_rows(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    for rule in rules:
        if rule.mode == "drop":
            df = df.where(_met(rule.expr))
    return df


def apply(df: DataFrame, rules: Sequence[Expectation]) -> tuple[DataFrame, Observation]:
    """The rows to publish, and counts that fill in as they are written (no second pass).

    Read `observation.get` after the write: keys `total` and `failed_<name>`.
    """
    observation = Observation()
    observed = df.observe(
        observation, F.count(F.lit(1)).alias("total"),
        *[F.count_if(~_met(r.expr)).alias(f"failed_{r.name}") for r in rules])
    return drop_rows(observed, rules), observation


def raise_on_failed(rules: Sequence[Expectation], metrics: dict) -> None:
    for rule in rules:
        failed = metrics.get(f"failed_{rule.name}", 0)
        if rule.mode == "fail" and failed:
            raise ExpectationFailed(f"expectation {rule.name} ({rule.expr}) failed for "
                                    f"{failed} row(s); nothing was published")


def metric_rows(spark, run: str, table: str, rules: Sequence[Expectation],
                metrics: dict) -> DataFrame:
    """Rows for the expectation log: one per rule and run."""
    total = metrics.get("total", 0)
    return literal(
        spark, [(run, table, r.name, r.mode, total - metrics.get(f"failed_{r.name}", 0),
                 metrics.get(f"failed_{r.name}", 0)) for r in rules],
        "run string, table_name string, expectation string, mode string, passed bigint, "
        "failed bigint")
