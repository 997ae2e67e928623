"""The governance functions, as Column expressions that stay inside whole-stage codegen.

All are deterministic and use built-in functions only. Fixed values: the `***` text, the
four visible digits, the `-**-**` suffix and the hash input order are part of the results.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def mask_full(value: Column) -> Column:
    """`***` for every row, so a NULL cannot be told from a value."""
    return F.lit("***")


def mask_email(value: Column) -> Column:
    """First character and domain survive; NULL and the empty string pass through."""
    hidden = F.concat(F.left(value, F.lit(1)), F.lit("***@"),
                      F.split_part(value, F.lit("@"), F.lit(2)))
    return F.when(value.isNull() | (value == ""), value).otherwise(hidden)


def mask_last4(value: Column) -> Column:
    """Last four characters behind `****`. A value of four or fewer characters is shown whole."""
    return F.concat(F.lit("****"), F.right(value, F.lit(4)))


def pseudonymize(value: Column, version: int = 1) -> Column:
    """SHA-256 over value and key version. It has no secret: pseudonymous, not anonymous."""
    return F.sha2(F.concat(value, F.lit(str(int(version)))), 256)


def mask_dob(value: Column) -> Column:
    """Year of an ISO date held as text."""
    return F.concat(F.left(value, F.lit(4)), F.lit("-**-**"))


def mask_dob_date(value: Column) -> Column:
    """1 January of the year, for a DATE column. Retired once silver stores the year itself."""
    return F.make_date(F.year(value), F.lit(1), F.lit(1))


def filter_by_region(region: Column, allowed: str) -> Column:
    """True where the lower-cased region is in the comma list; NULL region gives NULL (no row)."""
    return F.array_contains(F.split(F.lit(allowed), ","), F.lower(region))


# name -> (function, input type, result type, number of arguments)
FUNCTIONS = {
    "mask_full": (mask_full, "STRING", "STRING", 1),
    "mask_email": (mask_email, "STRING", "STRING", 1),
    "mask_last4": (mask_last4, "STRING", "STRING", 1),
    "pseudonymize": (pseudonymize, "STRING", "STRING", 2),
    "mask_dob": (mask_dob, "STRING", "STRING", 1),
    "mask_dob_date": (mask_dob_date, "DATE", "DATE", 1),
    "filter_by_region": (filter_by_region, "STRING", "BOOLEAN", 2),
}


# the same functions for readers who write SQL; bodies are plain expressions, so they inline
SQL_BODIES = {
    "mask_full": ("val STRING", "'***'"),
    "mask_email": ("val STRING", "IF(val IS NULL OR val = '', val, "
                                 "left(val, 1) || '***@' || split_part(val, '@', 2))"),
    "mask_last4": ("val STRING", "'****' || right(val, 4)"),
    "pseudonymize": ("val STRING, version INT", "sha2(val || string(version), 256)"),
    "mask_dob": ("val STRING", "left(val, 4) || '-**-**'"),
    "mask_dob_date": ("val DATE", "make_date(year(val), 1, 1)"),
    "filter_by_region": ("region STRING, allowed STRING",
                         "array_contains(split(allowed, ','), lower(region))"),
}


def register_sql(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the functions for SQL: temporary, or kept in `database`. Returns their names."""
    made = []
    for name, (arguments, body) in SQL_BODIES.items():
        full = name if database is None else f"{database}.{name}"
        kind = "TEMPORARY FUNCTION" if database is None else "FUNCTION"
        spark.sql(f"CREATE OR REPLACE {kind} {full}({arguments}) "
                  f"RETURNS {FUNCTIONS[name][2]} RETURN {body}")
        made.append(full)
    return made
