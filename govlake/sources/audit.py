"""The audit view: events whose parameters mention the catalog, nested fields projected.

The view runs with its owner's rights: readers get these columns without access to the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARAMS = "map<string,string>"         # the test events hold their parameters as JSON text


def audit_log(events: DataFrame, needle: str) -> DataFrame:
    """`events` columns: event_time, user_identity.email, service_name, action_name,
    request_params MAP, response.status_code."""
    return (events.where(F.to_json("request_params").contains(needle))
            .select(*(c for c in ("event_id",) if c in events.columns), "event_time", F.col("user_identity.email").alias("user_email"),
                    "service_name", "action_name", "request_params",
                    F.col("response.status_code").alias("status_code")))


def from_test_events(events: DataFrame) -> DataFrame:
    """The star-schema `events` table in the nested shape of an audit source."""
    return events.select(
        "event_id", F.col("ts").alias("event_time"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string"),
                          F.lit("@corp.example")).alias("email")).alias("user_identity"),
        F.when(F.col("event_id") % 3 == 0, "catalog").otherwise("sql").alias("service_name"),
        F.col("event_type").alias("action_name"),
        F.from_json("props", PARAMS).alias("request_params"),
        F.struct(F.when(F.col("event_type") == "error", "403").otherwise("200")
                 .alias("status_code")).alias("response"))


def recent(log: DataFrame, n: int) -> DataFrame:
    """The last `n` events; those of one time and user in a fixed order where they have an id."""
    ties = ["user_email", "action_name", *(c for c in ("event_id",) if c in log.columns)]
    return log.orderBy(F.col("event_time").desc(), *ties).limit(n)
