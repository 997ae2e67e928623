"""Not-modified revisit records of web archives, resolved to the responses they stand for.

An as-of join by canonical URL finds the latest earlier full response; validators decide whether
the revisit may stand for it, and the headers a 304 may renew are merged into the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import last_before

# The header fields that a not-modified answer may renew in a stored response.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical(url: Column) -> Column:
    """Scheme and fragment dropped, host lower-cased without www. and default port, query without
    utm_ parameters and in sorted order, one closing slash of the path dropped. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.", ""),
                            r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/$", "")
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"),
                                 lambda p: (p != "") & ~p.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                    .otherwise(F.lit("")))


def _matches(mine: Column, theirs: Column) -> Column:
    """null where either side lacks the validator."""
    strip = lambda c: F.regexp_replace(c, r"^W/", "")  # noqa: E731  weak comparison
    return strip(mine) == strip(theirs)


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of `records`, which has record_id, warc_type, url, captured_at (long),
    status (int), truncated (boolean), digest (of the payload) and headers (map, lower-case names).

    outcome is `resolved`; `no earlier response`, also for null or empty URLs and times; or
    `validators differ`: a digest both carry decides, else the ETag, else Last-Modified; without
    one that both carry the outcome is `no validator`. refers_to names the response looked at; of
    responses of one time the greatest record_id counts. Only an outcome `resolved` has payload
    digest and merged headers: those of the response, renewed by what the revisit sent of the
    fields in RENEWED. Full means status 200 and not truncated. Repeated revisits stay. Only
    metadata moves: bodies can be joined by refers_to afterwards.
    """
    part = records.select(
        "record_id", "warc_type", "captured_at", "digest", "headers",
        F.when(F.col("url") != "", canonical(F.col("url"))).alias("site"),
        ((F.col("status") == 200) & ~F.coalesce("truncated", F.lit(False))).alias("full"))
    rows = (part.where("site is not null and captured_at is not null and "
                       "(warc_type = 'revisit' or warc_type = 'response' and full)")
            .withColumn("kind", F.when(F.col("warc_type") == "response", 1).otherwise(0)))
    stored = F.when(F.col("kind") == 1, F.struct("site", "record_id", "digest", "headers"))
    # a revisit sorts before responses of its own time: those are not earlier
    found = (last_before(rows, ["site", "captured_at", "kind", "record_id", "digest"], stored, "seen")
             .where("warc_type = 'revisit'")
             .withColumn("seen", F.when(F.col("seen.site") == F.col("site"), F.col("seen"))))
    lost = (part.where("warc_type = 'revisit' and (site is null or captured_at is null)")
            .select("record_id", "captured_at", "site", "digest", "headers",
                    F.lit(None).cast(found.schema["seen"].dataType).alias("seen")))
    every = found.select(*lost.columns).unionByName(lost)
    agree = F.coalesce(
        F.col("digest") == F.col("seen.digest"),
        _matches(F.col("headers")["etag"], F.col("seen.headers")["etag"]),
        F.col("headers")["last-modified"] == F.col("seen.headers")["last-modified"])
    outcome = (F.when(F.col("seen").isNull(), "no earlier response").when(agree, "resolved")
               .when(agree.isNull(), "no validator").otherwise("validators differ"))
    renewing = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")),
                            lambda k, v: k.isin(*RENEWED) & v.isNotNull())
    old = F.coalesce("seen.headers", F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(renewing), k)), renewing)
    text = F.array_join(F.array_sort(F.transform(F.map_entries(merged),
                                                 lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    done = F.col("outcome") == "resolved"
    return (every.withColumn("outcome", outcome)
            .select("record_id", F.col("site").alias("canonical_url"), "captured_at", "outcome",
                    F.col("seen.record_id").alias("refers_to"),
                    F.when(done, F.col("seen.digest")).alias("payload_digest"),
                    F.when(done, text).alias("headers")))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records derived from pages, four captures of each: a first response (every seventh
    a 404, every eleventh cut off), a second crawl of every other page with a changed body, and two
    not-modified revisits. By page_id the revisits carry an ETag, a date, a payload digest or
    nothing, and every fifth an outdated validator. Null page_id, url and html give null fields."""
    page = pages.select("page_id", "url", F.sha2(F.coalesce("html", F.lit("")), 256).alias("body"))
    n = F.col("page_id")
    old, new = F.col("body"), F.sha2(F.concat("body", F.lit("+")), 256)
    newer = F.when(n % 2 == 0, new).otherwise(old)
    sent = F.when(n % 5 == 0, F.sha2(F.lit("outdated"), 256)).otherwise(newer)

    def tag(body: Column) -> Column:
        return F.concat(F.lit('"'), F.substring(body, 1, 16), F.lit('"'))

    def record(k: int, kind: str, status: Column, digest: Column, headers: Column, when: Column) -> Column:
        return F.struct((n * 4 + k).alias("record_id"), F.lit(kind).alias("warc_type"),
                        (n * 100 + 10 * k).alias("captured_at"), status.cast("int").alias("status"),
                        (n % 11 == 3).alias("truncated") if k == 0 else F.lit(False).alias("truncated"),
                        digest.alias("digest"), headers.alias("headers"), when.alias("present"))

    def heads(*pairs: tuple[str, Column]) -> Column:
        return F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value"))
                                                     for k, v in pairs)), lambda e: e["value"].isNotNull()))

    none = F.lit(None).cast("string")
    day = F.concat(F.lit("day "), n.cast("string"))
    full = lambda b: heads(("content-type", F.lit("text/html")), ("etag", tag(b)),
                           ("last-modified", F.concat(F.lit("as of "), F.substring(b, 1, 8))), ("date", day))
    kind = n % 4
    ask = heads(("content-type", F.lit("text/plain")), ("date", F.concat(day, F.lit(" again"))),
                ("etag", F.when(kind == 0, F.concat(F.lit("W/"), tag(sent)))),
                ("last-modified", F.when(kind == 1, F.concat(F.lit("as of "), F.substring(sent, 1, 8)))))
    yes = F.lit(True)
    made = F.array(
        record(0, "response", F.when(n % 7 == 3, 404).otherwise(200), old, full(old), yes),
        record(1, "response", F.lit(200), new, full(new), n % 2 == 0),
        record(2, "revisit", F.lit(304), F.when(kind == 2, sent), ask, yes),
        record(3, "revisit", F.lit(304), F.when(kind >= 1, sent), ask, yes))
    return (page.select("url", F.explode(made).alias("r")).where("r.present")
            .select("url", "r.record_id", "r.warc_type", "r.captured_at", "r.status", "r.truncated",
                    "r.digest", "r.headers"))
