"""Not-modified revisit resolution: each revisit record takes the latest earlier full response of its canonical URL.

The as-of join runs in two levels, so that a URL with very many records is not
one task: records are dealt into stretches of time; within a stretch a window
carries the last full response, and the last one of the stretches before comes
from one row per URL and stretch. Payloads stay where they are; a resolved
record names the response it stands for.

A revisit is checked against that response: by entity tag where both have one
(weakly: W/ is dropped), else by modification time where both have one; without
a common validator it is unverified. A verified revisit gives the response with
the headers a not-modified answer may update taken from the revisit where it
has them, and all others from the response.

Defined results: a null URL resolves nothing; a null time comes before all
others; ties in time go by record_id, and equal record_ids by kind, so a
response at the same time and smaller id counts as earlier; repeated rows are
resolved alike; null headers count as none; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer may carry for the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't change the document.
TRACKING = "ref|utm_[a-z]+|fbclid|gclid"
STRETCH = 1 << 16


def canonical(url: Column) -> Column:
    """Host and path in one form: no scheme, leading www or m label, fragment, tracking parameters or closing slash; host in lower case."""
    rest = F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), "^(www|m)\\.", "")
    host = F.regexp_replace(host, ":(80|443)$", "")
    path = F.regexp_replace(rest, "^[^/?]*", "")
    path = F.regexp_replace(path, f"([?&])(?:(?:{TRACKING})=[^&]*(?:&|$))+", "$1")
    path = F.regexp_replace(path, "[?&]$", "")
    path = F.regexp_replace(path, "/$", "")
    return F.concat(host, path)


def _last(condition: Column, value: Column) -> Column:
    return F.last(F.when(condition, value), ignorenulls=True)


def resolve(records: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """record_id, response_id, outcome, url_key, headers of every revisit.

    `records`: record_id, kind ('response' or 'revisit'), url, time (long), headers (map of lower-case names).
    """
    rows = records.select(
        "record_id",
        "kind",
        canonical(F.col("url")).alias("url_key"),
        F.coalesce("time", F.lit(-(1 << 62))).alias("time"),
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    )
    rows = rows.withColumn("stretch", F.floor(F.col("time") / stretch))
    full = F.struct("time", "record_id", "headers")
    is_full = F.col("kind") == "response"
    ends = rows.filter(is_full & F.col("url_key").isNotNull()).groupBy("url_key", "stretch")
    ends = ends.agg(F.max_by(full, F.struct("time", "record_id")).alias("end"))
    marks = rows.select("url_key", "stretch").distinct().join(ends, ["url_key", "stretch"], "left")
    before = Window.partitionBy("url_key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("url_key", "stretch", F.last("end", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("url_key", "stretch").orderBy("time", "record_id", "kind").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("own", _last(is_full, full).over(within)).filter(F.col("kind") == "revisit")
    met = own.join(carried, ["url_key", "stretch"], "left").withColumn("r", F.coalesce("own", "carried"))
    met = met.withColumn("r", F.when(F.col("url_key").isNotNull(), F.col("r")))

    def tag(headers: str) -> Column:
        return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")

    def changed(headers: str) -> Column:
        return F.element_at(headers, "last-modified")

    has_tags = tag("headers").isNotNull() & tag("r.headers").isNotNull()
    has_times = changed("headers").isNotNull() & changed("r.headers").isNotNull()
    outcome = (
        F.when(F.col("r").isNull(), "no-response")
        .when(has_tags, F.when(tag("headers") == tag("r.headers"), "resolved").otherwise("changed"))
        .when(has_times, F.when(changed("headers") == changed("r.headers"), "resolved").otherwise("changed"))
        .otherwise("unverified")
    )
    updates = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    stays = F.map_filter("r.headers", lambda k, v: ~F.map_contains_key(updates, k))
    merged = F.map_concat(stays, updates)
    return met.withColumn("outcome", outcome).select(
        "record_id",
        F.when(F.col("outcome") == "resolved", F.col("r.record_id")).alias("response_id"),
        "outcome",
        "url_key",
        F.when(F.col("outcome") == "resolved", merged).alias("headers"),
    )


def header_lines(headers: Column) -> Column:
    """Headers as lines in the order of their names."""
    pairs = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(pairs, "\n")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Crawl records that `pages` stands for: a response for each page, and a later revisit of it.

    A response is taken at page_id, with the MD5 of its page as entity tag (not
    for every fifth page) and a modification time. Each page is visited again a
    million later, also one without a page_id, whose time is unknown; every
    seventh of these revisits carries another tag, and revisits of every
    eleventh page ask for an unknown URL.
    """
    p = F.col("page_id")
    tag = F.when(p % 5 != 0, F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"')))
    dated = F.concat(F.lit("t"), (p % 1000).cast("string"))

    def headers(*pairs) -> Column:
        whole = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs]))
        return F.map_filter(whole, lambda k, v: v.isNotNull())

    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    response = pages.select(
        (p * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        p.alias("time"),
        headers(
            ("content-type", F.lit("text/html")),
            ("content-length", size),
            ("date", F.concat(F.lit("d"), p.cast("string"))),
            ("etag", tag),
            ("last-modified", dated),
        ).alias("headers"),
    )
    again = pages.select(
        (p * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.when(p % 11 == 0, F.concat("url", F.lit("/gone"))).otherwise(F.col("url")).alias("url"),
        (p + 1_000_000).alias("time"),
        headers(
            ("content-length", F.lit("0")),
            ("date", F.concat(F.lit("d"), (p + 1_000_000).cast("string"))),
            ("etag", F.when(p % 7 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))),
            ("last-modified", dated),
            ("cache-control", F.when(p % 2 == 0, F.lit("max-age=60"))),
        ).alias("headers"),
    )
    return response.unionByName(again)
