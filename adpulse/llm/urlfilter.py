"""URL filters whose list changes over time.

A list is a log of dated entries: on a day a domain is added to a category or removed from it. The
entries of a domain and category become validity intervals, from the day of an addition to the day
of the next entry. A capture is filtered by what was listed on the day it was fetched: its own host
or any domain above it.

Captures meet the list as distinct pairs of host and day, so a hot host is at most as many rows as
there are days. Days and intervals are cut into spans of ``SPAN_DAYS``, and the as-of join is an
equality join on domain and span, within which only a span's days and intervals meet. The verdicts
go back to the captures by host and day.

Defined results: a null or relative url, or one without a host, is not blocked. Hosts are compared
in lower case, without user, port and final dot. A null day is not blocked. Of several entries of
one domain, category and day an addition counts. Entries without domain, category or day are
ignored. Repeated captures get a row each. Other columns of the captures pass through; those named
like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_DAYS = 32
ADDED, REMOVED = "add", "remove"

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)"


def host_of(url: str) -> Column:
    """Null if there is none."""
    found = F.lower(F.regexp_replace(F.regexp_extract(url, _HOST, 1), r"\.+$", ""))
    return F.when(found != "", found)


def domains_above(host: str) -> Column:
    """The host and every domain above it, but no top-level domain; the host alone if it is a
    number or has one label."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    all_above = F.transform(
        F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))),
        lambda k: F.array_join(F.slice(labels, k, size - k + 1), "."),
    )
    return F.when(F.col(host).rlike(r"^[0-9.]+$"), F.array(host)).otherwise(all_above)


def intervals(entries: DataFrame) -> DataFrame:
    """``domain, category, since, until`` (exclusive, null while it lasts) of a log of entries
    ``domain, category, day, action``."""
    # One entry per day: repeated entries of a hot domain end here.
    daily = (
        entries.where("domain is not null and category is not null and day is not null")
        .groupBy(F.lower("domain").alias("domain"), "category", "day")
        .agg(F.max(F.col("action") == ADDED).alias("added"))
    )
    following = Window.partitionBy("domain", "category").orderBy("day")
    return (
        daily.withColumn("until", F.lead("day").over(following))
        .where("added")
        .select("domain", "category", F.col("day").alias("since"), "until")
    )


def _span(day: Column | str) -> Column:
    return F.floor(F.unix_date(day) / SPAN_DAYS)


def verdicts(probes: DataFrame, listed: DataFrame) -> DataFrame:
    """``host, day, matched, categories, listed_on`` of those distinct pairs ``host, day`` that an
    interval covers: the longest domain listed, all categories, the latest addition."""
    last = probes.agg(F.max("day").alias("last"), F.min("day").alias("first")).first()
    if last["last"] is None:
        last = {"last": None, "first": None}
    first_day, last_day = F.lit(last["first"]).cast("date"), F.lit(last["last"]).cast("date")
    # Spans of an interval, no further than the captures go.
    low = F.greatest("since", first_day)
    high = F.least(F.coalesce(F.date_sub("until", 1), last_day), last_day)
    spans = listed.where(low <= high).select(
        "*", F.explode(F.sequence(_span(low), _span(high))).alias("span")
    )
    asked = probes.select(
        "host", "day", _span("day").alias("span"), F.explode(domains_above("host")).alias("domain")
    )
    covered = (F.col("day") >= F.col("since")) & (
        F.col("until").isNull() | (F.col("day") < F.col("until"))
    )
    found = asked.join(spans, ["domain", "span"]).where(covered)
    return found.groupBy("host", "day").agg(
        F.max_by("domain", F.length("domain")).alias("matched"),
        F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"),
        F.max("since").alias("listed_on"),
    )


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, day, and whatever else) with ``host, blocked, matched, categories,
    listed_on`` as of the day."""
    added = ("blocked", "matched", "categories", "listed_on")
    asked = captures.drop(*added).withColumn("host", host_of("url"))
    probes = asked.where("host is not null and day is not null").select("host", "day").distinct()
    found = verdicts(probes, intervals(entries))
    return asked.join(found, ["host", "day"], "left").withColumn(
        "blocked", F.col("matched").isNotNull()
    )
