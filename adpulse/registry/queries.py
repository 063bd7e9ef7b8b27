"""Every operator as a query over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adpulse.functions.days import as_day, days_between, shift
from adpulse.functions.event_time import with_event_time
from adpulse.functions.hours import HOUR, hours_between
from adpulse.model import (
    ALL_TYPES,
    EVENT_SCHEMA,
    GRACE_HOURS,
    KEYS,
    LATENESS,
    POST,
    POST_CLICK,
    POST_IMPRESSION,
    PRODUCT,
    PRODUCT_CLICK,
    PRODUCT_IMPRESSION,
    WALL_IMPRESSION,
    Pair,
)
from adpulse.operators import changes, counts, rates, selection, unions
from adpulse.plans import hourly, streams
from adpulse.plans.insights import (
    replace_count_change,
    replace_rate_change,
    write_count_change,
    write_rate_change,
)
from adpulse.plans.tables import COUNT_CHANGE_TABLE, COUNT_TABLE, RATE_CHANGE_TABLE
from adpulse.registry.dates import DAY, FIRST, GRACE_DAY, LAST, SPLIT
from adpulse.scratch import scratch_dir
from adpulse.sinks import catalog
from adpulse.sinks import daily as sink
from adpulse.sinks.files import make_dir
from adpulse.sources import drift, landing
from adpulse.sources.tables import table_counts, table_days, table_events, text_events
from adpulse.streaming import aggregates, runs

Query = Callable[[SparkSession, str], DataFrame]


# --- sources -------------------------------------------------------------------------


def _land_by_hour(spark: SparkSession, sf_dir: str, day: str | None = None) -> str:
    """Write events as JSON lines under the hour they landed in: all of them, or those of a
    day's landing hours, its grace hours and one more hour on each side, which no read of that
    day may touch. Hours without events are there as empty directories."""
    base = scratch_dir(spark, "landing")
    if day is None:
        events, days = table_events(spark, sf_dir), _days_of(spark, sf_dir)
        # The last day's events land on one more day.
        hours = [(d, h) for d in [*days, *(shift(d, 1) for d in days[-1:])] for h in range(24)]
        hours += [(shift(d, -1), 23) for d in days[:1]]
    else:
        first, last = shift(day, -1), shift(day, 1)
        hours = [(first, h) for h in range(23 - GRACE_HOURS, 24)]
        hours += [(as_day(day), h) for h in range(24)]
        hours += [(last, h) for h in range(GRACE_HOURS + 1)]
        # Events land within the hour, so those of the days before and after cover them.
        landed = F.concat_ws(" ", F.col("landing_date").cast("string"), "landing_hour")
        names = [f"{d} {h:02d}" for d, h in hours]
        events = table_events(spark, sf_dir, first=shift(first, -1), last=last)
        events = events.where(landed.between(names[0], names[-1]))
    for landing_day, hour in hours:
        make_dir(spark, f"{base}/{landing.PARTITIONED.hour_dir(landing_day, hour)}")
    (
        events.select(*EVENT_SCHEMA.names, "landing_date", "landing_hour")
        .hint("rebalance", "landing_date", "landing_hour")
        .write.mode("append")
        .partitionBy("landing_date", "landing_hour")
        .json(base)
    )
    return base


def scan_landing_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _land_by_hour(spark, sf_dir)
    rows = landing.read_landing_hours(spark, base, layout=landing.PARTITIONED)
    return rows.groupBy("landing_date").agg(
        F.count("*").alias("events"), F.count_distinct("landing_hour").alias("hours")
    )


def scan_with_grace(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _land_by_hour(spark, sf_dir, GRACE_DAY)
    landed = landing.read_landing(spark, base, GRACE_DAY, GRACE_HOURS, landing.PARTITIONED)
    span = selection.on_days(landed, GRACE_DAY)
    return span.groupBy("EVENT_TYPE", "event_date").agg(F.count("*").alias("events"))


def scan_days_with_grace(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _land_by_hour(spark, sf_dir)
    days = _days_of(spark, sf_dir)
    span = landing.read_landing_days(
        spark, base, days[0], days[-1], GRACE_HOURS, landing.PARTITIONED
    )
    return counts.event_counts(span, *ALL_TYPES, name="events")


def scan_landing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, table = _land_by_hour(spark, sf_dir, GRACE_DAY), scratch_dir(spark, "table")
    days = days_between(shift(GRACE_DAY, -1), shift(GRACE_DAY, 1))
    landing.store_landing(spark, base, table, days, landing.PARTITIONED)
    span = landing.read_landing_table(spark, table, GRACE_DAY, GRACE_HOURS)
    return (
        selection.on_days(span, GRACE_DAY)
        .groupBy("EVENT_TYPE", "landing_date", "landing_hour")
        .agg(F.count("*").alias("events"))
    )


def json_schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th line is cut off, and so is no JSON."""
    base = scratch_dir(spark, "json")
    line = F.to_json(F.struct(*EVENT_SCHEMA.names))
    cut = F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 10)).otherwise(line)
    table_events(spark, sf_dir).select(cut.alias("value")).write.text(base)
    rows = landing.read_json(spark, base, keep_malformed=True)
    return rows.groupBy("BRAND", "EVENT_TYPE").agg(
        F.count("*").alias("events"),
        F.count("CAMPAIGN_ID").alias("with_campaign"),
        F.count("ISOTIMESTAMP").alias("with_time"),
        F.count(landing.CORRUPT).alias("malformed"),
    )


def _late_landing(spark: SparkSession, sf_dir: str) -> tuple[str, str, list[dt.datetime]]:
    """Land and count all hours but for every 7th event of each day's hour 13, then close the hours
    and let those events arrive. Returns the landing directory, the counts' and the hours."""
    base, target = scratch_dir(spark, "landing"), scratch_dir(spark, "hourly")
    days = _days_of(spark, sf_dir)
    hours = hours_between(days[0], shift(days[-1], 2)) if days else []
    late = (F.col("event_id") % 7 == 0) & (F.col("landing_hour") == "13")
    for step in (~late, late):
        (
            table_events(spark, sf_dir)
            .where(step)
            .select(*EVENT_SCHEMA.names, "landing_date", "landing_hour")
            .hint("rebalance", "landing_date", "landing_hour")
            .write.mode("append")
            .partitionBy("landing_date", "landing_hour")
            .json(base)
        )
        if step is not late and hours:
            over = hours[-1] + hourly.CLOSE_AFTER * HOUR
            hourly.catch_up(
                spark, base, target, over, first=hours[0], layout=landing.PARTITIONED
            )
    return base, target, hours


def scan_late_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that arrived in closed hours, by hour."""
    base, target, hours = _late_landing(spark, sf_dir)
    late = hourly.late_events(spark, base, target, hours, landing.PARTITIONED)
    return late.drop("files")


def count_late_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by landing hour after the late hours, and no others, were counted again."""
    base, target, hours = _late_landing(spark, sf_dir)
    hourly.recount_late(spark, base, target, hours, landing.PARTITIONED)
    return hourly.merged_counts(spark, target)


def json_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th line has a field more, every 71st has its day as a number, every 89th lacks its
    campaign or has it null, every 97th is cut off."""
    base = scratch_dir(spark, "landing")
    n = F.col("event_id")
    more = F.when(n % 50 == 0, F.lit(", \"DEVICE\": {\"os\": \"x\"}")).otherwise(F.lit(""))
    campaign = F.when(n % 89 != 0, F.col("CAMPAIGN_ID"))
    names = [name for name in EVENT_SCHEMA.names if name not in ("DAY", "CAMPAIGN_ID")]
    line = F.to_json(F.struct(*names, campaign.alias("CAMPAIGN_ID")))
    quote = F.when(n % 71 == 0, F.lit("")).otherwise(F.lit('"'))
    day = F.concat(F.lit(', "DAY": '), quote, F.col("DAY").cast("int").cast("string"), quote)
    line = F.concat(F.substring(line, F.lit(1), F.length(line) - 1), day, more, F.lit("}"))
    cut = F.when(n % 97 == 0, F.substring(line, 1, 10)).otherwise(line)
    (
        table_events(spark, sf_dir)
        .select(cut.alias("value"), "landing_date", "landing_hour")
        .hint("rebalance", "landing_date", "landing_hour")
        .write.partitionBy("landing_date", "landing_hour")
        .text(base)
    )
    return drift.schema_drift(spark, base, layout=landing.PARTITIONED)


def union_by_name_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table_events(spark, sf_dir).select(*KEYS, "EVENT_TYPE")
    union = unions.union_reads(
        selection.of_type(events, *PRODUCT.types),
        selection.of_type(events, *POST.types).drop("CAMPAIGN_ID"),
        selection.of_type(events, WALL_IMPRESSION).drop("WALLGROUP_ID"),
    )
    return union.groupBy(*KEYS, "EVENT_TYPE").agg(F.count("*").alias("events"))


def event_time_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 89th time is no time, every 83rd other one is missing."""
    iso = F.when(F.col("event_id") % 89 == 0, "bad").when(
        F.col("event_id") % 83 != 0, F.col("ISOTIMESTAMP")
    )
    events = table_events(spark, sf_dir).withColumn("ISOTIMESTAMP", iso)
    return counts.event_time_quality(with_event_time(events.select(*EVENT_SCHEMA.names)))


# --- selections and counts -----------------------------------------------------------


def filter_type_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table_events(spark, sf_dir, (PRODUCT_IMPRESSION,), DAY, DAY)
    chosen = selection.on_days(selection.of_type(events, PRODUCT_IMPRESSION), DAY)
    return chosen.select("event_id", *KEYS, "EVENT_TYPE", "event_date")


def filter_type_day_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table_events(spark, sf_dir, (PRODUCT_IMPRESSION,))
    chosen = selection.on_day_label(selection.of_type(events, PRODUCT_IMPRESSION), DAY)
    return chosen.select("event_id", *KEYS, "EVENT_TYPE", "DAY")


def count_wall_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_event_time(text_events(spark, sf_dir, types=(WALL_IMPRESSION,)))
    return counts.event_counts(events, WALL_IMPRESSION)


def window_wall_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_event_time(text_events(spark, sf_dir, types=(WALL_IMPRESSION,)))
    windowed = aggregates.with_window_day(counts.windowed_counts(events, WALL_IMPRESSION))
    return windowed.select("event_date", *KEYS, "EVENT_TYPE", "impressions")


def _counts(kind: str, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return counts.event_counts(table_events(spark, sf_dir, (kind,)), kind, name=name)

    return query


# --- rates ---------------------------------------------------------------------------


def _rate(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rates.rate(table_events(spark, sf_dir, pair.types), pair)

    return query


def _rate_on_day(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table_events(spark, sf_dir, pair.types, DAY, DAY)
        return rates.rate(selection.on_days(events, DAY), pair)

    return query


def _count_sides(spark: SparkSession, sf_dir: str, pair: Pair) -> tuple[DataFrame, DataFrame]:
    return (
        _counts(pair.impression, "impressions")(spark, sf_dir),
        _counts(pair.click, "clicks")(spark, sf_dir),
    )


def _rate_join(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rates.rate_by_join(*_count_sides(spark, sf_dir, pair))

    return query


def rate_product_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = rates.join_counts(*_count_sides(spark, sf_dir, PRODUCT))
    return rates.rate_by_sql(spark, joined)


def _rate_from_counts(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rates.rate(table_counts(spark, sf_dir, pair.types), pair, count="impressions")

    return query


def count_pairs_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.join_counts(*_count_sides(spark, sf_dir, PRODUCT))


# --- day over day --------------------------------------------------------------------


def _rate_change(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table_events(spark, sf_dir, pair.types, shift(DAY, -1), DAY)
        return changes.rate_change(events, pair, DAY)

    return query


def _rate_changes(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return changes.rate_changes(table_events(spark, sf_dir, pair.types), pair, FIRST, LAST)

    return query


def dod_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table_events(spark, sf_dir, (WALL_IMPRESSION,), shift(DAY, -1), DAY)
    return changes.count_change(events, DAY, WALL_IMPRESSION)


def dod_wall_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table_events(spark, sf_dir, (WALL_IMPRESSION,))
    return changes.count_changes(events, FIRST, LAST, WALL_IMPRESSION)


def dod_rate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison as a full join of two days, grouped again afterwards: a NULL key matches
    nothing in the join and leaves two half rows."""
    events = table_events(spark, sf_dir, PRODUCT.types, shift(DAY, -1), DAY)
    daily = rates.rate(events, PRODUCT)
    previous, current = (
        selection.on_days(daily, day).select(*KEYS, F.col(rates.RATE).alias(name))
        for day, name in ((shift(DAY, -1), "previous"), (DAY, "current"))
    )
    return changes.regroup(changes.join_days(previous, current))


def dod_wall_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wall comparison through the join: inner, because both types must be equal."""
    daily = _counts(WALL_IMPRESSION, "impressions")(spark, sf_dir)
    previous, current = (
        selection.on_days(daily, day).select(
            *KEYS, F.col("EVENT_TYPE").alias(kind), F.col("impressions").alias(name)
        )
        for day, kind, name in (
            (shift(DAY, -1), "previous_type", "previous"),
            (DAY, "EVENT_TYPE", "current"),
        )
    )
    both = changes.join_days(previous, current).where(F.col("EVENT_TYPE") == F.col("previous_type"))
    return both.drop("previous_type")


# --- sinks ---------------------------------------------------------------------------


def _days_of(spark: SparkSession, sf_dir: str) -> list[dt.date]:
    """Every day from the first event to the last."""
    span = table_days(spark, sf_dir).first()
    return days_between(span.first_day, span.last_day) if span.first_day else []


def sink_daily_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then one of them again: every row is there once."""
    table = sink.collection(scratch_dir(spark, "metrics"), "daily", "wall_impressions")
    rows = count_wall_daily(spark, sf_dir)
    sink.overwrite_days(rows, table, _days_of(spark, sf_dir), types=(WALL_IMPRESSION,))
    sink.overwrite_day(rows, table, DAY, (WALL_IMPRESSION,))
    return sink.read_days(spark, table, COUNT_TABLE)


def sink_two_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two types in one table, then one of them again: both are there once."""
    table = sink.collection(scratch_dir(spark, "metrics"), "daily", "counts")
    days = _days_of(spark, sf_dir)
    for kind in (WALL_IMPRESSION, PRODUCT_CLICK, WALL_IMPRESSION):
        rows = _counts(kind, "impressions")(spark, sf_dir)
        sink.overwrite_days(rows, table, days, types=(kind,))
    return sink.read_days(spark, table, COUNT_TABLE)


def sink_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric, then another in its place."""
    table = sink.collection(scratch_dir(spark, "metrics"), "daily", "impressions")
    sink.replace_all(_counts(PRODUCT_IMPRESSION, "impressions")(spark, sf_dir), table)
    sink.replace_all(_counts(POST_IMPRESSION, "impressions")(spark, sf_dir), table)
    return sink.read_days(spark, table, COUNT_TABLE)


def _database(spark: SparkSession) -> str:
    """A new database in a folder of its own."""
    place = scratch_dir(spark, "database")
    database = f"daily_{place.split('/')[-2].split('-')[-1]}"
    catalog.ensure_database(spark, database, place)
    return database


def catalog_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named table in a named database: one metric, then another in its place, then a third
    beside it."""
    database = _database(spark)
    for kind in (PRODUCT_IMPRESSION, POST_IMPRESSION):
        rows = _counts(kind, "impressions")(spark, sf_dir)
        catalog.replace_table(rows, database, "impressions")
    catalog.append_table(_counts(WALL_IMPRESSION, "impressions")(spark, sf_dir), database, "impressions")
    return catalog.read_table(spark, database, "impressions").select(*COUNT_TABLE.names)


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics side by side in one named table."""
    table = sink.collection(scratch_dir(spark, "metrics"), "daily", "impressions")
    sink.append(_counts(PRODUCT_IMPRESSION, "impressions")(spark, sf_dir), table)
    sink.append(_counts(POST_IMPRESSION, "impressions")(spark, sf_dir), table)
    return sink.read_days(spark, table, COUNT_TABLE)


def insight_rate_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored daily rates to a stored comparison."""
    root = scratch_dir(spark, "metrics")
    stored, target = (sink.collection(root, "insights", name) for name in ("rates", "change"))
    sink.overwrite_days(_rate(PRODUCT)(spark, sf_dir), stored, _days_of(spark, sf_dir))
    write_rate_change(spark, stored, target, DAY)
    return sink.read_days(spark, target, RATE_CHANGE_TABLE)


def insight_count_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "metrics")
    stored, target = (sink.collection(root, "insights", name) for name in ("counts", "change"))
    rows, days = count_wall_daily(spark, sf_dir), _days_of(spark, sf_dir)
    sink.overwrite_days(rows, stored, days, types=(WALL_IMPRESSION,))
    write_count_change(spark, stored, target, DAY)
    return sink.read_days(spark, target, COUNT_CHANGE_TABLE)


#: Buckets of the tables that are laid out by key.
BUCKETS = 16


def insight_rate_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From daily rates in a table laid out by key, half of it appended, to a named comparison."""
    database, half = _database(spark), F.col("event_date") <= as_day(SPLIT)
    daily = _rate(PRODUCT)(spark, sf_dir)
    catalog.replace_table(daily.where(half), database, "rates", BUCKETS)
    catalog.append_table(daily.where(~half), database, "rates", BUCKETS)
    replace_rate_change(spark, database, "rates", "change", DAY)
    return catalog.read_table(spark, database, "change").select(*RATE_CHANGE_TABLE.names)


def insight_count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _database(spark)
    catalog.replace_table(count_wall_daily(spark, sf_dir), database, "counts", BUCKETS)
    replace_count_change(spark, database, "counts", "change", DAY)
    return catalog.read_table(spark, database, "change").select(*COUNT_CHANGE_TABLE.names)


# --- streams -------------------------------------------------------------------------


#: State partitions of the streams, which a stream keeps for good.
STATE_PARTITIONS = 8

#: Starts a job over the landing directory into an output directory.
Start = Callable[[SparkSession, str, str], StreamingQuery]


def _run_streams(
    spark: SparkSession,
    sf_dir: str,
    types: tuple[str, ...],
    jobs: dict[str, Start],
    arrivals: Callable[[], list[Column]] | None = None,
    between: Callable[[str], None] | None = None,
) -> dict[str, str]:
    """Land the events in two steps and run the jobs after each, the second time from their
    checkpoints. Returns each job's output directory.

    Each step is one micro-batch, so what counts as late does not depend on the order of
    files within it.
    """
    base = scratch_dir(spark, "stream")
    landed = F.col("landing_date")
    steps = arrivals() if arrivals else [landed <= as_day(SPLIT), landed > as_day(SPLIT)]
    for step in steps:
        (
            table_events(spark, sf_dir, types)
            .where(step)
            .select(*EVENT_SCHEMA.names)
            .write.mode("append")
            .json(f"{base}/landing")
        )
        for name, start in jobs.items():
            with runs.state_settings(spark, STATE_PARTITIONS):
                query = start(spark, f"{base}/landing", f"{base}/{name}")
            runs.wait(query)
            if between is not None:
                between(f"{base}/{name}")
    return {name: f"{base}/{name}" for name in jobs}


def _count_job(*types: str, **how) -> Start:
    return lambda spark, source, target: streams.stream_daily_counts(
        spark, source, target, *types, every=None, **how
    )


def _rate_job(pair: Pair, **how) -> Start:
    return lambda spark, source, target: streams.stream_daily_rate(
        spark, source, target, pair, every=None, **how
    )


def stream_wall_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = {"counts": _count_job(WALL_IMPRESSION)}
    out = _run_streams(spark, sf_dir, (WALL_IMPRESSION,), jobs)
    return streams.current_counts(spark, out["counts"]).drop("window")


def stream_wall_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = {"counts": _count_job(WALL_IMPRESSION, final=True)}
    out = _run_streams(spark, sf_dir, (WALL_IMPRESSION,), jobs)
    return streams.final_counts(spark, out["counts"]).drop("window")


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = (*PRODUCT.types, *POST.types)
    out = _run_streams(spark, sf_dir, types, {"counts": _count_job(*types)})
    counted = streams.current_counts(spark, out["counts"])
    return counted.drop("window").withColumnRenamed("impressions", "events")


def _stream_rate(pair: Pair) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = _run_streams(spark, sf_dir, pair.types, {"rate": _rate_job(pair)})
        return streams.current_rates(spark, out["rate"]).drop("window")

    return query


def stream_rate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate through a full join of two streaming counts: finished days only."""
    jobs = {"halves": _rate_job(PRODUCT, final=True)}
    out = _run_streams(spark, sf_dir, PRODUCT.types, jobs)
    return streams.final_rates(spark, out["halves"])


def stream_wall_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserts with the log folded into snapshots by the stream itself, and again between and
    after the runs."""
    out = _run_streams(
        spark,
        sf_dir,
        (WALL_IMPRESSION,),
        {"counts": _count_job(WALL_IMPRESSION, compact_every=2)},
        between=lambda target: streams.compact_counts(spark, target),
    )
    return streams.current_counts(spark, out["counts"]).drop("window")


def _stream_late(
    spark: SparkSession, sf_dir: str, waits: dict[str, str | None]
) -> dict[str, DataFrame]:
    """Wall counts of streams that wait this long, when the first landing day arrives
    after all the others."""
    landed = F.col("landing_date")
    out = _run_streams(
        spark,
        sf_dir,
        (WALL_IMPRESSION,),
        {name: _count_job(WALL_IMPRESSION, lateness=lateness) for name, lateness in waits.items()},
        arrivals=lambda: [landed > as_day(FIRST), landed <= as_day(FIRST)],
    )
    return {
        name: streams.current_counts(spark, target).drop("window") for name, target in out.items()
    }


def stream_wall_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events are dropped by a stream that waits an hour and counted by one that waits
    for ever."""
    results = _stream_late(spark, sf_dir, {"hour": LATENESS, "forever": None})
    hour, forever = (rows.withColumn("waits", F.lit(name)) for name, rows in results.items())
    return hour.unionByName(forever)


def stream_wall_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream that waits an hour has dropped."""
    streamed = _stream_late(spark, sf_dir, {"hour": LATENESS})["hour"]
    return counts.dropped_counts(count_wall_daily(spark, sf_dir), streamed)


QUERIES: dict[str, Query] = {
    "scan_landing_day": scan_landing_day,
    "scan_with_grace": scan_with_grace,
    "scan_days_with_grace": scan_days_with_grace,
    "scan_landing_table": scan_landing_table,
    "scan_late_hours": scan_late_hours,
    "count_late_hour": count_late_hour,
    "json_schema_contract": json_schema_contract,
    "json_schema_drift": json_schema_drift,
    "union_by_name_missing": union_by_name_missing,
    "event_time_quality": event_time_quality,
    "filter_type_day": filter_type_day,
    "filter_type_day_label": filter_type_day_label,
    "count_wall_daily": count_wall_daily,
    "window_wall_batch": window_wall_batch,
    "count_product_impressions": _counts(PRODUCT_IMPRESSION, "impressions"),
    "count_product_clicks": _counts(PRODUCT_CLICK, "clicks"),
    "count_post_impressions": _counts(POST_IMPRESSION, "impressions"),
    "count_post_clicks": _counts(POST_CLICK, "clicks"),
    "count_pairs_join": count_pairs_join,
    "rate_product": _rate(PRODUCT),
    "rate_post": _rate(POST),
    "rate_product_day": _rate_on_day(PRODUCT),
    "rate_post_day": _rate_on_day(POST),
    "rate_product_join": _rate_join(PRODUCT),
    "rate_post_join": _rate_join(POST),
    "rate_product_sql": rate_product_sql,
    "rate_product_from_counts": _rate_from_counts(PRODUCT),
    "rate_post_from_counts": _rate_from_counts(POST),
    "dod_rate_product": _rate_change(PRODUCT),
    "dod_rate_post": _rate_change(POST),
    "dod_rate_product_days": _rate_changes(PRODUCT),
    "dod_rate_post_days": _rate_changes(POST),
    "dod_rate_join": dod_rate_join,
    "dod_wall": dod_wall,
    "dod_wall_days": dod_wall_days,
    "dod_wall_join": dod_wall_join,
    "sink_daily_idempotent": sink_daily_idempotent,
    "sink_two_types": sink_two_types,
    "sink_replace_all": sink_replace_all,
    "sink_append": sink_append,
    "catalog_replace": catalog_replace,
    "insight_rate_product": insight_rate_product,
    "insight_count_wall": insight_count_wall,
    "insight_rate_by_key": insight_rate_by_key,
    "insight_count_by_key": insight_count_by_key,
    "stream_wall_daily": stream_wall_daily,
    "stream_wall_final": stream_wall_final,
    "stream_wall_upsert": stream_wall_upsert,
    "stream_wall_late": stream_wall_late,
    "stream_wall_dropped": stream_wall_dropped,
    "stream_counts": stream_counts,
    "stream_rate_latest": _stream_rate(PRODUCT),
    "stream_rate_post": _stream_rate(POST),
    "stream_rate_join": stream_rate_join,
}
