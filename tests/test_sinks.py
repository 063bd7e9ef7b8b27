"""Metric tables: reruns, empty days, replacement, failure."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adpulse.model import KEYS, PRODUCT, PRODUCT_CLICK, PRODUCT_IMPRESSION, WALL_IMPRESSION
from adpulse.operators.counts import event_counts
from adpulse.operators.rates import rate
from adpulse.plans.insights import write_count_change, write_rate_change
from adpulse.plans.tables import (
    COUNT_CHANGE_TABLE,
    COUNT_TABLE,
    RATE_CHANGE_TABLE,
    RATE_TABLE,
)
from adpulse.sinks import catalog
from adpulse.sinks.daily import (
    append,
    collection,
    overwrite_day,
    overwrite_range,
    read_days,
    replace_all,
)
from tests.events import frame, many, rows

A = ("a", "w", "g", "c")
D29, D30 = dt.date(2021, 6, 29), dt.date(2021, 6, 30)


def walls(spark, n29, n30):
    events = many(n29, A, WALL_IMPRESSION, "2021-06-29T12:00:00Z")
    events += many(n30, A, WALL_IMPRESSION, "2021-06-30T12:00:00Z")
    return event_counts(frame(spark, events), WALL_IMPRESSION)


def stored(spark, path, *days):
    return rows(read_days(spark, path, COUNT_TABLE, *days), "event_date", "impressions")


@pytest.fixture
def table(tmp_path):
    return collection(str(tmp_path), "db", "counts")


def test_rerun_does_not_duplicate(spark, table):
    for _ in range(2):
        overwrite_range(walls(spark, 2, 3), table, D29, D30)
    assert stored(spark, table) == [(D29, 2), (D30, 3)]


def test_only_the_day_asked_for_is_replaced(spark, table):
    overwrite_range(walls(spark, 2, 3), table, D29, D30)
    overwrite_day(walls(spark, 20, 30), table, D30)
    assert stored(spark, table) == [(D29, 2), (D30, 30)]
    assert stored(spark, table, D30) == [(D30, 30)]
    assert stored(spark, table, None, D29) == [(D29, 2)]


def test_a_day_that_became_empty_is_cleared(spark, table):
    overwrite_range(walls(spark, 2, 3), table, D29, D30)
    overwrite_day(walls(spark, 2, 3).where("impressions > 100"), table, D30)
    assert stored(spark, table) == [(D29, 2)]
    nothing = spark.createDataFrame([], COUNT_TABLE)
    overwrite_day(nothing, table, D29)
    assert stored(spark, table) == []


def test_failed_write_keeps_the_old_day(spark, table):
    overwrite_range(walls(spark, 2, 3), table, D29, D30)
    broken = walls(spark, 2, 3).withColumn(
        "impressions", F.raise_error(F.lit("broken")).cast("long")
    )
    with pytest.raises(Exception, match="broken"):
        overwrite_day(broken, table, D30)
    assert stored(spark, table) == [(D29, 2), (D30, 3)]


def test_replace_all_and_append(spark, table):
    replace_all(walls(spark, 2, 3), table)
    replace_all(walls(spark, 5, 0), table)
    assert stored(spark, table) == [(D29, 5)]
    append(walls(spark, 5, 1), table)
    assert stored(spark, table) == [(D29, 5), (D29, 5), (D30, 1)]


def test_a_large_day_is_split_and_small_days_are_not(spark, tmp_path):
    """Two thirds of the rows on one day: its rows go to several files, not to one task."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    many_rows = spark.range(300_000).selectExpr(
        *[f"string(uuid()) AS {key}" for key in KEYS],
        "'t' AS EVENT_TYPE",
        "id AS impressions",
        "date_add(DATE '2021-06-01', int(if(id % 3 < 2, 0, id % 29 + 1))) AS event_date",
    )
    spark.conf.set(size, "4MB")
    try:
        overwrite_range(many_rows, f"{tmp_path}/t", "2021-06-01", "2021-06-30")
    finally:
        spark.conf.set(size, before)
    stored_rows = read_days(spark, f"{tmp_path}/t", COUNT_TABLE)
    files = [file.split("event_date=")[1][:10] for file in stored_rows.inputFiles()]
    per_day = {day: files.count(day) for day in files}
    assert len(per_day) == 30 and per_day.pop("2021-06-01") >= 3
    # Only days that share the large one's shuffle partition are split along with it.
    assert sum(files <= 2 for files in per_day.values()) > 15
    assert stored_rows.count() == 300_000


def test_insights_read_what_the_daily_jobs_stored(spark, tmp_path):
    events = frame(
        spark,
        many(4, A, PRODUCT_IMPRESSION, "2021-06-29T12:00:00Z")
        + many(2, A, PRODUCT_CLICK, "2021-06-29T12:00:00Z")
        + many(6, A, PRODUCT_IMPRESSION, "2021-06-30T12:00:00Z")
        + many(2, A, PRODUCT_CLICK, "2021-06-30T12:00:00Z"),
    )
    rates, counts = f"{tmp_path}/rates", f"{tmp_path}/counts"
    for day in (D29, D30):
        overwrite_day(rate(events, PRODUCT), rates, day)
        overwrite_day(event_counts(events, PRODUCT_IMPRESSION), counts, day)
    assert read_days(spark, rates, RATE_TABLE).count() == 2
    for _ in range(2):
        write_rate_change(spark, rates, f"{tmp_path}/rate_change", D30)
        write_count_change(spark, counts, f"{tmp_path}/count_change", D30)
    changed = read_days(spark, f"{tmp_path}/rate_change", RATE_CHANGE_TABLE)
    assert rows(changed, "event_date", "previous", "current", "pct_change") == [
        (D30, 2.0, 3.0, 50.0)
    ]
    changed = read_days(spark, f"{tmp_path}/count_change", COUNT_CHANGE_TABLE)
    assert rows(changed, "event_date", "previous", "current", "pct_change") == [(D30, 4, 6, 50.0)]
    # The files really hold the declared types.
    for name, table in (("rate", RATE_CHANGE_TABLE), ("count", COUNT_CHANGE_TABLE)):
        found = spark.read.parquet(f"{tmp_path}/{name}_change").dtypes
        assert sorted(found) == sorted((f.name, f.dataType.simpleString()) for f in table)


def test_a_comparison_without_common_groups_is_empty(spark, tmp_path):
    overwrite_range(walls(spark, 2, 0), f"{tmp_path}/counts", D29, D30)
    write_count_change(spark, f"{tmp_path}/counts", f"{tmp_path}/change", D30)
    assert read_days(spark, f"{tmp_path}/change", COUNT_CHANGE_TABLE).count() == 0


def test_two_types_share_a_table(spark, tmp_path, table):
    events = many(2, A, WALL_IMPRESSION, "2021-06-30T12:00:00Z")
    events += many(3, A, PRODUCT_CLICK, "2021-06-30T12:00:00Z")
    for kind in (WALL_IMPRESSION, PRODUCT_CLICK, WALL_IMPRESSION):
        overwrite_day(event_counts(frame(spark, events), kind), table, D30, (kind,))
    found = read_days(spark, table, COUNT_TABLE)
    assert rows(found, "EVENT_TYPE", "impressions") == [(PRODUCT_CLICK, 3), (WALL_IMPRESSION, 2)]
    # A type that got no rows is cleared, the other one is left alone.
    none = event_counts(frame(spark, events), WALL_IMPRESSION).where("impressions > 9")
    overwrite_day(none, table, D30, (WALL_IMPRESSION,))
    found = read_days(spark, table, COUNT_TABLE)
    assert rows(found, "EVENT_TYPE", "impressions") == [(PRODUCT_CLICK, 3)]


def _failing(rows):
    """Rows of which one cannot be computed."""
    return rows.withColumn(
        "impressions",
        F.when(F.col("BRAND") == "b", F.raise_error(F.lit("lost")).cast("long")).otherwise(
            F.col("impressions")
        ),
    )


METRIC = "BRAND string, EVENT_TYPE string, event_date date, impressions long"


def _metric(spark, n):
    rows = [(brand, "x", dt.date(2021, 6, 29), n) for brand in "ab"]
    return spark.createDataFrame(rows, METRIC)


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/table"
    replace_all(_metric(spark, 1), path)
    with pytest.raises(Exception, match="lost"):
        replace_all(_failing(_metric(spark, 2)), path)
    read = spark.read.parquet(path).select("BRAND", "impressions")
    assert rows(read) == [("a", 1), ("b", 1)]
    replace_all(_metric(spark, 3), path)
    assert rows(spark.read.parquet(path).select("BRAND", "impressions")) == [("a", 3), ("b", 3)]
    # Ended between its two renames.
    (tmp_path / "table").rename(tmp_path / "table.previous")
    replace_all(_metric(spark, 4), path)
    assert rows(spark.read.parquet(path).select("BRAND", "impressions")) == [("a", 4), ("b", 4)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table"]


def test_a_failed_replacement_leaves_the_named_table(spark, tmp_path):
    catalog.ensure_database(spark, "metrics_test", f"{tmp_path}/db")
    try:
        read = ["BRAND", "impressions"]
        catalog.replace_table(_metric(spark, 1), "metrics_test", "daily")
        with pytest.raises(Exception, match="lost"):
            catalog.replace_table(_failing(_metric(spark, 2)), "metrics_test", "daily")
        assert rows(catalog.read_table(spark, "metrics_test", "daily"), *read) == [("a", 1), ("b", 1)]
        catalog.replace_table(_metric(spark, 3), "metrics_test", "daily")
        catalog.append_table(_metric(spark, 4).where("BRAND = 'a'"), "metrics_test", "daily")
        found = [("a", 3), ("a", 4), ("b", 3)]
        assert rows(catalog.read_table(spark, "metrics_test", "daily"), *read) == found
        spark.sql("ALTER TABLE metrics_test.daily RENAME TO metrics_test.daily__previous")
        assert rows(catalog.read_table(spark, "metrics_test", "daily"), *read) == found
        catalog.recover(spark, "metrics_test", "daily")
        assert [t.name for t in spark.catalog.listTables("metrics_test")] == ["daily"]
        assert rows(catalog.read_table(spark, "metrics_test", "daily"), *read) == found
    finally:
        spark.sql("DROP DATABASE metrics_test CASCADE")
