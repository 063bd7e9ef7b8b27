"""The command line, from landed files to stored insights."""

import datetime as dt
import json

import pytest

from adpulse.jobs import run
from adpulse.model import (
    POST_CLICK,
    POST_IMPRESSION,
    PRODUCT,
    PRODUCT_CLICK,
    PRODUCT_IMPRESSION,
    WALL_IMPRESSION,
)
from adpulse.plans.streams import current_counts, current_rates, final_counts
from adpulse.plans.tables import COUNT_LOG, COUNT_TABLE, RATE_LOG, RATE_TABLE
from adpulse.sinks.daily import read_days
from adpulse.sources.landing import read_landing_table
from adpulse.sources.streams import stream_events
from adpulse.streaming.aggregates import daily_counts, daily_rate
from tests.events import many, rows, write_lines

A = ("a", "w", "g", "c")
D29, D30 = dt.date(2021, 6, 29), dt.date(2021, 6, 30)


@pytest.fixture
def landed(tmp_path):
    for day, n in (("28", 1), ("29", 2), ("30", 3)):
        for hour in ("00", "12", "23"):
            time = f"2021-06-{day}T{hour}:30:00Z"
            write_lines(
                tmp_path / f"in/2021/06/{day}/{hour}/f.json",
                many(n, A, WALL_IMPRESSION, time)
                + many(2 * n, A, PRODUCT_IMPRESSION, time)
                + many(1, A, PRODUCT_CLICK, time)
                + many(n, A, POST_IMPRESSION, time)
                + many(2, A, POST_CLICK, time),
            )
    late = many(1, A, WALL_IMPRESSION, "2021-06-30T23:59:00Z")
    write_lines(tmp_path / "in/2021/07/01/00/f.json", late)
    return tmp_path


def test_daily_jobs_and_insights(spark, landed):
    base = f"{landed}/in"
    for day in ("2021-06-29", "2021-06-30", "2021-06-30"):
        common = ["--source", base, "--day", day]
        run(spark, ["daily-count", *common, "--target", f"{landed}/wall"])
        run(spark, ["daily-rate", "--family", "product", *common, "--target", f"{landed}/ctr"])
        run(spark, ["daily-rate", "--family", "post", *common, "--target", f"{landed}/post"])
    wall = read_days(spark, f"{landed}/wall", COUNT_TABLE)
    assert rows(wall, "event_date", "impressions") == [(D29, 6), (D30, 10)]
    ctr = read_days(spark, f"{landed}/ctr", RATE_TABLE)
    assert rows(ctr, "event_date", "impressions_per_click") == [(D29, 4.0), (D30, 6.0)]
    post = read_days(spark, f"{landed}/post", RATE_TABLE)
    assert rows(post, "event_date", "impressions_per_click") == [(D29, 1.0), (D30, 1.5)]

    day = ["--day", "2021-06-30"]
    run(spark, ["count-change", "--source", f"{landed}/wall", *day, "--target", f"{landed}/i1"])
    run(spark, ["rate-change", "--source", f"{landed}/ctr", *day, "--target", f"{landed}/i2"])
    found = [
        spark.read.parquet(f"{landed}/{name}").first().pct_change for name in ("i1", "i2")
    ]
    assert found == [100 * 4 / 6, 50.0]


def test_one_pass_over_several_days_gives_the_same_tables(spark, landed):
    common = ["--source", f"{landed}/in"]
    span = ["--first", "2021-06-29", "--last", "2021-06-30"]
    run(spark, ["daily-all", *common, *span, "--target", f"{landed}/all"])
    for day in ("2021-06-29", "2021-06-30"):
        for family in ("product", "post"):
            target = ["--day", day, "--target", f"{landed}/{family}"]
            run(spark, ["daily-rate", "--family", family, *common, *target])
        run(spark, ["daily-count", *common, "--day", day, "--target", f"{landed}/wall"])
    for family in ("product", "post"):
        one_pass = read_days(spark, f"{landed}/all/daily/{family}_rate", RATE_TABLE)
        assert rows(one_pass) == rows(read_days(spark, f"{landed}/{family}", RATE_TABLE))
    counts = read_days(spark, f"{landed}/all/daily/counts", COUNT_TABLE)
    assert counts.count() == 10
    wall = counts.where("EVENT_TYPE = 'wall-impression'")
    assert rows(wall) == rows(read_days(spark, f"{landed}/wall", COUNT_TABLE))


def test_daily_count_options(spark, landed):
    target = f"{landed}/out"
    run(
        spark,
        ["daily-count", "--source", f"{landed}/in", "--day", "2021-07-01", "--target", target]
        + ["--type", WALL_IMPRESSION, "--type", PRODUCT_CLICK, "--allow-missing", "--by-label"],
    )
    assert read_days(spark, target, COUNT_TABLE).count() == 0


def test_store_landing(spark, landed):
    span = ["--first", "2021-06-29", "--last", "2021-07-01"]
    run(spark, ["store-landing", "--source", f"{landed}/in", *span, "--target", f"{landed}/t"])
    day = read_landing_table(spark, f"{landed}/t", "2021-06-30")
    assert day.where("EVENT_TYPE = 'wall-impression' AND event_date = '2021-06-30'").count() == 10


def test_streams(spark, landed):
    source = ["--source", f"{landed}/in/2021/06/30/*", "--every", "once", "--wait-seconds", "120"]
    run(spark, ["stream-count", *source, "--target", f"{landed}/c"])
    run(spark, ["stream-count", *source, "--lateness", "none", "--target", f"{landed}/n"])
    run(spark, ["stream-count", *source, "--final", "--target", f"{landed}/f"])
    run(spark, ["stream-rate", *source, "--family", "product", "--target", f"{landed}/r"])
    assert final_counts(spark, f"{landed}/f").count() == 0
    for _ in range(2):
        for name in ("c", "n"):
            newest = current_counts(spark, f"{landed}/{name}")
            assert rows(newest, "event_date", "impressions") == [(D30, 9)]
            run(spark, ["compact", "--of", "count", "--target", f"{landed}/{name}"])
        newest = current_rates(spark, f"{landed}/r")
        assert rows(newest, "event_date", "impressions_per_click") == [(D30, 6.0)]
        run(spark, ["compact", "--of", "rate", "--target", f"{landed}/r"])


def test_logged_columns_are_those_of_the_streams(spark, landed):
    events = stream_events(spark, f"{landed}/in/2021/06/30/*")
    for stream, log in (
        (daily_counts(events, WALL_IMPRESSION), COUNT_LOG),
        (daily_rate(events, PRODUCT), RATE_LOG),
    ):
        kinds = {field.name: field.dataType.simpleString() for field in log}
        assert dict(stream.dtypes) == kinds


def test_stream_of_one_day_label(spark, landed):
    common = ["--source", f"{landed}/in/2021/*/*/*", "--every", "once", "--wait-seconds", "120"]
    run(spark, ["stream-count", *common, "--day", "2021-06-29", "--target", f"{landed}/c"])
    newest = current_counts(spark, f"{landed}/c")
    assert rows(newest, "event_date", "impressions") == [(D29, 6)]


def test_bad_arguments(spark):
    for arguments in (["daily-rate"], ["nonsense"], ["daily-rate", "--family", "wall"]):
        with pytest.raises(SystemExit):
            run(spark, arguments)


def test_daily_jobs_from_the_landing_table(spark, landed):
    span = ["--first", "2021-06-28", "--last", "2021-07-01", "--allow-missing"]
    run(spark, ["store-landing", "--source", f"{landed}/in", "--target", f"{landed}/table", *span])
    for flag, source in (([], "in"), (["--from-table"], "table")):
        common = ["--source", f"{landed}/{source}", "--day", "2021-06-30", *flag]
        run(spark, ["daily-count", *common, "--target", f"{landed}/count-{source}"])
        run(spark, ["daily-rate", "--family", "post", *common, "--target", f"{landed}/rate-{source}"])
        days = ["--first", "2021-06-29", "--last", "2021-06-30", *flag]
        run(spark, ["daily-all", "--source", f"{landed}/{source}", *days,
                    "--target", f"{landed}/all-{source}"])
    for name, schema in (
        ("count", COUNT_TABLE), ("rate", RATE_TABLE), ("all", COUNT_TABLE)
    ):
        below = "/daily/counts" if name == "all" else ""
        one, other = (
            rows(read_days(spark, f"{landed}/{name}-{source}{below}", schema))
            for source in ("in", "table")
        )
        assert one == other and one


def test_daily_jobs_report_what_belongs_to_no_day(spark, tmp_path, capsys):
    write_lines(
        tmp_path / "in/2021/06/30/10/f.json",
        [
            *many(3, A, WALL_IMPRESSION, "2021-06-30T10:00:00Z"),
            *many(2, A, WALL_IMPRESSION, "bad", day="30"),
            '{"BRAND": "a',
        ],
    )
    run(
        spark,
        ["daily-count", "--source", f"{tmp_path}/in", "--target", f"{tmp_path}/out",
         "--day", "2021-06-30", "--allow-missing"],
    )
    said = capsys.readouterr().out.strip().splitlines()[-1]
    assert json.loads(said) == {"events": 6, "without_time": 3, "unparsable": 1}
    found = read_days(spark, f"{tmp_path}/out", COUNT_TABLE)
    assert rows(found, "event_date", "impressions") == [(D30, 3)]
