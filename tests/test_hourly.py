"""Landing hours counted one by one: offsets, changed hours, late files, repeated steps."""

import datetime as dt
import time

import pytest

from adpulse.functions.hours import HOUR, as_hour, hour_number, hours_between, numbered_hour
from adpulse.model import ALL_TYPES, KEYS, PRODUCT_CLICK, WALL_IMPRESSION
from adpulse.operators.counts import event_counts
from adpulse.plans import hourly
from adpulse.plans.daily import day_events
from adpulse.sources import ledger
from adpulse.sources.landing import PARTITIONED, PLAIN
from tests.events import many, rows, write_lines

A, B = ("a", "w", "g", "c"), ("b", "w", "g", None)
START = dt.datetime(2021, 6, 29, 22)
COLUMNS = (*KEYS, "EVENT_TYPE", "event_date", "impressions")


def land(base, hour, events, name="0", layout=PLAIN):
    hour = as_hour(hour)
    path = base / layout.hour_dir(hour.date(), hour.hour) / f"{name}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    write_lines(path, events, mtime=1_600_000_000)


@pytest.fixture
def base(tmp_path):
    """Twelve hours around midnight; two of them have no directory."""
    for n in (0, 1, 2, 3, 5, 6, 7, 9, 10, 11):
        at = START + n * HOUR
        land(tmp_path / "in", at, many(n + 1, A, WALL_IMPRESSION, f"{at.isoformat()}Z") + many(1, B, PRODUCT_CLICK, "2021-06-29T23:30:00Z"))
    return tmp_path / "in"


@pytest.fixture
def seen(monkeypatch):
    """The hours listed by each call."""
    found = []
    listed = ledger.listed

    def spy(spark, base, hours, layout=PLAIN):
        hours = list(hours)
        found.append(hours)
        return listed(spark, base, hours, layout)

    monkeypatch.setattr(ledger, "listed", spy)
    return found


def recounted(spark, base, day):
    return rows(event_counts(day_events(spark, str(base), day, allow_missing=True), *ALL_TYPES), *COLUMNS)


def test_hours():
    assert as_hour("2021-06-30T05:59:59") == dt.datetime(2021, 6, 30, 5)
    assert as_hour("2021-06-30") == as_hour(dt.date(2021, 6, 30)) == dt.datetime(2021, 6, 30)
    assert as_hour("2021-06-30T01:10:00+02:00") == dt.datetime(2021, 6, 29, 23)
    assert hours_between("2021-06-30T22", "2021-07-01T01") == [
        dt.datetime(2021, 6, 30, 22), dt.datetime(2021, 6, 30, 23), dt.datetime(2021, 7, 1)
    ]
    assert hours_between("2021-06-30", "2021-06-29") == []
    assert numbered_hour(hour_number(START)) == START


def test_merged_hours_equal_a_recount_of_the_day(spark, base, tmp_path):
    out = f"{tmp_path}/out"
    assert hourly.catch_up(spark, str(base), out, START + 11 * HOUR, first=START) == 10
    for day in ("2021-06-29", "2021-06-30"):
        merged = hourly.merged_counts(spark, out, first=day)
        assert rows(merged, *COLUMNS) == recounted(spark, base, day)
    # Without a limit, clicks of the 29th that landed on the 30th count too.
    every = hourly.merged_counts(spark, out, PRODUCT_CLICK, grace_hours=None)
    assert rows(every, "event_date", "impressions") == [(dt.date(2021, 6, 29), 10)]


def test_closed_hours_are_not_listed_again(spark, base, tmp_path, seen):
    out = f"{tmp_path}/out"
    hourly.step(spark, str(base), out, first=START, now=START + 11 * HOUR)
    assert seen[-1] == [START + n * HOUR for n in range(12)]
    assert ledger.first_open(spark, f"{out}/ledger") == START + 9 * HOUR
    assert hourly.step(spark, str(base), out, now=START + 11 * HOUR) == []
    assert seen[-1] == [START + n * HOUR for n in (9, 10, 11)]


def test_ten_thousand_hours_list_only_the_open_ones(spark, base, tmp_path, seen):
    out = f"{tmp_path}/out"
    now = START + 10_000 * HOUR
    ledger.close_before(spark, f"{out}/ledger", now - 2 * HOUR)
    land(base, now, many(3, A, WALL_IMPRESSION, f"{now.isoformat()}Z"))
    land(base, START, many(9, A, WALL_IMPRESSION, f"{START.isoformat()}Z"), "late")
    assert hourly.step(spark, str(base), out, now=now) == [now]
    assert seen == [[now - 2 * HOUR, now - HOUR, now]]
    # The late file, and the files from before the ledger, are reported by the audit.
    late = hourly.late_events(spark, str(base), out, [START, START + HOUR])
    assert rows(late, "landing_hour", "files", "events") == [(22, 2, 11), (23, 1, 3)]


def test_an_open_hour_is_counted_again_when_its_files_change(spark, base, tmp_path):
    out, now = f"{tmp_path}/out", START + 11 * HOUR
    hourly.step(spark, str(base), out, first=START, now=now)
    land(base, now, many(4, B, WALL_IMPRESSION, f"{now.isoformat()}Z"), "more")
    land(base, now - HOUR, many(2, A, WALL_IMPRESSION, f"{now.isoformat()}Z"))  # in place of 11
    (base / PLAIN.hour_dir((now - 2 * HOUR).date(), (now - 2 * HOUR).hour) / "0.json").unlink()
    assert hourly.step(spark, str(base), out, now=now) == [now - 2 * HOUR, now - HOUR, now]
    merged = hourly.merged_counts(spark, out, first="2021-06-30")
    assert rows(merged, *COLUMNS) == recounted(spark, base, "2021-06-30")


def test_a_late_file_costs_its_hour(spark, base, tmp_path, seen):
    out, now = f"{tmp_path}/out", START + 11 * HOUR
    hourly.catch_up(spark, str(base), out, now, first=START)
    hour = START + 3 * HOUR
    land(base, hour, many(5, B, WALL_IMPRESSION, f"{hour.isoformat()}Z"), "late")
    hours = hours_between(START, now)
    late = ledger.late_files(spark, str(base), f"{out}/ledger", hours)
    assert [(row["landing_hour"], row["path"].split("/")[-1]) for row in late.collect()] == [(1, "late.json")]
    assert hourly.recount_late(spark, str(base), out, hours) == [hour]
    merged = hourly.merged_counts(spark, out, first="2021-06-30")
    assert rows(merged, *COLUMNS) == recounted(spark, base, "2021-06-30")
    assert ledger.late_files(spark, str(base), f"{out}/ledger", hours).count() == 0
    assert hourly.recount_late(spark, str(base), out, hours) == []
    files = sorted((tmp_path / "out/counts").rglob("*.parquet"))
    assert {f.parent.name for f in files if "2021-06-30" in str(f)} == {f"landing_hour={n}" for n in (0, 1, 3, 4, 5, 7, 8, 9)}


def test_a_step_that_failed_before_recording_is_repeated(spark, base, tmp_path, monkeypatch):
    out, now = f"{tmp_path}/out", START + 11 * HOUR

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(hourly, "record", fails)
        with pytest.raises(RuntimeError, match="lost"):
            hourly.step(spark, str(base), out, first=START, now=now)
    assert len(hourly.step(spark, str(base), out, first=START, now=now)) == 10
    merged = hourly.merged_counts(spark, out, first="2021-06-30")
    assert rows(merged, *COLUMNS) == recounted(spark, base, "2021-06-30")


def test_a_backlog_is_taken_in_steps(spark, base, tmp_path, seen):
    out, now = f"{tmp_path}/out", START + 11 * HOUR
    assert hourly.catch_up(spark, str(base), out, now, first=START, max_hours=4) == 10
    assert max(map(len, seen)) <= 4
    assert ledger.first_open(spark, f"{out}/ledger") == now - 2 * HOUR
    merged = hourly.merged_counts(spark, out, first="2021-06-30")
    assert rows(merged, *COLUMNS) == recounted(spark, base, "2021-06-30")


def test_partitioned_layout_and_nothing_landed(spark, tmp_path):
    out, base = f"{tmp_path}/out", tmp_path / "in"
    assert hourly.step(spark, str(base), out, first=START, now=START, layout=PARTITIONED) == []
    land(base, START, many(3, A, WALL_IMPRESSION, "2021-06-29T22:00:00Z"), layout=PARTITIONED)
    assert hourly.step(spark, str(base), out, first=START, now=START, layout=PARTITIONED) == [START]
    merged = hourly.merged_counts(spark, out, WALL_IMPRESSION, first="2021-06-29")
    assert rows(merged, "event_date", "impressions") == [(dt.date(2021, 6, 29), 3)]
    with pytest.raises(ValueError, match="start with"):
        hourly.step(spark, str(base), f"{tmp_path}/other", now=START)


def test_the_offset_never_goes_back(spark, tmp_path):
    place = f"{tmp_path}/ledger"
    assert ledger.first_open(spark, place) is None
    ledger.close_before(spark, place, START)
    ledger.close_before(spark, place, START - HOUR)
    assert ledger.first_open(spark, place) == START
    ledger.close_before(spark, place, START + HOUR)
    assert [p.name for p in (tmp_path / "ledger/offset").iterdir() if p.name[0] != "."] == [
        f"hour={hour_number(START + HOUR)}"
    ]


def test_a_stream_of_steps(spark, base, tmp_path):
    """Under a real trigger, until it is stopped."""
    out, now = f"{tmp_path}/out", START + 11 * HOUR
    query = hourly.start_hours(spark, str(base), out, "1 second", first=START, now=now)
    try:
        deadline = time.time() + 60
        while time.time() < deadline and ledger.first_open(spark, f"{out}/ledger") is None:
            time.sleep(0.5)
        land(base, now, many(2, B, WALL_IMPRESSION, f"{now.isoformat()}Z"), "more")
        while time.time() < deadline:
            merged = hourly.merged_counts(spark, out, first="2021-06-30")
            if rows(merged, *COLUMNS) == recounted(spark, base, "2021-06-30"):
                break
            time.sleep(1)
        assert query.isActive
    finally:
        query.stop()
    merged = hourly.merged_counts(spark, out, first="2021-06-30")
    assert rows(merged, *COLUMNS) == recounted(spark, base, "2021-06-30")


def test_only_the_hours_needed_are_read(spark, base, tmp_path):
    out, now = f"{tmp_path}/out", START + 11 * HOUR
    hourly.catch_up(spark, str(base), out, now, first=START)
    plan = hourly.merged_counts(spark, out, first="2021-06-30")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(landing_date" in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


def test_jobs(spark, base, tmp_path, capsys):
    from adpulse.jobs import run

    where = ["--source", str(base), "--target", f"{tmp_path}/out"]
    first = hourly.this_hour() - 3 * HOUR
    land(base, first, many(4, A, WALL_IMPRESSION, f"{first.isoformat()}Z"))
    run(spark, ["hour-count", *where, "--first", first.isoformat(), "--every", "once"])
    assert '{"hours": 1}' in capsys.readouterr().out
    land(base, first, many(2, A, WALL_IMPRESSION, f"{first.isoformat()}Z"), "late")
    run(spark, ["recount-late", *where, "--first", first.isoformat(), "--before", hourly.this_hour().isoformat()])
    assert first.isoformat() in capsys.readouterr().out
    merged = hourly.merged_counts(spark, f"{tmp_path}/out", grace_hours=None)
    assert rows(merged, "event_date", "impressions") == [(first.date(), 6)]
