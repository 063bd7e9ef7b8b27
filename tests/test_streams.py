"""Streams over hand-made files, one file per micro-batch."""

import datetime as dt
import random
import re

import pytest

from adpulse.functions.event_time import with_event_time
from adpulse.model import (
    KEYS,
    PRODUCT,
    PRODUCT_CLICK,
    PRODUCT_IMPRESSION,
    WALL_IMPRESSION,
)
from adpulse.operators.counts import dropped_counts, event_counts
from adpulse.operators.rates import RATE, rate, regroup
from adpulse.plans.streams import (
    COUNT_KEY,
    current_counts,
    current_rates,
    final_rates,
    stream_daily_counts,
    stream_daily_rate,
)
from adpulse.sinks.files import numbered_dirs
from adpulse.sources.landing import read_json
from adpulse.sources.streams import count_arrivals, stream_events
from adpulse.streaming import changelog
from adpulse.streaming.aggregates import daily_counts, daily_rate, joined_daily_rate
from adpulse.streaming.runs import (
    STATE_STORE,
    start_finals,
    start_upserts,
    state_settings,
    wait,
)
from tests.events import event, frame, many, rows, write_lines

A, A_NULL, B = ("a", "w", "g", "c"), ("a", "w", "g", None), ("b", "w", "g", "c")
D29, D30, D02 = dt.date(2021, 6, 29), dt.date(2021, 6, 30), dt.date(2021, 7, 2)

# When the events of each file happened, and how many there are; the fourth is two days
# behind the watermark.
BATCHES = [
    ("2021-06-29T10:00:00Z", 2),
    ("2021-06-30T10:00:00Z", 3),
    ("2021-07-02T10:00:00Z", 1),
    ("2021-06-29T11:00:00Z", 5),
    ("2021-07-02T12:00:00Z", 1),
]


def drop(path, n, events):
    """A file that is newer than those before it."""
    write_lines(path / f"{n}.json", events, mtime=1_600_000_000 + 10 * n)


def source(spark, path):
    return stream_events(spark, str(path), max_files_per_trigger=1)


def finish(query):
    """Run to the end of what has arrived; the state rows after each micro-batch."""
    wait(query, 120)
    return [
        (p["stateOperators"][0]["numRowsTotal"] if p["stateOperators"] else None)
        for p in query.recentProgress
    ]


@pytest.fixture
def drops(tmp_path):
    for n, (time, count) in enumerate(BATCHES):
        drop(tmp_path / "in", n, many(count, A, WALL_IMPRESSION, time))
    return tmp_path / "in"


def updates(spark, out, stream):
    """The logged updates of every batch."""
    log = changelog.read_changes(spark, out, stream.schema)
    return [(b, d, n) for b, d, n in rows(log, "batch_id", "event_date", "impressions")]


def test_late_events_are_dropped_and_state_is_evicted(spark, drops, tmp_path):
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    out = f"{tmp_path}/out"
    state = finish(start_upserts(counts, out, None))
    assert updates(spark, out, counts) == [(0, D29, 2), (1, D30, 3), (2, D02, 1), (4, D02, 2)]
    assert state == [1, 2, 2, 1, 1, 1]
    assert rows(current_counts(spark, out), "event_date", "impressions") == [
        (D29, 2),
        (D30, 3),
        (D02, 2),
    ]


def test_without_a_limit_late_events_count_and_state_stays(spark, drops, tmp_path):
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION, lateness=None)
    out = f"{tmp_path}/out"
    state = finish(start_upserts(counts, out, None))
    assert updates(spark, out, counts) == [
        (0, D29, 2),
        (1, D30, 3),
        (2, D02, 1),
        (3, D29, 7),
        (4, D02, 2),
    ]
    assert state == [1, 2, 3, 3, 3]


def test_append_mode_emits_each_day_once_it_is_over(spark, drops, tmp_path):
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    out = f"{tmp_path}/out"
    query = start_finals(counts, out, None)
    finish(query)
    emitted = spark.read.schema(counts.schema).parquet(f"{out}/days")
    assert rows(emitted, "event_date", "impressions") == [(D29, 2), (D30, 3)]
    assert [p["sink"]["numOutputRows"] for p in query.recentProgress if "sink" in p]


def test_window_is_one_utc_day(spark, drops, tmp_path):
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    out = f"{tmp_path}/out"
    finish(start_upserts(counts, out, None))
    log = changelog.read_changes(spark, out, counts.schema).where("batch_id = 0")
    texts = log.selectExpr("string(window.start)", "string(window.end)", "string(event_date)")
    assert rows(texts) == [("2021-06-29 00:00:00", "2021-06-30 00:00:00", "2021-06-29")]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
def test_the_day_does_not_depend_on_the_session_zone(spark, tmp_path, zone):
    drop(tmp_path / "in", 0, many(2, A, WALL_IMPRESSION, "2021-06-29T23:30:00Z"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        counts = daily_counts(source(spark, tmp_path / "in"), WALL_IMPRESSION)
        out = f"{tmp_path}/out"
        finish(start_upserts(counts, out, None))
        assert updates(spark, out, counts) == [(0, D29, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_restart_continues_where_it_stopped(spark, drops, tmp_path):
    out = f"{tmp_path}/out"
    finish(start_upserts(daily_counts(source(spark, drops), WALL_IMPRESSION), out, None))
    drop(drops, 9, many(3, A, WALL_IMPRESSION, "2021-07-02T13:00:00Z"))
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    finish(start_upserts(counts, out, None))
    assert rows(current_counts(spark, out), "event_date", "impressions") == [
        (D29, 2),
        (D30, 3),
        (D02, 5),
    ]


def test_dropped_events_are_found_by_recounting(spark, drops, tmp_path):
    drop(drops, 9, many(4, A_NULL, WALL_IMPRESSION, "2021-06-30T11:00:00Z"))
    out = f"{tmp_path}/out"
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    query = start_upserts(counts, out, None)
    finish(query)
    recounted = event_counts(with_event_time(read_json(spark, str(drops))), WALL_IMPRESSION)
    dropped = dropped_counts(recounted, current_counts(spark, out))
    assert rows(dropped, *KEYS, "event_date", "dropped") == sorted(
        [(*A, D29, 5), (*A_NULL, D30, 4)], key=repr
    )
    # The operator's counter sees one row per group and batch instead.
    operators = [p["stateOperators"][0] for p in query.recentProgress]
    assert sum(operator["numRowsDroppedByWatermark"] for operator in operators) < 9


def test_a_batch_that_failed_after_writing_is_not_counted_twice(spark, drops, tmp_path):
    out = f"{tmp_path}/out"
    write = changelog.batch_writer(out)

    def start(writer):
        counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
        return (
            counts.writeStream.outputMode("update")
            .foreachBatch(writer)
            .option("checkpointLocation", f"{out}/_checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def fails_in_the_second_batch(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        wait(start(fails_in_the_second_batch), 120)
    finish(start(write))
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    assert updates(spark, out, counts) == [(0, D29, 2), (1, D30, 3), (2, D02, 1), (4, D02, 2)]


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    columns = "BRAND string, event_date date, impressions long"
    write = changelog.batch_writer(f"{tmp_path}/out")
    first = spark.createDataFrame([("a", D29, 1), ("b", D30, 2)], columns)
    second = spark.createDataFrame([("a", D29, 5)], columns)
    for batch_id, batch in [(0, first), (1, second), (1, second), (0, first)]:
        write(batch, batch_id)
    log = changelog.read_changes(spark, f"{tmp_path}/out", first.schema)
    assert log.count() == 3
    newest = changelog.latest(log, ("event_date", "BRAND"))
    assert rows(newest, "BRAND", "impressions") == [("a", 5), ("b", 2)]


def test_the_newest_value_wins_even_when_it_is_null(spark, tmp_path):
    columns = "BRAND string, CAMPAIGN_ID string, event_date date, clicks long"
    write = changelog.batch_writer(f"{tmp_path}/out")
    batches = [
        [("a", None, D29, 7), ("b", "c", D29, None)],
        [("a", None, D29, None), ("b", "c", D29, 9)],
    ]
    for batch_id, batch in enumerate(batches):
        write(spark.createDataFrame(batch, columns), batch_id)
    schema = spark.createDataFrame([], columns).schema
    log = changelog.read_changes(spark, f"{tmp_path}/out", schema)
    newest = changelog.latest(log, ("event_date", "BRAND", "CAMPAIGN_ID"))
    assert rows(newest, "BRAND", "clicks") == sorted([("a", None), ("b", 9)], key=repr)


def test_compaction_keeps_the_present_values(spark, drops, tmp_path):
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    out = f"{tmp_path}/out"
    finish(start_upserts(counts, out, None))
    before = rows(current_counts(spark, out))
    logged = changelog.logged_batches(spark, out)
    for through in (1, None, None):
        changelog.compact(spark, out, counts.schema, COUNT_KEY, through)
        assert rows(current_counts(spark, out)) == before
    # The newest batch may still be run again, so it stays out of the snapshots.
    assert changelog.versions(spark, out)[-1].through == logged[-2]
    # Days 29 and 30 were not touched again, so their snapshot is still the first one.
    assert numbered_dirs(spark, f"{out}/snapshots", "through") == [1, logged[-2]]
    # And the stream goes on after it.
    drop(drops, 9, many(3, A, WALL_IMPRESSION, "2021-07-02T13:00:00Z"))
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    finish(start_upserts(counts, out, None))
    changelog.compact(spark, out, counts.schema, COUNT_KEY)
    newest = rows(current_counts(spark, out), "event_date", "impressions")
    assert newest == [(D29, 2), (D30, 3), (D02, 5)]


def test_a_snapshot_beside_the_log_it_was_made_from(spark, tmp_path):
    """A failure between writing a snapshot and removing the log leaves both."""
    columns = "BRAND string, event_date date, impressions long"
    out = f"{tmp_path}/out"
    write = changelog.batch_writer(out)
    batch = spark.createDataFrame([("a", D29, 1)], columns)
    for batch_id in (0, 1):
        grown = batch.selectExpr("BRAND", "event_date", f"impressions + {batch_id} AS impressions")
        write(grown, batch_id)
    key = ("event_date", "BRAND")
    changelog.compact(spark, out, batch.schema, key, through=1)
    write(batch, 0)
    log = changelog.read_changes(spark, out, batch.schema)
    assert rows(changelog.latest(log, key), "BRAND", "impressions") == [("a", 2)]
    changelog.compact(spark, out, batch.schema, key, through=1)
    log = changelog.read_changes(spark, out, batch.schema)
    assert rows(changelog.latest(log, key), "BRAND", "impressions") == [("a", 2)]


def test_nothing_logged_yet(spark, tmp_path):
    schema = spark.createDataFrame([], "BRAND string, event_date date, impressions long").schema
    changelog.compact(spark, f"{tmp_path}/out", schema, ("event_date", "BRAND"))
    assert changelog.read_changes(spark, f"{tmp_path}/out", schema).count() == 0


PRODUCT_EVENTS = [
    many(6, A, PRODUCT_IMPRESSION, "2021-06-29T10:00:00Z")
    + many(5, A_NULL, PRODUCT_IMPRESSION, "2021-06-29T10:00:00Z"),
    many(2, A, PRODUCT_CLICK, "2021-06-29T11:00:00Z")
    + many(1, A_NULL, PRODUCT_CLICK, "2021-06-29T11:00:00Z")
    + many(3, B, PRODUCT_IMPRESSION, "2021-06-29T11:00:00Z"),
    many(4, B, PRODUCT_CLICK, "2021-06-30T10:00:00Z")
    + many(9, A, WALL_IMPRESSION, "2021-06-30T10:00:00Z"),
    many(1, A, PRODUCT_CLICK, "2021-07-03T10:00:00Z"),
    many(1, A, PRODUCT_CLICK, "2021-07-03T11:00:00Z"),
]


@pytest.fixture
def product_drops(tmp_path):
    for n, events in enumerate(PRODUCT_EVENTS):
        drop(tmp_path / "in", n, events)
    return tmp_path / "in"


def test_streamed_rate_equals_the_batch(spark, product_drops, tmp_path):
    stream = daily_rate(source(spark, product_drops), PRODUCT)
    out = f"{tmp_path}/out"
    finish(start_upserts(stream, out, None))
    columns = (*KEYS, "event_date", "impressions", "clicks", RATE)
    batch = rate(frame(spark, sum(PRODUCT_EVENTS, [])), PRODUCT)
    assert rows(current_rates(spark, out), *columns) == rows(batch, *columns)


def test_joined_rate_of_finished_days_equals_the_batch(spark, product_drops, tmp_path):
    stream = joined_daily_rate(source(spark, product_drops), PRODUCT)
    out = f"{tmp_path}/out"
    finish(start_finals(stream, out, None))
    halves = spark.read.schema(stream.schema).parquet(f"{out}/days")
    columns = (*KEYS, "event_date", "impressions", "clicks", RATE)
    batch = rate(frame(spark, sum(PRODUCT_EVENTS, [])), PRODUCT).where("event_date < '2021-07-03'")
    assert rows(regroup(halves), *columns) == rows(batch, *columns)


def test_counts_of_several_types_equal_the_batch(spark, product_drops, tmp_path):
    stream = daily_counts(source(spark, product_drops), *PRODUCT.types)
    out = f"{tmp_path}/out"
    finish(start_upserts(stream, out, None))
    batch = event_counts(frame(spark, sum(PRODUCT_EVENTS, [])), *PRODUCT.types)
    columns = (*KEYS, "EVENT_TYPE", "event_date", "impressions")
    assert rows(current_counts(spark, out), *columns) == rows(batch, *columns)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_into_files_gives_the_batch_result(spark, tmp_path, seed):
    """Events of several days and keys in random order, spread over random files."""
    chance = random.Random(seed)
    events = [
        event(
            chance.choice([A, A_NULL, B]),
            chance.choice([*PRODUCT.types, WALL_IMPRESSION]),
            f"2021-06-{chance.randint(27, 30)}T{chance.randint(0, 23):02d}:00:00Z",
        )
        for _ in range(60)
    ]
    cuts = [0, *sorted(chance.sample(range(1, 60), 3)), 60]
    for n, (start, end) in enumerate(zip(cuts, cuts[1:])):
        drop(tmp_path / "in", n, events[start:end])
    stream = daily_rate(source(spark, tmp_path / "in"), PRODUCT, lateness=None)
    out = f"{tmp_path}/out"
    finish(start_upserts(stream, out, None))
    columns = (*KEYS, "event_date", "impressions", "clicks", RATE)
    batch = rate(frame(spark, events), PRODUCT)
    assert rows(current_rates(spark, out), *columns) == rows(batch, *columns)


def test_malformed_lines_and_times_do_not_stop_the_stream(spark, tmp_path):
    drop(
        tmp_path / "in",
        0,
        [event(A, WALL_IMPRESSION, "2021-06-29T10:00:00Z"), event(A, WALL_IMPRESSION, "bad"), "{x"],
    )
    counts = daily_counts(source(spark, tmp_path / "in"), WALL_IMPRESSION)
    out = f"{tmp_path}/out"
    finish(start_upserts(counts, out, None))
    assert updates(spark, out, counts) == [(0, D29, 1)]


def test_arrivals_are_counted_before_late_ones_are_dropped(spark, drops, tmp_path):
    drop(drops, 9, [event(A, WALL_IMPRESSION, "bad"), event(B, WALL_IMPRESSION, BATCHES[4][0])])
    arrivals = count_arrivals(source(spark, drops))
    query = start_upserts(daily_counts(arrivals, WALL_IMPRESSION), f"{tmp_path}/out", None)
    finish(query)
    seen = [p["observedMetrics"]["arrivals"] for p in query.recentProgress if p["numInputRows"]]
    assert [row.events for row in seen] == [2, 3, 1, 5, 1, 2]
    assert [row.without_time for row in seen] == [0, 0, 0, 0, 0, 1]


def test_rocksdb_state(spark, drops, tmp_path):
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    out = f"{tmp_path}/out"
    with state_settings(spark):
        query = start_upserts(counts, out, None)
    state = finish(query)
    assert {name: spark.conf.get(name, None) for name in STATE_STORE} == before
    assert state == [1, 2, 2, 1, 1, 1]
    custom = query.recentProgress[0]["stateOperators"][0]["customMetrics"]
    assert any(name.startswith("rocksdb") for name in custom)
    assert updates(spark, out, counts) == [(0, D29, 2), (1, D30, 3), (2, D02, 1), (4, D02, 2)]


def test_state_keeps_the_partitions_of_the_first_start(spark, drops, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = f"{tmp_path}/out"
    counts = daily_counts(source(spark, drops), WALL_IMPRESSION)
    with state_settings(spark, 3):
        query = start_upserts(counts, out, None)
    wait(query, 120)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"
    drop(drops, 9, many(3, A, WALL_IMPRESSION, "2021-07-02T13:00:00Z"))
    again = start_upserts(daily_counts(source(spark, drops), WALL_IMPRESSION), out, None)
    wait(again, 120)
    for ran in (query, again):
        assert ran.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3


def test_timed_trigger_runs_until_stopped(spark, drops, tmp_path):
    query = stream_daily_counts(
        spark, str(drops), f"{tmp_path}/out", WALL_IMPRESSION, every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        with pytest.raises(TimeoutError):
            wait(query, 1)
        assert not query.isActive
    finally:
        query.stop()
    newest = rows(current_counts(spark, f"{tmp_path}/out"), "event_date", "impressions")
    # All five files fit one micro-batch, and nothing is late within the first one.
    assert newest == [(D29, 7), (D30, 3), (D02, 2)]


def test_old_files_are_read(spark, tmp_path):
    """The second file is nine days older than the first, by its modification time."""
    newer, older = 1_600_000_000, 1_600_000_000 - 9 * 86_400
    first = many(2, A, WALL_IMPRESSION, "2021-06-30T10:00:00Z")
    write_lines(tmp_path / "in/1.json", first, mtime=newer)
    out = f"{tmp_path}/out"

    def run():
        wait(
            stream_daily_counts(
                spark, f"{tmp_path}/in", out, WALL_IMPRESSION, lateness=None, every=None
            ),
            120,
        )

    run()
    second = many(5, A, WALL_IMPRESSION, "2021-06-21T10:00:00Z")
    write_lines(tmp_path / "in/2.json", second, mtime=older)
    run()
    found = rows(current_counts(spark, out), "event_date", "impressions")
    assert found == [(dt.date(2021, 6, 21), 5), (D30, 2)]


def test_a_cap_changes_nothing_when_files_come_in_event_order(spark, tmp_path):
    for n, (time, count) in enumerate(sorted(BATCHES)):
        drop(tmp_path / "in", n, many(count, A, WALL_IMPRESSION, time))
    found = []
    for cap in (None, 1):
        out = f"{tmp_path}/out{cap}"
        job = stream_daily_counts(
            spark, f"{tmp_path}/in", out, WALL_IMPRESSION, every=None, max_files=cap
        )
        wait(job, 120)
        found.append(rows(current_counts(spark, out), "event_date", "impressions"))
    assert found[0] == found[1] == [(D29, 7), (D30, 3), (D02, 2)]


def test_offsets_and_bad_times_are_not_dropped_as_late(spark, tmp_path):
    events = many(3, A, WALL_IMPRESSION, "2021-06-30T23:30:00-05:00")
    events += many(2, A, WALL_IMPRESSION, "bad")
    drop(tmp_path / "in", 0, events)
    out = f"{tmp_path}/out"
    finish(start_upserts(daily_counts(source(spark, tmp_path / "in"), WALL_IMPRESSION), out, None))
    landed = with_event_time(read_json(spark, f"{tmp_path}/in"))
    recounted = event_counts(landed, WALL_IMPRESSION)
    streamed = current_counts(spark, out)
    assert rows(streamed, "event_date", "impressions") == [(dt.date(2021, 7, 1), 3)]
    assert dropped_counts(recounted, streamed).count() == 0


def _wide_batch(spark, shift=0):
    """Many groups on three days, spread over many partitions."""
    days = "array(date'2021-06-28', date'2021-06-29', date'2021-06-30')"
    return spark.range(3000).repartition(20).selectExpr(
        "cast(id as string) as BRAND",
        f"{days}[cast(id % 3 as int)] as event_date",
        f"id + {shift} as impressions",
    )


def test_a_batch_leaves_a_file_per_day(spark, tmp_path):
    changelog.batch_writer(f"{tmp_path}/out")(_wide_batch(spark), 0)
    files = list((tmp_path / "out/log/part=0/batch_id=0").rglob("*.parquet"))
    assert len(files) <= 2 * 3


def test_compaction_leaves_untouched_days_as_they_are(spark, tmp_path):
    out, key = f"{tmp_path}/out", ("event_date", "BRAND")
    write = changelog.batch_writer(out, compact_every=2, key=key)
    for batch_id in (0, 1):
        write(_wide_batch(spark, batch_id), batch_id)
    changelog.compact(spark, out, _wide_batch(spark).schema, key, through=1)
    day = "event_date=2021-06-28"
    kept = sorted((tmp_path / "out/snapshots").glob(f"through=1/{day}/*.parquet"))
    for batch_id in (2, 3, 4, 5):
        write(_wide_batch(spark, batch_id).where("event_date > '2021-06-28'"), batch_id)
    # The stream has folded its log by itself; its newest batch is still there.
    assert changelog.versions(spark, out)[-1].through == 4
    assert sorted((tmp_path / "out/snapshots").glob(f"*/{day}/*.parquet")) == kept
    newest = changelog.latest(changelog.read_changes(spark, out, _wide_batch(spark).schema), key)
    expected = _wide_batch(spark, 5).where("event_date > '2021-06-28'").union(
        _wide_batch(spark, 1).where("event_date = '2021-06-28'")
    )
    columns = ("BRAND", "event_date", "impressions")
    assert rows(newest, *columns) == rows(expected, *columns)


def test_present_values_of_one_day_read_one_day(spark, drops, tmp_path):
    out = f"{tmp_path}/out"
    finish(start_upserts(daily_counts(source(spark, drops), WALL_IMPRESSION), out, None))
    one = current_counts(spark, out, D30)
    assert rows(one, "event_date", "impressions") == [(D30, 3)]
    plan = one._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*isnotnull\(event_date", plan), plan


def test_final_rate_job_equals_the_batch(spark, product_drops, tmp_path):
    out = f"{tmp_path}/out"
    source_dir = str(product_drops)
    job = stream_daily_rate(
        spark, source_dir, out, PRODUCT, every=None, final=True, max_files=1
    )
    wait(job, 120)
    columns = (*KEYS, "event_date", "impressions", "clicks", RATE)
    batch = rate(frame(spark, sum(PRODUCT_EVENTS, [])), PRODUCT).where("event_date < '2021-07-03'")
    assert rows(final_rates(spark, out), *columns) == rows(batch, *columns)
    with pytest.raises(ValueError, match="lateness"):
        stream_daily_rate(spark, source_dir, out, PRODUCT, lateness=None, final=True)


def _grown(spark, n):
    columns = "BRAND string, event_date date, impressions long"
    return spark.createDataFrame([("a", D29, n), ("b", D30 if n < 3 else D02, n)], columns)


GROWN_KEY = ("event_date", "BRAND")


def test_a_reader_finishes_with_the_version_it_began_with(spark, tmp_path):
    out, schema = f"{tmp_path}/out", _grown(spark, 0).schema
    write = changelog.batch_writer(out)
    for batch_id in (0, 1, 2):
        write(_grown(spark, batch_id), batch_id)
    changelog.compact(spark, out, schema, GROWN_KEY)
    reader = changelog.latest(changelog.read_changes(spark, out, schema), GROWN_KEY)
    expected = [("a", D29, 2), ("b", D30, 2)]
    write(_grown(spark, 3), 3)
    write(_grown(spark, 4), 4)
    changelog.compact(spark, out, schema, GROWN_KEY)
    assert rows(reader, "BRAND", "event_date", "impressions") == expected
    newest = changelog.latest(changelog.read_changes(spark, out, schema), GROWN_KEY)
    assert rows(newest, "BRAND", "event_date", "impressions") == [
        ("a", D29, 4), ("b", D30, 2), ("b", D02, 4)
    ]


def test_what_no_kept_version_names_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changelog, "PART_BATCHES", 2)
    out, schema = f"{tmp_path}/out", _grown(spark, 0).schema
    write = changelog.batch_writer(out, compact_every=2, key=GROWN_KEY)
    for batch_id in range(12):
        write(_grown(spark, batch_id), batch_id)
        newest = changelog.latest(changelog.read_changes(spark, out, schema), GROWN_KEY)
        assert ("a", D29, batch_id) in rows(newest, "BRAND", "event_date", "impressions")
    known = changelog.versions(spark, out)
    assert [version.through for version in known] == [8, 10]
    # Parts of the log that both versions have folded are gone.
    assert changelog.logged_batches(spark, out) == [8, 9, 10, 11]
    # The 30th was last touched by batch 2, its snapshot still stands.
    assert numbered_dirs(spark, f"{out}/snapshots", "through") == [2, 8, 10]
    assert numbered_dirs(spark, f"{out}/versions", "version") == [v.number for v in known]


def test_a_compaction_that_failed_before_naming_its_version(spark, tmp_path, monkeypatch):
    out, schema = f"{tmp_path}/out", _grown(spark, 0).schema
    write = changelog.batch_writer(out)
    for batch_id in (0, 1):
        write(_grown(spark, batch_id), batch_id)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(changelog, "make_dir", fails)
        with pytest.raises(RuntimeError, match="lost"):
            changelog.compact(spark, out, schema, GROWN_KEY)
    for _ in range(2):
        newest = changelog.latest(changelog.read_changes(spark, out, schema), GROWN_KEY)
        assert rows(newest, "BRAND", "impressions") == [("a", 1), ("b", 1)]
        changelog.compact(spark, out, schema, GROWN_KEY)


def test_streams_fold_their_log_unless_told_otherwise(spark):
    import inspect

    for job in (stream_daily_counts, stream_daily_rate):
        assert inspect.signature(job).parameters["compact_every"].default == changelog.COMPACT_EVERY
