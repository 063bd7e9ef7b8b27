"""Counts, rates and changes on hand-made events."""

import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adpulse.model import (
    KEYS,
    POST,
    PRODUCT,
    PRODUCT_CLICK,
    PRODUCT_IMPRESSION,
    WALL_IMPRESSION,
)
from adpulse.operators.changes import (
    compare_rates,
    count_change,
    count_changes,
    join_days,
    rate_change,
    rate_changes,
)
from adpulse.operators.counts import event_counts, event_time_quality
from adpulse.operators.rates import RATE, join_counts, rate, rate_by_join, rate_by_sql
from adpulse.operators.selection import of_type, on_day_label, on_days
from adpulse.operators.unions import union_reads
from tests.events import event, frame, many, rows

NOON_29, NOON_30 = "2021-06-29T12:00:00Z", "2021-06-30T12:00:00Z"
A, A_NULL = ("a", "w", "g", "c"), ("a", "w", "g", None)
B, C = ("b", "w", "g", "c"), ("c", "w", "g", "c")


def product(keys, impressions, clicks, time=NOON_30):
    return many(impressions, keys, PRODUCT_IMPRESSION, time) + many(
        clicks, keys, PRODUCT_CLICK, time
    )


@pytest.fixture(scope="module")
def mixed(spark):
    return frame(
        spark,
        product(A, 6, 2)
        + product(A_NULL, 5, 1)
        + product(B, 3, 0)
        + product(C, 0, 4)
        + product(A, 9, 0, NOON_29),
    )


EXPECTED = sorted(
    [(*A, 6, 2, 3.0), (*A_NULL, 5, 1, 5.0), (*B, 3, None, None), (*C, None, 4, None)], key=repr
)


def test_rate_merges_null_keys_and_keeps_missing_sides_null(mixed):
    assert rows(rate(on_days(mixed, "2021-06-30"), PRODUCT).drop("event_date")) == EXPECTED


def test_join_form_splits_null_keys_and_regrouping_merges_them(spark, mixed):
    day = on_days(mixed, "2021-06-30")
    sides = (
        event_counts(day, PRODUCT_IMPRESSION),
        event_counts(day, PRODUCT_CLICK, name="clicks"),
    )
    assert join_counts(*sides).count() == 5
    assert rows(rate_by_join(*sides).drop("event_date")) == EXPECTED
    by_sql = rate_by_sql(spark, join_counts(*sides)).drop("event_date")
    assert rows(by_sql) == sorted([(*e[:4], e[6]) for e in EXPECTED], key=repr)


def test_sql_form_leaves_no_view_behind(spark, mixed):
    before = len(spark.catalog.listTables())
    sides = (
        event_counts(mixed, PRODUCT_IMPRESSION),
        event_counts(mixed, PRODUCT_CLICK, name="clicks"),
    )
    rate_by_sql(spark, join_counts(*sides)).collect()
    assert len(spark.catalog.listTables()) == before


def test_other_types_do_not_count(mixed):
    assert rate(mixed, POST).count() == 0
    assert event_counts(mixed, WALL_IMPRESSION).count() == 0


def test_rate_change(spark):
    events = frame(
        spark,
        product(A, 4, 2, NOON_29)  # 2.0 -> 3.0
        + product(A, 6, 2)
        + product(A_NULL, 8, 1, NOON_29)  # 8.0 -> 4.0, one group in spite of the NULL
        + product(A_NULL, 4, 1)
        + product(B, 1, 1)  # only on the day
        + product(C, 2, 1, NOON_29),  # only on the day before
    )
    expected = sorted(
        [
            (*A, 2.0, 3.0, 50.0),
            (*A_NULL, 8.0, 4.0, -50.0),
            (*B, None, 1.0, None),
            (*C, 2.0, None, None),
        ],
        key=repr,
    )
    columns = (*KEYS, "previous", "current", "pct_change")
    assert rows(rate_change(events, PRODUCT, "2021-06-30"), *columns) == expected
    assert rows(compare_rates(rate(events, PRODUCT), "2021-06-30"), *columns) == expected
    by_range = rate_changes(events, PRODUCT, "2021-06-30", "2021-06-30")
    assert rows(by_range, *columns) == expected


def test_changes_over_a_range_equal_the_single_days(spark):
    days = ["2021-06-28", "2021-06-29", "2021-06-30", "2021-07-01"]
    events = []
    for n, day in enumerate(days):
        events += product(A, 2 + n, 1, f"{day}T05:00:00Z")
        events += many(n + 1, A, WALL_IMPRESSION, f"{day}T06:00:00Z")
        if n % 2:
            events += product(B, 3, 2, f"{day}T05:00:00Z")
            events += many(2, A_NULL, WALL_IMPRESSION, f"{day}T06:00:00Z")
    df = frame(spark, events)
    columns = (*KEYS, "event_date", "previous", "current", "pct_change")
    single = [rows(rate_change(df, PRODUCT, day), *columns) for day in days[1:3]]
    ranged = rows(rate_changes(df, PRODUCT, days[1], days[2]), *columns)
    assert ranged == sorted(sum(single, []), key=repr)
    single = [rows(count_change(df, day, WALL_IMPRESSION), *columns) for day in days[1:3]]
    ranged = rows(count_changes(df, days[1], days[2], WALL_IMPRESSION), *columns)
    assert ranged == sorted(sum(single, []), key=repr) and len(ranged) == 2


def test_count_change_needs_both_days_and_every_key(spark):
    events = frame(
        spark,
        many(10, A, WALL_IMPRESSION, NOON_29)
        + many(15, A, WALL_IMPRESSION, NOON_30)
        + many(4, A_NULL, WALL_IMPRESSION, NOON_29)
        + many(4, A_NULL, WALL_IMPRESSION, NOON_30)
        + many(1, B, WALL_IMPRESSION, NOON_30)
        + many(1, C, WALL_IMPRESSION, NOON_29),
    )
    expected = [(*A, WALL_IMPRESSION, 10, 15, 50.0, dt.date(2021, 6, 30))]
    columns = (*KEYS, "EVENT_TYPE", "previous", "current", "pct_change", "event_date")
    assert rows(count_change(events, "2021-06-30", WALL_IMPRESSION), *columns) == expected
    stored = event_counts(events, WALL_IMPRESSION)
    assert rows(count_change(stored, "2021-06-30", count="impressions"), *columns) == expected


def test_joining_unreduced_days_would_multiply(spark):
    """Two rows per key on both sides: 30 would become 60 and 12 would become 24."""
    schema = "BRAND string, WALL_ID string, WALLGROUP_ID string, CAMPAIGN_ID string"
    previous = spark.createDataFrame([(*A, 10), (*A, 20)], f"{schema}, previous long")
    current = spark.createDataFrame([(*A, 5), (*A, 7)], f"{schema}, current long")
    fanned = join_days(previous, current).agg({"previous": "sum", "current": "sum"})
    assert sorted(fanned.first().asDict().values()) == [24, 60]
    events = frame(
        spark,
        many(30, A, WALL_IMPRESSION, NOON_29) + many(12, A, WALL_IMPRESSION, NOON_30),
    )
    row = count_change(events, "2021-06-30", WALL_IMPRESSION).first()
    assert (row.previous, row.current, row.pct_change) == (30, 12, -60.0)


def test_same_day_of_another_month_is_another_day(spark):
    events = frame(
        spark,
        many(2, A, WALL_IMPRESSION, NOON_30) + many(5, A, WALL_IMPRESSION, "2021-07-30T12:00:00Z"),
    )
    counted = rows(event_counts(events, WALL_IMPRESSION), "event_date", "impressions")
    assert counted == [(dt.date(2021, 6, 30), 2), (dt.date(2021, 7, 30), 5)]
    assert on_days(events, "2021-06-30").count() == 2


def test_day_label_padded_or_not(spark):
    events = frame(
        spark,
        [
            event(A, WALL_IMPRESSION, "2021-07-05T12:00:00Z", day="05"),
            event(A, WALL_IMPRESSION, "2021-07-05T12:00:00Z", day="5"),
            event(A, WALL_IMPRESSION, "2021-07-05T12:00:00Z", day="15"),
            event(A, WALL_IMPRESSION, "no time", day="5"),
        ],
    )
    assert on_day_label(events, "2021-07-05").count() == 3


def test_time_text(spark):
    texts = {
        "2021-06-30T23:59:59.5Z": (
            dt.date(2021, 6, 30),
            dt.datetime(2021, 6, 30, 23, 59, 59, 500000),
        ),
        "2021-06-30T10:00:00": (dt.date(2021, 6, 30), dt.datetime(2021, 6, 30, 10)),
        "2021-06-30 10:00:00": (dt.date(2021, 6, 30), dt.datetime(2021, 6, 30, 10)),
        "2021-06-30": (dt.date(2021, 6, 30), dt.datetime(2021, 6, 30)),
        # The day is that of the instant in UTC.
        "2021-06-30T23:30:00-05:00": (dt.date(2021, 7, 1), dt.datetime(2021, 7, 1, 4, 30)),
        "bad": (None, None),
        "2021-06-30Tbad": (None, None),
        "2021-13-30T10:00:00Z": (None, None),
    }
    events = frame(spark, [event(A, WALL_IMPRESSION, text, day="30") for text in texts])
    # Formatted by Spark: a collected timestamp is shown in the zone of this machine.
    found = {
        r.ISOTIMESTAMP: (r.event_date, r.ts)
        for r in events.selectExpr(
            "ISOTIMESTAMP", "event_date", "cast(cast(event_ts AS timestamp_ntz) AS string) AS ts"
        ).collect()
    }
    for text, (day, ts) in texts.items():
        assert found[text][0] == day, text
        assert (found[text][1] and dt.datetime.fromisoformat(found[text][1])) == ts, text


def test_malformed_time_is_counted_not_lost(spark):
    events = frame(
        spark,
        [
            event(A, WALL_IMPRESSION, "bad", day="30"),
            event(A_NULL, WALL_IMPRESSION, NOON_30),
            {**event(A, WALL_IMPRESSION, NOON_30), "ISOTIMESTAMP": None},
        ],
    )
    row = event_time_quality(events).first()
    assert (row.events, row.missing_time, row.malformed_time, row.null_key) == (3, 1, 1, 1)


def test_union_fills_missing_columns_and_settles_types(spark):
    one = spark.createDataFrame([(12, "30")], "WALL_ID long, DAY string")
    two = spark.createDataFrame([("w", 30, "x")], "WALL_ID string, DAY long, EXTRA string")
    three = spark.createDataFrame([("30",)], "DAY string")
    union = union_reads(one, two, three)
    assert dict(union.dtypes) == {"WALL_ID": "string", "DAY": "string", "EXTRA": "string"}
    assert rows(union, "WALL_ID", "DAY", "EXTRA") == sorted(
        [("12", "30", None), ("w", "30", "x"), (None, "30", None)], key=repr
    )


def test_union_is_a_bag(spark):
    one = spark.createDataFrame([("w",)], "WALL_ID string")
    assert union_reads(one, one).count() == 2


KEY = st.tuples(
    st.sampled_from(["a", "b"]),
    st.sampled_from(["w1", None]),
    st.just("g"),
    st.sampled_from(["c1", "c2", None]),
)
EVENT = st.tuples(
    KEY,
    st.sampled_from([PRODUCT_IMPRESSION, PRODUCT_CLICK, WALL_IMPRESSION]),
    st.sampled_from([NOON_29, NOON_30]),
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(EVENT, min_size=1, max_size=40))
def test_one_pass_equals_the_join_and_plain_counting(spark, bag):
    df = frame(spark, [event(*e) for e in bag])
    columns = (*KEYS, "event_date", "impressions", "clicks", RATE)
    one_pass = rows(rate(df, PRODUCT), *columns)
    joined = rate_by_join(
        event_counts(df, PRODUCT_IMPRESSION), event_counts(df, PRODUCT_CLICK, name="clicks")
    )
    assert one_pass == rows(joined, *columns)

    counted = Counter((keys, time, kind) for keys, kind, time in bag)
    sides = defaultdict(dict)
    for (keys, time, kind), n in counted.items():
        if kind in PRODUCT.types:
            sides[keys, time][kind] = n
    expected = []
    for (keys, time), side in sides.items():
        i, c = side.get(PRODUCT_IMPRESSION), side.get(PRODUCT_CLICK)
        expected.append((*keys, dt.date.fromisoformat(time[:10]), i, c, i / c if i and c else None))
    assert one_pass == sorted(expected, key=repr)

    def rate_of(keys, time):
        side = sides.get((keys, time), {})
        i, c = side.get(PRODUCT_IMPRESSION), side.get(PRODUCT_CLICK)
        return i / c if i and c else None

    compared = []
    for keys in {keys for keys, _ in sides}:
        p, n = rate_of(keys, NOON_29), rate_of(keys, NOON_30)
        compared.append((*keys, p, n, 100 * (n - p) / p if p and n else None))
    columns = (*KEYS, "previous", "current", "pct_change")
    assert rows(rate_change(df, PRODUCT, "2021-06-30"), *columns) == sorted(compared, key=repr)
    stored = rate(event_counts(df, *PRODUCT.types), PRODUCT, count="impressions")
    assert rows(stored) == rows(rate(df, PRODUCT))

    walls = Counter((keys, time) for keys, kind, time in bag if kind == WALL_IMPRESSION)
    both = []
    for keys in {k for k, _ in walls}:
        p, n = walls.get((keys, NOON_29)), walls.get((keys, NOON_30))
        if p and n and None not in keys:
            both.append((*keys, p, n, 100 * (n - p) / p))
    changed = count_change(df, "2021-06-30", WALL_IMPRESSION)
    assert rows(changed, *KEYS, "previous", "current", "pct_change") == sorted(both, key=repr)
    assert of_type(df, WALL_IMPRESSION).count() == sum(walls.values())
