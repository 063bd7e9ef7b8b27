"""The physical plans: scans, exchanges, pushdown, pruning, skew."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adpulse.functions.event_time import with_event_time
from adpulse.model import KEYS, PRODUCT, PRODUCT_IMPRESSION, WALL_IMPRESSION
from adpulse.operators.changes import compare_rates, join_days, regroup
from adpulse.operators.counts import event_counts
from adpulse.operators.rates import RATE, rate
from adpulse.operators.selection import of_type, on_days
from adpulse.plans.streams import COUNT_KEY
from adpulse.plans.tables import RATE_TABLE
from adpulse.registry.queries import QUERIES
from adpulse.sinks import catalog
from adpulse.sinks.daily import overwrite_range, read_days
from adpulse.sources.landing import read_json, read_landing_table
from adpulse.sources.tables import table_events
from adpulse.streaming.changelog import batch_writer, latest, read_changes
from tests.events import many, rows, write_lines

SF_DIR = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    """The plan with filters and schemas in full."""
    explain = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def scans(text, table):
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", text))


@pytest.mark.parametrize(
    "name, expected",
    [
        ("rate_product", (1, 1)),
        ("rate_product_day", (1, 1)),
        ("rate_product_join", (2, 5)),
        ("dod_rate_product", (1, 1)),
        ("dod_rate_product_days", (1, 2)),
        ("dod_wall", (1, 1)),
        ("dod_wall_days", (1, 2)),
        ("count_wall_daily", (1, 1)),
        ("window_wall_batch", (1, 1)),
    ],
)
def test_scans_and_exchanges(spark, name, expected):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert (scans(text, "events"), exchanges(text)) == expected
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_wall_comparison_joins_inner(spark):
    text = plan(QUERIES["dod_wall_join"](spark, SF_DIR))
    assert "FullOuter" not in text and "Inner" in text


def test_type_and_day_reach_the_scan(spark):
    text = formatted(QUERIES["rate_product_day"](spark, SF_DIR))
    pushed = re.findall(r"PushedFilters: \[(.*)\]\nReadSchema: struct<(.*)>", text)[0]
    assert "In(event_type" in pushed[0]
    assert "GreaterThanOrEqual(ts" in pushed[0] and "LessThan(ts" in pushed[0]
    assert "event_id" not in pushed[1]


def test_json_scan_gets_the_type_and_only_the_columns_used(spark, tmp_path):
    write_lines(tmp_path / "f.json", many(1, ("a", "w", "g", "c"), WALL_IMPRESSION, "2021-06-30"))
    events = with_event_time(read_json(spark, str(tmp_path)))
    text = formatted(event_counts(events, WALL_IMPRESSION))
    assert "EqualTo(EVENT_TYPE,wall-impression)" in text
    assert "DAY:" not in re.findall(r"ReadSchema: struct<(.*)>", text)[0]


def test_landing_table_prunes_partitions_and_pushes_the_date(spark, tmp_path):
    events = table_events(spark, SF_DIR).selectExpr(
        *KEYS,
        "EVENT_TYPE",
        "DAY",
        "ISOTIMESTAMP",
        "CAST(NULL AS TIMESTAMP) AS event_ts",
        "event_date",
        "landing_date",
        "CAST(landing_hour AS INT) AS landing_hour",
    )
    table = f"{tmp_path}/table"
    few = events.where("landing_date BETWEEN '2024-01-14' AND '2024-01-16'")
    few = few.where("landing_hour IN (0, 22, 23)")
    few.write.partitionBy("landing_date", "landing_hour").parquet(table)
    df = read_landing_table(spark, table, "2024-01-15")
    df = on_days(of_type(df, PRODUCT_IMPRESSION), "2024-01-15")
    text = formatted(df)
    assert re.search(r"PartitionFilters: \[[^]]*landing_date", text)
    assert "EqualTo(event_date,2024-01-15)" in text
    # Hour 23 before, the three hours of the day, hour 0 after.
    read = read_landing_table(spark, table, "2024-01-15")
    assert len(read.inputFiles()) >= 5
    read.collect()
    metrics = read._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numPartitions").value() == 5


def test_stored_days_are_pruned(spark, tmp_path):
    table = f"{tmp_path}/rates"
    overwrite_range(rate(table_events(spark, SF_DIR), PRODUCT), table, "2024-01-01", "2024-01-30")
    stored = compare_rates(read_days(spark, table, RATE_TABLE), "2024-01-30")
    text = plan(stored)
    assert re.search(r"PartitionFilters: \[[^]]*event_date", text) and exchanges(text) == 1
    # One file per day at this size: the days were not spread over every task.
    files = read_days(spark, table, RATE_TABLE).inputFiles()
    assert len(files) == 30


def test_latest_is_one_hash_aggregation(spark, tmp_path):
    counted = event_counts(table_events(spark, SF_DIR), WALL_IMPRESSION)
    window = F.struct(F.col("event_date").alias("start"), F.date_add("event_date", 1).alias("end"))
    counted = counted.withColumn("window", window).select(*COUNT_KEY, "impressions")
    batch_writer(f"{tmp_path}/out")(counted, 0)
    newest = latest(read_changes(spark, f"{tmp_path}/out", counted.schema), COUNT_KEY)
    text = plan(newest.where("event_date = '2024-01-30'"))
    assert exchanges(text) == 1
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert re.search(r"PartitionFilters: \[[^]]*event_date", text)


def test_no_query_leaves_the_jvm(spark):
    for name, query in QUERIES.items():
        if name.startswith(("stream_", "sink_", "insight_", "scan_", "json_", "catalog_")):
            continue  # their frames only read back what they wrote
        text = plan(query(spark, SF_DIR))
        assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoop", text), name


def test_no_module_leaves_the_jvm():
    """The queries that write run on the same modules: none of them has Python on the data
    path."""
    package = Path(__file__).resolve().parents[1] / "adpulse"
    python = re.compile(r"udf\(|mapIn|applyIn|toPandas|toArrow|\.rdd\b|mapPartitions|crossJoin")
    for module in package.rglob("*.py"):
        if "llm" not in module.parts:
            assert not python.search(module.read_text()), module


def test_a_hot_user_when_the_customers_are_too_large_to_broadcast(spark, tmp_path):
    """A third of all events on one user, and a shuffled join: same result, and adaptive
    execution splits the partition that user falls into."""
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    hot = events.withColumn("user_id", F.expr("if(event_id % 3 = 0, 7, user_id)"))
    hot.repartition(16).write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.1/customer.parquet").write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    expected = rows(QUERIES["rate_product"](spark, str(tmp_path)))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        df = QUERIES["rate_product"](spark, str(tmp_path))
        assert rows(df) == expected
        text = plan(df)
        assert "SortMergeJoin(skew=true)" in text, text
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_days_laid_out_by_key_are_compared_without_an_exchange(spark, tmp_path):
    catalog.ensure_database(spark, "plans_test", f"{tmp_path}/db")
    try:
        daily = rate(table_events(spark, SF_DIR, PRODUCT.types), PRODUCT)
        expected = rows(compare_rates(daily, "2024-01-30"), *KEYS, "previous", "current")
        first = daily.where("event_date < '2024-01-30'")
        catalog.replace_table(first, "plans_test", "rates", 8)
        catalog.append_table(daily.where("event_date = '2024-01-30'"), "plans_test", "rates", 8)
        stored = catalog.read_table(spark, "plans_test", "rates")
        compared = compare_rates(stored, "2024-01-30")
        assert "Exchange" not in plan(compared)
        assert rows(compared, *KEYS, "previous", "current") == expected
        sides = [
            on_days(stored, day).select(*KEYS, F.col(RATE).alias(name))
            for day, name in (("2024-01-29", "previous"), ("2024-01-30", "current"))
        ]
        joined = join_days(sides[0], sides[1].hint("merge"))
        assert "Exchange" not in plan(joined)
        assert rows(regroup(joined), *KEYS, "previous", "current") == expected
        assert "PushedFilters: [IsNotNull(event_date)" in formatted(compared)
    finally:
        spark.sql("DROP DATABASE plans_test CASCADE")
