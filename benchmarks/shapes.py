"""The daily rate from landed JSON, in two shapes, on events multiplied from the tables.

One shape infers the schema of three reads, unites them, counts each side and joins the
counts. The other is what the package does: one read under a declared schema and one
aggregation. Both must give the same rows. Runs alternate.

    python benchmarks/shapes.py [copies per event, default 50] [runs, default 3]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adpulse.model import EVENT_SCHEMA, KEYS, PRODUCT  # noqa: E402
from adpulse.operators.rates import RATE, rate  # noqa: E402
from adpulse.operators.selection import on_days  # noqa: E402
from adpulse.scratch import scratch_dir  # noqa: E402
from adpulse.sources.landing import PARTITIONED, landing_dirs, read_landing  # noqa: E402
from adpulse.sources.tables import table_events  # noqa: E402

DAY = "2024-01-15"


def land(spark: SparkSession, sf_dir: str, copies: int) -> str:
    """Three landing days around DAY, every event repeated, a third of them on one key."""
    base = scratch_dir(spark, "shapes")
    events = table_events(spark, sf_dir).where("landing_date BETWEEN '2024-01-14' AND '2024-01-16'")
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = (F.col("event_id") + F.col("copy")) % 3 == 0
    (
        many.withColumn("BRAND", F.when(hot, F.lit("HOT")).otherwise(F.col("BRAND")))
        .withColumn("WALL_ID", F.when(hot, "w").otherwise(F.concat_ws("-", "WALL_ID", "copy")))
        .select(*EVENT_SCHEMA.names, "landing_date", "landing_hour")
        .hint("rebalance", "landing_date", "landing_hour")
        .write.partitionBy("landing_date", "landing_hour")
        .json(base)
    )
    return base


def one_pass(spark: SparkSession, base: str) -> DataFrame:
    events = on_days(read_landing(spark, base, DAY, layout=PARTITIONED), DAY)
    return rate(events, PRODUCT).select(*KEYS, RATE)


def join_of_inferred_reads(spark: SparkSession, base: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    before, day, after = (
        reader.json(f"{base}/{name}") for name in landing_dirs(DAY, layout=PARTITIONED)
    )
    events = day.unionByName(before, True).unionByName(after, True).where(f"DAY = '{DAY[-2:]}'")
    sides = [
        events.where(F.col("EVENT_TYPE") == kind)
        .groupBy(*KEYS, "DAY")
        .agg(F.count("*").alias(name))
        for kind, name in zip(PRODUCT.types, ("impressions", "clicks"))
    ]
    joined = sides[0].join(sides[1], [*KEYS, "DAY"], "full")
    return (
        joined.groupBy(*KEYS, "DAY")
        .agg((F.sum("impressions") / F.sum("clicks")).alias(RATE))
        .select(*KEYS, RATE)
    )


def main() -> None:
    copies, runs = (int(a) for a in (sys.argv[1:] + ["50", "3"][len(sys.argv) - 1 :])[:2])
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("adpulse-shapes")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = land(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), copies)
    shapes = {"one_pass": one_pass, "join_of_inferred_reads": join_of_inferred_reads}
    results = [shape(spark, base) for shape in shapes.values()]
    same = all(a.exceptAll(b).isEmpty() for a, b in (results, results[::-1]))
    landed = read_landing(spark, base, DAY, layout=PARTITIONED)
    print("events on the day:", on_days(landed, DAY).count())
    print("groups:", results[0].count(), "same rows:", same)
    for _ in range(runs):
        for name, shape in shapes.items():
            start = time.perf_counter()
            shape(spark, base).write.format("noop").mode("overwrite").save()
            print(f"{name}: {time.perf_counter() - start:.2f} s")
    spark.stop()


if __name__ == "__main__":
    main()
