"""Starting streams and waiting for them.

The checkpoint lives inside the output directory. Batch ids restart with a new
checkpoint, so an output must never outlive or change the checkpoint it was written
with.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adpulse.streaming.changelog import batch_writer

FINAL_DAYS = "days"

# State for many keys belongs in RocksDB, off the heap, with only its changes uploaded
# per batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start streams inside this to keep their state in RocksDB, in this many partitions;
    None takes the session's number of shuffle partitions.

    A stream reads its settings when it is started and keeps the state store and the number
    of partitions of its first start for good. The session gets its own settings back.
    """
    settings = dict(STATE_STORE)
    if partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def checkpoint_of(path: str) -> str:
    return f"{path}/_checkpoint"


def start_upserts(
    result: DataFrame,
    path: str,
    every: str | None = "1 second",
    compact_every: int | None = None,
    key: tuple[str, ...] = (),
) -> StreamingQuery:
    """Update mode into the change log at ``path``. ``every=None`` works off what has
    arrived so far and ends. The log is folded after every ``compact_every`` batches."""
    return (
        result.writeStream.outputMode("update")
        .foreachBatch(batch_writer(path, compact_every, key))
        .option("checkpointLocation", checkpoint_of(path))
        .trigger(**_trigger(every))
        .start()
    )


def start_finals(result: DataFrame, path: str, every: str | None = "1 second") -> StreamingQuery:
    """Append mode into day partitions: each day once, after its lateness has passed."""
    return (
        result.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("event_date")
        .option("path", f"{path}/{FINAL_DAYS}")
        .option("checkpointLocation", checkpoint_of(path))
        .trigger(**_trigger(every))
        .start()
    )


def wait(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait until the stream ends; stop it and complain when it does not end in time."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream {query.id} still running after {seconds} s")
