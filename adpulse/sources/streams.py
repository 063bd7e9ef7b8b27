"""Event streams: files picked up from the landing directories as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.event_time import with_event_time
from adpulse.model import EVENT_SCHEMA


#: A century. The source's own default leaves out files a week older than the newest one.
MAX_FILE_AGE = "36500d"


def stream_events(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    **options: str,
) -> DataFrame:
    """Stream JSON lines below ``path`` under the same schema as the batch reads.

    Every file is read, however old and however many have piled up. A cap on files per
    micro-batch moves the watermark between them, so with a watermark it decides which events
    are late unless files arrive in event order; it is for backlogs of such files.

    ``path`` may be a glob. Keep it to the directories still receiving files: every
    trigger lists all of it, and the source remembers every file it has seen that is not older
    than ``max_file_age``. ``cleanSource``, and other options, pass through.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE")
    reader = reader.option("maxFileAge", max_file_age)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    columns = EVENT_SCHEMA.fieldNames()
    return with_event_time(reader.options(**options).json(path).select(*columns))


def count_arrivals(events: DataFrame, name: str = "arrivals") -> DataFrame:
    """Report each micro-batch's rows, and those without a usable time, in the query's
    progress under ``observedMetrics``.

    Counted before any aggregation. The state operator's own counter of rows dropped as
    late counts partial groups, not events.
    """
    return events.observe(
        name,
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_ts").isNull()).alias("without_time"),
    )
