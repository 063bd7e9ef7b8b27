"""Small hand-made events."""

import json
import os

from adpulse.functions.event_time import with_event_time
from adpulse.model import EVENT_SCHEMA


def event(keys, kind, time, day=None):
    """One event as a dict; keys is a tuple in the order of the key columns."""
    names = EVENT_SCHEMA.names
    return dict(zip(names, (*keys, kind, day if day is not None else time[8:10], time)))


def many(count, *args, **kwargs):
    return [event(*args, **kwargs) for _ in range(count)]


def frame(spark, events):
    rows = [tuple(e[name] for name in EVENT_SCHEMA.names) for e in events]
    return with_event_time(spark.createDataFrame(rows, EVENT_SCHEMA))


def write_lines(path, events, mtime=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    path.write_text("\n".join(lines) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def rows(df, *columns):
    """Rows as a list that does not depend on their order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
