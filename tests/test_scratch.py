"""Where checkpoints and staged tables go."""

import pytest

from adpulse.scratch import scratch_dir, scratch_root


class Session:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.conf = {f"spark.{name.replace('_', '.')}": value for name, value in settings.items()}


def test_the_folder_the_cluster_names():
    session = Session(checkpoint_dir="hdfs://shared/tmp/", master="yarn")
    assert scratch_root(session) == "hdfs://shared/tmp"


def test_names_are_new_each_time(spark):
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second and first.startswith(f"{scratch_root(spark)}/adpulse/a-")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session(master="yarn"))


def test_only_a_local_session_uses_the_local_disk():
    assert scratch_root(Session(master="local[2]")).startswith("file:///")


def test_a_real_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == named or (named is None and scratch_root(spark)[:5] == "file:")
