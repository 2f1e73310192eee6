from datetime import timedelta

import pytest

from msgstream.config import (
    ReadConfig,
    default_table_name,
    normalize_job_name,
    queue_list,
)
from msgstream.scratch import shared_folder


def test_defaults():
    config = ReadConfig(["a"])
    assert config.trigger == {"processingTime": "500 milliseconds"}
    assert not config.use_sender_timestamp and not config.bounded
    assert config.max_records is None and config.max_read_time is None


@pytest.mark.parametrize("limit", [{"max_records": 1}, {"max_read_time": timedelta(seconds=1)}, {"batch": True}])
def test_what_makes_a_batch(limit):
    assert ReadConfig(["a"], **limit).bounded


@pytest.mark.parametrize("queues", [None, [], "a", [""], ["a", None]])
def test_queues_are_a_list_of_names(queues):
    for make in (ReadConfig, lambda q: ReadConfig(["a"]).with_(queues=q)):
        with pytest.raises(ValueError, match="queues: expected"):
            make(queues)


@pytest.mark.parametrize("name", ["poll_ms", "max_records", "max_read_time", "max_files_per_trigger"])
@pytest.mark.parametrize("factor", [0, -1])
def test_limits_are_above_zero(name, factor):
    one = timedelta(milliseconds=1) if name == "max_read_time" else 1
    assert getattr(ReadConfig(["a"], **{name: one}), name) == one
    with pytest.raises(ValueError, match=f"{name}: expected more than 0"):
        ReadConfig(["a"]).with_(**{name: one * factor})


def test_summary_shows_what_was_set_and_no_options():
    assert ReadConfig(["b", "a", "b"]).summary() == "read queues=b,a"
    config = ReadConfig(["a"], max_records=5, batch=True, options={"password": "hidden", "host": "hidden"})
    assert config.summary() == "read queues=a max_records=5 batch=True"
    assert "hidden" not in repr(config) + config.summary()


def test_queue_list_trims_and_drops_empties():
    assert queue_list("a, b,,c ,") == ["a", "b", "c"]


def test_repeated_names_count_once():
    assert ReadConfig(["b", "a", "b"]).unique_queues == ["b", "a"]


def test_rate_options():
    assert ReadConfig(["a"]).rate_options == {}
    assert ReadConfig(["a"], max_files_per_trigger=3).rate_options == {"maxFilesPerTrigger": "3"}


def test_names():
    assert default_table_name("my-job-1") == "my_job_1"
    assert normalize_job_name("My job.1") == "my-job-1"
    assert normalize_job_name("9 lives") == "a-lives"


def test_shared_folder_is_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{base}/msgstream-") and "/x-" in first and first != second
