"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from msgstream.operators import dedup
from msgstream.plans import bindings, flows, registry

SF = "/root/testdata/sf0.001"
WRITING = (
    "stream", "job_update", "job_cancel", "job_drain", "window_files", "window_file_shards", "trade_table", "read_queues",
    "distinct_lines", "published", "table_schema",
)
BATCH = [name for name in registry.QUERIES if not name.startswith(WRITING)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SHUFFLE = re.compile(r"\bExchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition).*")


def shuffles(text):
    """All of them, whoever asked."""
    return len(SHUFFLE.findall(text))


def below_first_shuffle(text):
    """What runs before any rows move; plans print their last step first."""
    return SHUFFLE.split(text)[-1]


@pytest.mark.parametrize("name", BATCH)
def test_no_joins_sorts_or_row_at_a_time_python(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Join", "BatchEvalPython", "rangepartitioning"):
        assert operator not in text, operator


@pytest.mark.parametrize(
    "name, most",
    [
        ("text_mapper", 0),
        ("string_mapper", 0),
        ("trade_rows", 0),
        ("trade_quarantine", 0),
        ("word_totals", 1),
        ("window_counts", 1),
        ("freshness_by_queue", 1),
        ("dedup_by_id", 1),
        ("dedup_content", 1),
        ("payload_bag_difference", 1),
        ("word_count_4s_dedup", 2),
        ("redelivery_pairs", 1),
        ("duplicate_totals", 2),
        ("queue_watermarks", 1),
        ("queue_counters_120s", 4),
        ("commit_progress", 2),
        ("queue_status", 2),
        ("delivery_conservation", 2),
    ],
)
def test_shuffle_count(spark, name, most):
    assert shuffles(plan(registry.QUERIES[name](spark, SF))) <= most


@pytest.mark.parametrize("name", ["dedup_by_id", "dedup_content", "word_count_4s_dedup", "dedup_across_windows"])
def test_copies_are_dropped_before_the_shuffle(spark, name):
    below = below_first_shuffle(plan(registry.QUERIES[name](spark, SF)))
    assert "WindowGroupLimit" in below and "Partial" in below


def test_counts_are_combined_before_the_shuffle(spark):
    below = below_first_shuffle(plan(registry.QUERIES["word_totals"](spark, SF)))
    assert "partial_count" in below


def test_only_needed_columns_are_read(spark):
    text = plan(registry.QUERIES["word_totals"](spark, SF))
    assert re.search(r"ReadSchema: struct<text:string>", text)
    text = plan(registry.global_count(spark, SF))
    assert set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", text)[1])) <= {"value"}


def test_text_is_not_carried_past_the_words(spark):
    """The word shuffle moves window, word and count only."""
    df = flows.deduplicated_word_count(bindings.document_messages(bindings.table(spark, SF, "documents")))
    assert re.search(r"Exchange hashpartitioning\(window#\d+, word#\d+", plan(df))
    final = plan(df).split("Exchange hashpartitioning")[1]
    assert "text" not in final.splitlines()[1]


@pytest.mark.parametrize("name", ["redelivery_pairs", "duplicate_totals"])
def test_receipts_move_no_text(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert all(not re.search(r"\btext#", line) for line in SHUFFLE.findall(text))


@pytest.mark.parametrize("name", ["trade_rows", "trade_quarantine"])
def test_fields_are_cast_once(spark, name):
    """Payloads are parsed once. Quotes are typed after they became rows, each kind once and by no lambda, whatever is
    asked of the values after it; all of that is compiled."""
    text = plan(registry.QUERIES[name](spark, SF))
    assert text.count("from_json") == 1 and "lambda" not in text
    for kind in ("array<int>", "array<float>", "date"):
        assert len(re.findall(rf"try_cast\([^()]*(?:\([^()]*\))?[^()]* as {kind}\)", text)) == 1, kind
    generators = [line for line in text.splitlines() if "Generate " in line]
    assert generators and all("*(" in line for line in generators)


@pytest.mark.parametrize("name", ["trade_rows", "trade_quarantine"])
def test_methods_are_small_enough_for_java_to_compile(spark, name):
    """Java leaves methods of more than 8,000 bytes to its interpreter."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenString(registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan())
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000


def test_missing_keys_are_not_shuffled(spark):
    """Rows without a sequence number bypass the exchange, so that they cannot pile up on one task."""
    rows = flows.windowed(registry.event_texts(spark, SF), "4 seconds")
    text = plan(dedup.distinct_by_sequence(rows))
    assert "Union" in text and shuffles(text) == 1


def test_queue_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).select((F.col("id") % 2).cast("string").alias("queue"), "id").write.partitionBy("queue").parquet(f"{tmp_path}/t")
    from msgstream.sources.queues import select_queues

    text = plan(select_queues(spark.read.parquet(f"{tmp_path}/t"), ["1", "1"]))
    assert "PartitionFilters: [isnotnull(queue" in text
