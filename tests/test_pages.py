"""Deep pages by counting, and pages that continue behind a window."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.operators import pages

START = datetime(2026, 8, 9)


@pytest.fixture(scope="module")
def records(spark):
    """Events of three days with many in one second, some at equal times and some without a time."""
    chance = random.Random(6)
    rows = []
    for k in range(3000):
        moment = START + timedelta(seconds=chance.randrange(3 * 86400) if k % 3 else 5, microseconds=k % 7)
        rows.append((f"e{k:05d}", "ab"[k % 5 == 0], START, k, None if k % 50 == 0 else moment, 1.0, 2.0, 3.0, "{}", START))
    return spark.createDataFrame(rows, schema.RECORDS).repartition(6).cache()


@pytest.mark.parametrize("near", [10_000, 50, 0])
@pytest.mark.parametrize("offset", [0, 3, 55, 700, 2350, 2395, 5000])
def test_deep_pages_equal_sorting_everything(records, monkeypatch, offset, near):
    monkeypatch.setattr(pages, "NEAR_ENOUGH", near)
    want = pages.records_page(records, "a", 20, offset).collect()
    assert pages.records_page_at(records, "a", 20, offset).collect() == want


def test_no_task_sorts_what_lies_before_a_deep_page(records, monkeypatch):
    monkeypatch.setattr(pages, "NEAR_ENOUGH", 10)
    page = pages.records_page_at(records, "a", 20, 2000)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan or "offset" in plan.lower()
    kept = page._jdf.queryExecution().optimizedPlan().toString()
    inner = next(line for line in kept.splitlines() if "Filter" in line)
    assert "event_timestamp" in inner
    offset = int(next(line for line in kept.splitlines() if "Offset" in line).split("Offset ")[1].split()[0].split(",")[0])
    assert offset < 1100  # a third of the rows fall into one second


def test_unreasonable_pages_are_refused(records):
    for limit, offset in [(0, 0), (1001, 0), (5, -1)]:
        with pytest.raises(ValueError):
            pages.records_page_at(records, "a", limit, offset)


def test_windows_behind_a_window(spark):
    rows = [("a", START + timedelta(minutes=5 * k), START, float(k), 0.0, k) for k in range(50)] + [("b", START, START, 1.0, 1.0, 1), ("a", None, None, 1.0, 1.0, 1)]
    frame = spark.createDataFrame(rows, schema.AGGREGATES)
    after = F.lit("2026-08-09 01:00:00").cast("timestamp")
    assert [r.record_count for r in pages.aggregates_page_after(frame, "a", after, 5).collect()] == [11, 10, 9, 8, 7]
    first = pages.aggregates_page_after(frame, "a", F.lit(None).cast("timestamp"), 2).collect()
    assert [(r.record_count, r.avg_humidity) for r in first] == [(49, None), (48, None)]
    assert pages.aggregates_page_after(frame, "a", F.lit("2020-01-01").cast("timestamp")).count() == 0
