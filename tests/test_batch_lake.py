"""Lakes filled by batch, compacted by closed hour."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import envelope
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.jobs import compact_lakes
from gaugeline.operators.parse import parse_envelopes, raw_lake_rows
from gaugeline.sources.lake import BatchLake
from gaugeline.sources.readers import file_log
from gaugeline.streaming.app import TelemetryApp

DAY = datetime(2026, 8, 9, tzinfo=timezone.utc)


@pytest.fixture
def rows(texts):
    def make(*events):
        """Lake rows of (number, hour, source) events; an hour of None cannot be read."""
        lines = [
            envelope(source=source, ingested_at="?" if hour is None else f"2026-08-09T{hour:02d}:30:00Z", payload=f'{{"id":{number}}}')
            for number, hour, source in events
        ]
        return raw_lake_rows(parse_envelopes(texts(lines)))

    return make


@pytest.fixture
def lake(spark, tmp_path):
    return BatchLake(spark, str(tmp_path / "raw"), schema.RAW_LAKE, schema.LAKE_PARTITIONS)


def numbers(frame):
    payload = F.get_json_object("raw_value", "$.payload")
    return sorted(row[0] for row in frame.select(F.get_json_object(payload, "$.id").cast("int")).collect())


def files(folder):
    return [f for f in folder.rglob("part-*.parquet")]


def test_closed_hours_become_few_files_and_every_row_stays_once(lake, rows, tmp_path):
    for batch in range(4):
        lake.write(rows((batch, 10, "a"), (10 + batch, 11, "a"), (20 + batch, 12, "b")), batch)
    want = sorted([*range(4), *range(10, 14), *range(20, 24)])
    lake.compact(DAY + timedelta(hours=12))
    assert numbers(lake.read()) == want
    assert len(files(tmp_path / "raw" / "closed")) == 2
    lake.compact(DAY + timedelta(hours=13))
    lake.compact(DAY + timedelta(hours=13))
    assert numbers(lake.read()) == want and lake.batches() == []
    assert len(files(tmp_path / "raw" / "closed")) == 3
    assert numbers(lake.read(source="a", hour=11)) == list(range(10, 14))
    plan = lake.read(source="a", hour=11)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(source") == 1 or "hour" in plan


def test_late_rows_of_a_closed_hour_are_read_and_gathered_later(lake, rows):
    lake.write(rows((1, 10, "a"), (2, 15, "a")), 0)
    lake.compact(DAY + timedelta(hours=12))
    lake.write(rows((3, 10, "a"), (4, 15, "a")), 1)
    assert numbers(lake.read()) == [1, 2, 3, 4]
    lake.compact(DAY + timedelta(hours=12))
    lake.compact(DAY + timedelta(hours=11))  # never back
    assert numbers(lake.read()) == [1, 2, 3, 4] and lake.batches() == [0, 1]  # hour 15 is open
    lake.compact(DAY + timedelta(hours=16))
    lake.compact(DAY + timedelta(hours=16))
    assert numbers(lake.read()) == [1, 2, 3, 4] and lake.batches() == []


def test_rows_without_an_hour_or_a_source(lake, rows, spark, texts):
    lake.write(rows((1, None, "a"), (2, 20, None)).unionByName(raw_lake_rows(parse_envelopes(texts(["broken"])))), 0)
    lake.compact(DAY + timedelta(hours=12))
    assert lake.read().count() == 3 and lake.read().filter("source IS NULL").count() == 2
    lake.compact(DAY + timedelta(hours=22))
    assert lake.read().count() == 3 and lake.read().filter("hour IS NULL").count() == 2


def test_replays_and_interrupted_compactions_change_nothing(lake, rows, tmp_path):
    lake.write(rows((1, 10, "a"), (2, 11, "a")), 0)
    lake.write(rows((1, 10, "a"), (2, 11, "a")), 0)
    assert numbers(lake.read()) == [1, 2]
    rows((9, 10, "a")).write.partitionBy(schema.LAKE_PARTITIONS).parquet(f"{lake.path}/closed/part=0")  # never named
    assert numbers(lake.read()) == [1, 2]
    lake.compact(DAY + timedelta(hours=11))
    assert numbers(lake.read()) == [1, 2]
    lake.write(rows((1, 10, "a"), (2, 11, "a")), 0)  # replayed after its compaction
    assert numbers(lake.read()) == [1, 2]
    (tmp_path / "raw" / "open" / "batch_id=1").mkdir()  # begun, not ended
    lake.compact(DAY + timedelta(hours=23))
    lake.write(rows((3, 10, "a")), 1)
    assert numbers(lake.read()) == [1, 2, 3]


def test_frames_opened_before_a_compaction_stay_readable(lake, rows):
    lake.write(rows((1, 10, "a")), 0)
    opened = lake.read()
    lake.compact(DAY + timedelta(hours=12))
    again = lake.read()
    assert numbers(opened) == [1]
    lake.compact(DAY + timedelta(hours=13))
    assert numbers(again) == numbers(lake.read()) == [1]


def test_empty_lakes_and_missing_times(lake, spark, tmp_path):
    assert lake.read().count() == 0
    lake.compact(DAY)
    assert lake.read().count() == 0
    with pytest.raises(ValueError, match="closed"):
        lake.compact()


def test_compaction_of_a_running_application(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log = lambda: file_log(spark, str(tmp_path / "log"), max_files=1)
    app = TelemetryApp(spark, log, str(tmp_path / "tables"), availableNow=True)
    for n in range(3):
        (tmp_path / "log" / f"{n}.txt").write_text(f"bad {n}\n" + envelope(ingested_at=f"2026-08-09T1{n}:00:00Z"))
    app.start_landing(["raw", "quarantine"]).awaitTermination()
    for _ in range(2):
        compact_lakes(spark, str(tmp_path / "tables"), DAY + timedelta(hours=13))
    assert app.raw().count() == 6 and app.quarantine().count() == 3
    assert app.quarantine_lake.batches() == [] and len(app.raw_lake.batches()) == 1
    assert len(files(tmp_path / "tables" / "quarantine" / "closed")) == 1
