import json
import subprocess
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import reading

from gaugeline import jobs, schema
from gaugeline.sources.keyed import METRICS, RECORDS, KeyedTable
from gaugeline.sources.readers import file_log
from gaugeline.sources.writers import write_text_log
from gaugeline.streaming.app import TelemetryApp

NOON = datetime(2026, 8, 9, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Tables of one day's stream of two sources."""
    folder = tmp_path_factory.mktemp("site")
    lines = [reading(n, temperature=n, minute=n, source="ab"[n % 2]) for n in range(20)]
    (folder / "log").mkdir()
    (folder / "log" / "1.txt").write_text("\n".join(lines))
    log = lambda: file_log(spark, str(folder / "log"))
    TelemetryApp(spark, log, str(folder / "tables"), availableNow=True).run()
    return str(folder / "tables")


def test_daily_summary_keeps_sources_apart(spark, root):
    jobs.daily(spark, root, NOON)
    table = jobs.daily(spark, root, NOON + timedelta(hours=1))
    rows = {row.source: (row.total_records, float(row.avg_temperature)) for row in table.latest().collect()}
    assert rows == {"a": (10, 9.5), "b": (10, 9.5)}  # means of window means, not of records
    assert {row.last_updated for row in table.latest().collect()} == {datetime(2026, 8, 9, 13)}
    other = jobs.daily(spark, root, NOON + timedelta(days=1))
    assert other.latest().count() == 2


def test_check(spark, root):
    records = KeyedTable(spark, f"{root}/records", RECORDS).latest()
    newest = records.agg({"processed_at": "max"}).first()[0].replace(tzinfo=timezone.utc)
    jobs.check(spark, root, newest)
    with pytest.raises(RuntimeError, match="freshness"):
        jobs.check(spark, root, newest + timedelta(minutes=16))
    bad = KeyedTable(spark, f"{root}/metrics", METRICS)
    row = ("c", datetime(2026, 8, 9), 10, 9, 1, 0, 0, 0, 0, 90.0)
    bad.upsert(spark.createDataFrame([row], schema.METRICS), 1000)
    jobs.check(spark, root, newest, source="a")
    with pytest.raises(RuntimeError, match="quality_rate"):
        jobs.check(spark, root, newest)


def test_purge(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "records"), RECORDS)
    for batch in range(3):
        moment = datetime(2026, 8, 1 + 4 * batch)
        row = (f"k{batch}", "s", moment, 1, moment, 1.0, 1.0, 1.0, "{}", moment)
        table.upsert(spark.createDataFrame([row], schema.RECORDS), batch)
    jobs.purge(spark, str(tmp_path), NOON)
    assert {row.event_id for row in table.latest().collect()} == {"k1", "k2"}
    assert table.last_batch() == 2  # still there for frames opened before
    jobs.purge(spark, str(tmp_path), NOON + timedelta(days=4))
    assert {row.event_id for row in table.latest().collect()} == {"k2"}
    for _ in range(2):
        jobs.purge(spark, str(tmp_path), NOON + timedelta(days=4))
    names = sorted(folder.name for folder in (tmp_path / "records" / "base").iterdir())
    assert names == ["version=3", "version=4"]
    assert not list((tmp_path / "records" / "log").glob("batch_id=*"))


def test_purge_a_month_after_one_run(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "1.txt").write_text("\n".join(reading(n, minute=n) for n in range(5)))
    log = lambda: file_log(spark, str(tmp_path / "log"))
    app = TelemetryApp(spark, log, str(tmp_path / "tables"), availableNow=True)
    app.start_landing(["records"]).awaitTermination()
    assert app.records.latest().count() == 5
    jobs.purge(spark, str(tmp_path / "tables"), NOON + timedelta(days=30), snapshots=1)
    assert app.records.latest().count() == 0
    stored = [str(file) for file in (tmp_path / "tables" / "records").rglob("*.parquet") if "manifest" not in str(file)]
    assert sum(spark.read.parquet(file).count() for file in stored) == 0
    (tmp_path / "log" / "2.txt").write_text(reading(9, minute=50))
    app.start_landing(["records"]).awaitTermination()
    assert [row.record_id for row in app.records.latest().collect()] == [9]


def test_a_batch_without_its_end_is_not_folded(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "records"), RECORDS)
    moment = datetime(2026, 8, 1)
    for batch in range(2):
        row = (f"k{batch}", "s", moment, 1, moment, 1.0, 1.0, 1.0, "{}", moment)
        table.upsert(spark.createDataFrame([row], schema.RECORDS), batch)
    (tmp_path / "records" / "log" / "batch_id=1" / "_SUCCESS").unlink()
    assert table.last_batch() == 0
    table.compact()
    assert {row.event_id for row in table.latest().collect()} == {"k0", "k1"}
    table.vacuum(1)
    assert [f.name for f in (tmp_path / "records" / "log").glob("batch_id=*")] == ["batch_id=1"]


def test_documents_to_log_to_records(spark, tmp_path):
    for source, text in {"on": '{"x":1,"h":{"id":[1,2],"temperature":[5,6]}}', "off": '{"id":3}'}.items():
        folder = tmp_path / "documents" / f"source={source}"
        folder.mkdir(parents=True)
        (folder / "one.json").write_text(text)
    registry = spark.createDataFrame([("on", "active"), ("off", "paused")], "name STRING, status STRING")
    documents = jobs.landed_documents(spark, str(tmp_path / "documents"))
    write_text_log(jobs.ingest(documents, registry), str(tmp_path / "log"))
    log = lambda: file_log(spark, str(tmp_path / "log"))
    app = TelemetryApp(spark, log, str(tmp_path / "tables"), availableNow=True)
    app.start_landing(["records"]).awaitTermination()
    rows = app.records.latest().orderBy("record_id").collect()
    assert [(r.source, r.record_id, r.temperature) for r in rows] == [("on", 1, 5.0), ("on", 2, 6.0)]
    assert json.loads(rows[0].payload) == {"x": 1, "id": 1, "temperature": 5}


def test_command_line_lists_the_jobs():
    home = Path(__file__).parent.parent
    run = subprocess.run(
        [sys.executable, "-m", "gaugeline.jobs", "--help"], cwd=home, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0 and "{ingest,stream,daily,check,purge,compact}" in run.stdout
