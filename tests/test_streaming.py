import os

import pytest
from conftest import envelope, reading
from pyspark.sql import functions as F

from gaugeline.operators.parse import parse_envelopes, parse_payload, typed_events
from gaugeline.operators.quality import flag_quality, valid_rows
from gaugeline.operators.windows import quality_windows, telemetry_windows
from gaugeline.sources.keyed import AGGREGATES, KeyedTable
from gaugeline.sources.readers import file_log
from gaugeline.streaming.app import TelemetryApp

WINDOW = ["source", "window_start", "avg_temperature", "avg_humidity", "record_count"]


@pytest.fixture
def site(spark, tmp_path):
    """A log folder to append to and an application over it."""

    class Site:
        files = 0

        def app(self, **options):
            options = {"availableNow": True} | options
            log = lambda: file_log(spark, str(tmp_path / "log"), max_files=1)
            return TelemetryApp(spark, log, str(tmp_path / "tables"), **options)

        def send(self, *lines):
            (tmp_path / "log").mkdir(exist_ok=True)
            self.files += 1
            file = tmp_path / "log" / f"{self.files:03d}.txt"
            file.write_text("\n".join(lines) + "\n")
            os.utime(file, (1e9 + self.files, 1e9 + self.files))  # files are read by age

    return Site()


def rows(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


def run(app, *names):
    for name in names:
        getattr(app, f"start_{name}")().awaitTermination()


def test_routing(site):
    bad = envelope(payload={"humidity": 150})
    neither = envelope(payload={"temperature": "very hot"})
    site.send(reading(1), bad, neither, "hello", envelope(ingested_at="nope"))
    app = site.app()
    run(app, "landing")
    assert app.raw().count() == 5
    assert rows(app.quarantine(), "source", "raw_value") == sorted(
        [("m", bad), (None, "hello"), ("m", envelope(ingested_at="nope"))], key=repr
    )
    assert [r.record_id for r in app.records.latest().collect()] == [1]


def test_stream_equals_batch(site, spark, tmp_path):
    lines = [reading(n, temperature=n % 40, minute=n // 4, source=f"s{n % 3}") for n in range(120)]
    for start in range(0, 120, 30):
        site.send(*lines[start : start + 30])
    app = site.app()
    app.run()
    log = file_log(spark, str(tmp_path / "log"), streaming=False)
    flagged = flag_quality(parse_payload(parse_envelopes(log)))
    events = typed_events(valid_rows(flagged))
    assert rows(app.aggregates.latest(), *WINDOW) == rows(telemetry_windows(events), *WINDOW)
    names = ["source", "run_timestamp", "total_records", "valid_records", "quality_rate"]
    assert rows(app.metrics.latest(), *names) == rows(quality_windows(flagged), *names)
    assert rows(app.processed(), "event_id", "temperature") == rows(events, "event_id", "temperature")
    assert app.records.latest().count() == 120


def test_copies_within_and_across_batches(site):
    site.send(*[reading(1, temperature=20)] * 3, reading(2, temperature=30))
    site.send(*[reading(1, temperature=25)] * 3)
    app = site.app()
    app.run()
    assert rows(app.processed(), "id", "temperature") == [(1, 20.0), (2, 30.0)]
    assert rows(app.aggregates.latest(), "avg_temperature", "record_count") == [(25.0, 2)]
    # the records table takes the values of the newer batch
    assert rows(app.records.latest(), "record_id", "temperature", "temperature_f") == [
        (1, 25.0, 68.0),
        (2, 30.0, 86.0),
    ]
    assert app.raw().count() == 7


def test_many_copies_of_one_event(site):
    site.send(*[reading(1)] * 5000, *[reading(n) for n in range(2, 50)])
    for slots in (1, 16):
        app = site.app(copy_slots=slots)
        app.root += f"/slots-{slots}"
        run(app, "processed")
        assert app.processed().count() == 49


def test_late_events_reach_records_but_not_windows(site):
    site.send(reading(1, minute=0))
    site.send(reading(2, minute=60))
    site.send(reading(3, minute=61))
    site.send(reading(4, minute=1))  # an hour behind
    app = site.app()
    app.run()
    assert rows(app.records.latest(), "record_id") == [(1,), (2,), (3,), (4,)]
    assert rows(app.processed(), "id") == [(1,), (2,), (3,)]
    assert sum(r.record_count for r in app.aggregates.latest().collect()) == 3


def test_restart_continues_the_windows(site):
    site.send(reading(1, temperature=10), reading(2, temperature=20, minute=1))
    site.app().run()
    site.send(reading(3, temperature=30, minute=2), reading(1, temperature=99))
    app = site.app()
    app.run()
    assert rows(app.aggregates.latest(), "avg_temperature", "record_count") == [(20.0, 3)]
    assert rows(app.processed(), "id") == [(1,), (2,), (3,)]
    assert app.records.latest().count() == 3
    site.app().run()  # nothing new
    assert app.aggregates.latest().count() == 1 and app.raw().count() == 4


def test_replay_after_a_crash_in_the_sink(site, spark):
    """A batch that failed after part of its writes is repeated without double rows."""
    site.send(reading(1), reading(2), "hello")
    app = site.app()
    upsert = app.records.upsert

    def crash(batch, batch_id):
        raise RuntimeError("executor lost")

    object.__setattr__(app.records, "upsert", crash)
    with pytest.raises(Exception, match="executor lost"):
        run(app, "landing")
    assert app.raw().count() == 3  # written before the crash
    object.__setattr__(app.records, "upsert", upsert)
    run(app, "landing")
    assert app.raw().count() == 3 and app.quarantine().count() == 1
    assert rows(app.records.latest(), "record_id") == [(1,), (2,)]


def test_unknown_source_in_metrics(site):
    site.send(envelope(source=None), reading(1))
    app = site.app()
    run(app, "metrics")
    assert rows(app.metrics.latest(), "source", "invalid_records") == [("__unknown__", 1), ("m", 0)]


def test_lake_layout_prunes(site, spark):
    site.send(reading(1, source="a"), reading(2, source="b", minute=70))
    app = site.app()
    run(app, "landing")
    one = app.raw().filter((F.col("source") == "a") & (F.col("hour") == 12))
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_queries_stop_together(site):
    site.send(reading(1))
    app = site.app(availableNow=None, processingTime="1 second")
    app.trigger = {"processingTime": "1 second"}
    queries = app.start_all()
    try:
        for query in queries:
            query.processAllAvailable()
        assert {query.name for query in queries} == {"landing", "processed", "aggregates", "metrics"}
        assert app.records.latest().count() == 1
    finally:
        for query in queries:
            query.stop()


def state_keys(spark, app, name, operator):
    path = f"{app.root}/checkpoints/{name}"
    return spark.read.format("statestore").option("operatorId", operator).load(path).count()


def test_the_state_forgets_what_the_watermark_has_passed(site, spark):
    for hour in range(4):
        site.send(*[reading(100 * hour + n, minute=60 * hour + n % 5) for n in range(40)])
    site.send(*[reading(n, minute=n % 5) for n in range(40)])  # three hours late
    app = site.app(copy_slots=1)
    run(app, "processed")
    assert app.processed().count() == 160
    assert state_keys(spark, app, "processed", 0) == 40  # the ids of the last hour
    site.send(*[reading(900 + n, minute=600) for n in range(3)])
    site.send(reading(990, minute=601))
    run(app, "processed")
    assert state_keys(spark, app, "processed", 0) == 4
    assert app.processed().count() == 164


def test_chained_windows_keep_no_ids(site):
    lines = [reading(n, temperature=n % 40, minute=n // 4, source=f"s{n % 3}") for n in range(120)]
    for start in range(0, 120, 40):
        site.send(*lines[start : start + 40], *lines[start : start + 10])
    app = site.app()
    first = app.start_processed()
    first.awaitTermination()
    second = app.start_aggregates(chained=True)
    second.awaitTermination()
    names = lambda query: [s["operatorName"] for s in query.lastProgress["stateOperators"]]
    assert [name.startswith("dedupe") for name in names(first)] == [True, True]
    assert [name.startswith("dedupe") for name in names(second)] == [False]
    chained = rows(app.aggregates.latest(), *WINDOW)
    app.root += "/alone"
    app.aggregates = KeyedTable(app.spark, f"{app.root}/aggregates", AGGREGATES)
    run(app, "aggregates")
    assert chained == rows(app.aggregates.latest(), *WINDOW)
    site.send(reading(500, minute=200), reading(3, minute=0))
    app.root = app.root.removesuffix("/alone")
    app.aggregates = KeyedTable(app.spark, f"{app.root}/aggregates", AGGREGATES)
    run(app, "processed")
    app.start_aggregates(chained=True).awaitTermination()
    assert sum(r.record_count for r in app.aggregates.latest().collect()) == 121


def test_an_hour_gets_few_files(site, spark, tmp_path):
    """The lake's files grow with its hours, not with hours times tasks."""
    site.send(*[reading(n, minute=n % 120) for n in range(600)])
    app = site.app()
    run(app, "processed")
    files = [file.parent for file in (tmp_path / "tables" / "processed").rglob("*.parquet")]
    assert len(set(files)) == 2 and max(map(files.count, files)) <= 4
    assert app.processed().count() == 600
