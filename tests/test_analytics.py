import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.operators import analytics, checks, pages, summaries
from gaugeline.operators.ranking import first_per_key, latest_per_key, top_per_key

START = datetime(2026, 8, 9, 12)


def at(text):
    return F.lit(f"2026-08-09 {text}").cast("timestamp")


@pytest.fixture(scope="module")
def metrics_of(spark):
    def make(series):
        rows = [(name, True, [float(v) for v in values]) for name, values in series.items()]
        return spark.createDataFrame(rows, "source STRING, is_metric BOOLEAN, values ARRAY<DOUBLE>")

    return make


@pytest.fixture(scope="module")
def records(spark):
    """Two sources of 700 and 3 records, one of them with a changing payload."""
    draw = random.Random(1)
    rows = []
    for n in range(700):
        payload = f'{{"Load":{draw.randint(0, 9)},"deviceId":{n},"on":true,"note":"5"}}'
        rows.append(("big", n, payload))
    rows += [("small", 1, '{"x":1}'), ("small", 2, '{"x":true,"y":2}'), ("small", 3, '{"x":4.0,"z":"t"}')]
    rows = [
        (f"{source}-{n:04d}", source, START + timedelta(seconds=n), payload, START + timedelta(seconds=2 * n))
        for source, n, payload in rows
    ]
    layout = "event_id STRING, source STRING, event_timestamp TIMESTAMP, payload STRING, processed_at TIMESTAMP"
    return spark.createDataFrame(rows, layout).repartition(8).cache()


@pytest.fixture(scope="module")
def recent(records):
    return analytics.recent_slice(records).cache()


def fence_count(values):
    if len(values) < 4:
        return 0
    ordered = sorted(values)
    low, high = ordered[len(values) // 4], ordered[3 * len(values) // 4]
    margin = 1.5 * (high - low)
    return sum(not low - margin <= v <= high + margin for v in values)


def half_change(values):
    if len(values) < 4:
        return None
    middle = len(values) // 2
    before, after = statistics.fmean(values[:middle]), statistics.fmean(values[middle:])
    return None if before == 0 else (after - before) / before * 100


def test_random_series(metrics_of):
    draw = random.Random(2)
    series = {}
    for n in range(120):
        spread = draw.choice([1, 5, 100])
        series[f"s{n}"] = [round(draw.gauss(draw.choice([0, 5]), spread), 1) for _ in range(draw.randint(0, 40))]
    series["zeros"] = [0, 0, 1, 2]
    rows = analytics.iqr_anomalies(metrics_of(series)).withColumn(
        "change", analytics.half_change(F.col("values"))
    )
    for row in rows.collect():
        values = series[row.source]
        assert row.anomalies == fence_count(values)
        change = half_change(values)
        assert (row.change is None) == (change is None)
        assert change is None or row.change == pytest.approx(change)


@pytest.mark.parametrize(
    "change, direction",
    [(1.01, "Increasing"), (1.0, "Stable"), (-1.0, "Stable"), (-1.5, "Decreasing"), (None, "Stable")],
)
def test_trend_direction(spark, change, direction):
    row = spark.range(1).select(analytics.trend_direction(F.lit(change).cast("double")).alias("d")).first()
    assert row.d == direction


def test_recent_slice(recent):
    rows = {(r.source, r.seq): r for r in recent.collect()}
    assert len(rows) == 503
    assert rows["big", 1].event_id == "big-0200" and rows["big", 500].event_id == "big-0699"
    assert rows["big", 500].rank == 1
    assert [rows["small", n].event_id for n in (1, 2, 3)] == ["small-0001", "small-0002", "small-0003"]


def test_field_roles(recent):
    roles = {(r.source, r.field): r.role for r in analytics.classify_fields(recent).collect()}
    assert roles == {
        ("big", "Load"): "metric",
        ("big", "deviceId"): "identifier",
        ("big", "on"): "dimension",
        ("big", "note"): "dimension",
        ("small", "x"): "metric",
        ("small", "z"): "dimension",
    }
    exact = analytics.classify_fields(recent, exact_id=True).filter("field = 'deviceId'").first()
    assert exact.role == "metric"


def test_metric_summary(recent):
    rows = {(r.source, r.field): r for r in analytics.metric_summary(recent).collect()}
    assert set(rows) == {("big", "Load"), ("small", "x")}
    x = rows["small", "x"]
    assert (x.avg_value, x.min_value, x.max_value) == (2.0, 1.0, 4.0)  # true counts as 1
    assert (x.direction, x.percentage, x.anomalies) == ("Stable", 0.0, 0)


def test_insights(spark, recent):
    quiet = spark.createDataFrame(
        [("quiet-1", "quiet", START, "{}", START)], recent.select(*recent.columns[:5]).schema
    )
    rows = analytics.insights(recent.unionByName(analytics.recent_slice(quiet)))
    told = {}
    for row in rows.orderBy("source", "position").collect():
        told.setdefault(row.source, []).append(row.insight)
    assert told["quiet"] == [analytics.NO_TREND]
    assert told["small"] == ["X remained relatively stable."]
    assert told["big"][0].startswith("Load ")


def test_insight_wording(spark):
    rows = [
        ("s", "heatIndex", True, [1.0] * 7 + [9.0]),
        ("s", "cold", True, [4.0, 4.0, 2.0, 2.0]),
        ("s", "note", False, []),
        ("t", None, False, []),
    ]
    values = spark.createDataFrame(rows, "source STRING, field STRING, is_metric BOOLEAN, values ARRAY<DOUBLE>")
    lines = analytics.write_insights(analytics.summarize_metrics(values))
    assert [tuple(row) for row in lines.orderBy("source", "position").collect()] == [
        ("s", 0, "Cold decreased 50.0% compared with the previous period."),
        ("s", 1, "Heatindex increased 200.0% compared with the previous period."),
        ("s", 2, "⚠ 1 potential anomalies detected in heatIndex."),
        ("t", 0, "Not enough data to determine a trend."),
    ]


def test_top_per_key_spreads_a_hot_key(spark):
    rows = spark.range(0, 50_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("source"),
        F.col("id").alias("n"),
    )
    top = top_per_key(rows, ["source"], [F.col("n").desc()], 3, spread=4)
    hot = top.filter("source = 'hot'").orderBy("rank").collect()
    assert [r.n for r in hot] == [49_999, 49_997, 49_996]
    assert top.count() == 3 + rows.filter("source <> 'hot'").count()
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # rows are dropped before each shuffle


def test_first_and_latest_fold_copies_before_the_shuffle(spark):
    rows = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
        F.col("id").cast("string").alias("t"),
    )
    first, latest = first_per_key(rows, ["k"], ["n"]), latest_per_key(rows, ["k"], ["n"])
    assert first.filter("k = 'hot'").first().t == "0"
    assert latest.filter("k = 'hot'").first().t == "899"
    assert first.count() == latest.count() == 101
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


METRICS = "source STRING, run_timestamp TIMESTAMP, total_records BIGINT, valid_records BIGINT, " + (
    "invalid_records BIGINT, duplicate_records BIGINT, null_violations BIGINT, range_violations BIGINT, "
    "freshness_violations BIGINT, quality_rate DOUBLE"
)


@pytest.fixture(scope="module")
def metrics(spark):
    rows = [
        ("big", START, 10, 5, 5, 0, 1, 1, 0, 50.0),
        ("big", START + timedelta(minutes=5), 10, 6, 4, 0, 3, 2, 0, 60.0),
        ("bad", START, 2, 0, 2, 0, 0, 1, 0, 0.0),
    ]
    return spark.createDataFrame(rows, METRICS)


@pytest.fixture(scope="module")
def registry(spark):
    rows = [(1, "big", 5, "active"), (2, "silent", None, "paused"), (3, "small", 90, "active")]
    return spark.createDataFrame(rows, "id INT, name STRING, poll_interval INT, status STRING")


def test_source_quality(records, metrics, registry):
    cards = {r.source: r for r in summaries.source_quality(records, metrics).collect()}
    big, bad, small = cards["big"], cards["bad"], cards["small"]
    assert (big.total_records, big.invalid_records, big.format_violations) == (704, 4, 0)
    assert big.quality_rate == round(700 / 704 * 100, 2)
    assert (bad.total_records, bad.valid_records, bad.format_violations, bad.quality_rate) == (2, 0, 1, 0.0)
    assert (small.total_records, small.invalid_records, small.quality_rate) == (3, 0, 100.0)
    listed = {r.source: r for r in summaries.source_quality(records, metrics, registry).collect()}
    assert set(listed) == {"big", "silent", "small"}
    assert (listed["silent"].total_records, listed["silent"].quality_rate) == (0, None)


def test_overview_and_breakdown(records, metrics, registry):
    quality = summaries.source_quality(records, metrics)
    row = summaries.overview_kpis(quality, registry).first()
    assert (row.active_sources, row.configured_sources, row.total_records) == (2, 3, 707)
    assert row.avg_quality_rate == pytest.approx((99.43 + 100) / 2)
    shares = {(r.source, r.violation): r.share for r in summaries.violation_breakdown(quality).collect()}
    assert (shares["bad", "range"], shares["bad", "format"], shares["small", "null"]) == (50.0, 50.0, 0.0)


def test_source_kpis(records, metrics, recent, registry):
    cards = summaries.source_kpis(records, metrics, recent, at("13:00:00"), registry).collect()
    cards = {r.source: r for r in cards}
    big = cards["big"]
    assert (big.total_records, big.quality_rate, big.ingestion_rate) == (700, 60.0, round(500 / 998, 2))
    assert big.freshness_seconds == 3600 - 1398
    silent = cards["silent"]
    assert (silent.total_records, silent.quality_rate, silent.ingestion_rate) == (0, 100.0, 0.0)
    assert silent.freshness_seconds is None


def test_checks(spark, records, metrics):
    late = checks.check_freshness(records, at("13:00:00")).first()
    assert late.passed is False
    fresh = checks.check_freshness(records, at("12:30:00"))
    assert fresh.first().passed is True
    none = records.limit(0)
    assert checks.check_freshness(none, at("13:00:00")).first().passed is True
    assert checks.check_freshness(none, at("13:00:00"), fail_on_empty=True).first().passed is False
    rates = {r.source: r.passed for r in checks.check_quality_rate(metrics, threshold=50).collect()}
    assert rates == {"big": True, "bad": False}
    assert checks.check_quality_rate(metrics, source="none").first().passed is True
    none = checks.check_quality_rate(metrics.limit(0), fail_on_empty=True).collect()
    assert [(r.source, r.passed) for r in none] == [(None, False)]
    checks.require_passed(fresh)
    with pytest.raises(RuntimeError):
        checks.require_passed(checks.check_freshness(records, at("13:00:00")))


def test_retention_keeps_rows_without_time(spark):
    rows = spark.createDataFrame(
        [("old", datetime(2026, 8, 1)), ("new", START), ("none", None)], "k STRING, event_timestamp TIMESTAMP"
    )
    assert {r.k for r in checks.retain_recent(rows, at("13:00:00")).collect()} == {"new", "none"}


def test_freshness_labels(spark):
    rows = spark.createDataFrame([(0, None), (1, 59.0), (2, 60.0), (3, 3599.0), (4, 7300.0)], "n INT, s DOUBLE")
    labels = rows.orderBy("n").select(checks.freshness_label(F.col("s")).alias("l")).collect()
    assert [r.l for r in labels] == ["—", "Live", "1m ago", "59m ago", "2h ago"]


def test_pages(spark, records):
    full = records.select("*", *[F.lit(None).alias(c) for c in pages.RECORD_COLUMNS if c not in records.columns])
    one = pages.records_page(full, "big", limit=2, offset=1).collect()
    assert [r.event_id for r in one] == ["big-0698", "big-0697"]
    every = pages.records_page(full, limit=2, offset=1).orderBy("source", F.desc("event_id")).collect()
    assert [r.event_id for r in every] == ["big-0698", "big-0697", "small-0002", "small-0001"]
    undated = full.withColumn(
        "event_timestamp", F.when(F.col("event_id") != "small-0001", F.col("event_timestamp"))
    )
    assert pages.records_page(undated, "small", limit=1).first().event_id == "small-0001"
    for wrong in [dict(limit=0), dict(limit=1001), dict(offset=-1)]:
        with pytest.raises(ValueError):
            pages.records_page(full, **wrong)


def test_aggregates_page_shows_zero_as_null(spark):
    rows = spark.createDataFrame([("s", START, START, 0.0, 2.345, 1)], schema.AGGREGATES)
    row = pages.aggregates_page(rows, "s").first()
    assert (row.avg_temperature, row.avg_humidity) == (None, 2.35)


def test_page_of_one_source_is_a_top_n(records):
    full = records.select("*", *[F.lit(None).alias(c) for c in pages.RECORD_COLUMNS if c not in records.columns])
    plan = pages.records_page(full, "big")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
