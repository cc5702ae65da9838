import json
import random

import pytest
from conftest import ID, INGESTED, envelope
from pyspark.sql import functions as F

from gaugeline.functions.documents import is_whole_json
from gaugeline.functions.numbers import to_bigint
from gaugeline.operators.parse import parse_envelopes, parse_payload, raw_lake_rows, serving_records, typed_events
from gaugeline.operators.quality import constraint_report, flag_quality, quarantine_rows, valid_rows
from gaugeline.operators.windows import quality_windows

T, N, X = True, None, False

# raw text, null flag, format flag, JSON flag, range flag, validity, destination
EDGE_ROWS = [
    (envelope(payload='{"id":1,"temperature":20,"humidity":50}'), X, X, T, X, T, "valid"),
    (envelope(payload={"temperature": 25.0, "humidity": 150}), X, X, T, T, X, "quarantine"),
    (envelope(payload='{"temperature":"very hot","humidity":50}'), X, X, T, N, N, "neither"),
    (envelope(payload='{"temperature":"very hot","humidity":150}'), X, X, T, T, X, "quarantine"),
    ('{"event_id":', T, N, X, X, X, "quarantine"),
    ("hello", T, N, X, X, X, "quarantine"),
    ("", T, N, X, X, X, "quarantine"),
    (envelope(event_id=None), T, N, T, X, X, "quarantine"),
    (envelope(event_id="123", ingested_at="2026", payload={"latitude": 12.97}), X, T, T, X, X, "quarantine"),
    (envelope(payload="{bad"), X, X, X, X, X, "quarantine"),
    (envelope(payload=None), X, X, X, X, X, "quarantine"),
    (envelope(ingested_at="nope"), X, X, T, X, T, "quarantine"),
    (envelope(payload='{"temperature":null}'), X, X, T, X, T, "valid"),
]


def flagged(log, **options):
    return flag_quality(parse_payload(parse_envelopes(log)), **options)


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(number, row[0]) for number, row in enumerate(EDGE_ROWS)]
    return flagged(spark.createDataFrame(rows, "number INT, raw_value STRING")).cache()


def test_flags_of_edge_rows(edges):
    names = ["is_null_violation", "is_format_violation", "is_json_valid", "is_range_violation", "is_valid"]
    got = [tuple(row) for row in edges.orderBy("number").select(*names).collect()]
    assert got == [row[1:6] for row in EDGE_ROWS]


def test_routing_of_edge_rows(edges):
    valid = {row.number for row in valid_rows(edges).select("number").collect()}
    texts = sorted(row.raw_value for row in quarantine_rows(edges).collect())
    assert valid == {n for n, row in enumerate(EDGE_ROWS) if row[6] == "valid"}
    assert texts == sorted(row[0] for row in EDGE_ROWS if row[6] == "quarantine")


def test_quarantine_reasons(edges):
    reasons = {row.raw_value: row.reason for row in quarantine_rows(edges, with_reason=True).collect()}
    assert reasons["hello"] == "null,json"
    assert reasons[envelope(ingested_at="nope")] == "ingest_time"
    assert reasons[EDGE_ROWS[1][0]] == "range"


def test_metrics_of_edge_rows(edges):
    rows = {
        (row.source, str(row.run_timestamp)): (row.total_records, row.valid_records, row.invalid_records)
        for row in quality_windows(edges).collect()
    }
    assert rows == {
        ("m", "2026-08-09 17:00:00"): (8, 2, 5),
        ("m", "2026-01-01 00:00:00"): (1, 0, 1),
    }


def test_metrics_name_unknown_sources(texts):
    rows = quality_windows(flagged(texts([envelope(source=None)]))).collect()
    assert [(row.source, row.null_violations) for row in rows] == [("__unknown__", 1)]


def test_strict_options(texts):
    log = texts([EDGE_ROWS[2][0], envelope(payload='{"a":1} junk')])
    assert [row.is_valid for row in flagged(log).collect()] == [None, True]
    strict = flagged(log, strict_types=True, strict_json=True)
    assert [row.is_valid for row in strict.collect()] == [False, False]
    assert [row.reason for row in quarantine_rows(strict, with_reason=True).collect()] == ["type", "json"]


def test_whole_json(texts):
    whole = ["1", ' {"a":[1,2]} ', '"x"', "[]", "null"]
    cut = ["", "1,2", "1] ,[2", '1} {"b":2', '{"a":1} junk', "{bad", "1]", "1}", '1,"b":2']
    rows = texts(whole + cut, "t").select("t", is_whole_json(F.col("t")).alias("ok")).collect()
    assert {row.t for row in rows if row.ok} == set(whole)


PAYLOADS = [
    "", "  ", "7", "null", "true", '"text"', "[1,2", "7 8", '{"a":1}{', "{'temperature':3}",
    '[{"temperature":5}]', '{"temperature":NaN}', '{"temperature":"NaN"}', '{"temperature":{"a": 1}}',
    '{"temperature":true}', '{"temperature":5,}', '{"a":"x\ty","temperature":4}', '{"Temperature":4}',
    '{"temperature":"  7 "}', '{"temperature":1.0E2,"humidity":-0.0}', '{"temperature":"1d"}',
    '{"temperature":20,"humidity":', '{"temperature":12345678901234567890.5}', '{"id":1e3}',
    '{"temperature":1,"temperature":2}', '{"humidity":null,"x":[],"humidity":7}', '{"id":"id","x":"id"}',
    '{"time":"2026-01-01","timestamp":null}', '{"temperature":"inf"}', '{"x":{"temperature":9}}',
]


def test_one_pass_parse_equals_path_extraction(texts):
    """The single parse must see what separate JSON path lookups see."""
    log = texts([envelope(payload=payload) for payload in PAYLOADS])
    rows = flagged(log)
    for name in ["id", "timestamp", "time", "temperature", "humidity"]:
        path = F.get_json_object("payload", f"$.{name}")
        assert rows.filter(~path.eqNullSafe(F.col(f"payload_{name}"))).count() == 0, name
    whole = F.get_json_object("payload", "$").isNotNull()
    wrong = rows.filter(whole != F.col("is_json_valid")).select("payload").collect()
    assert wrong == []


def test_random_payloads_parse_alike(texts):
    draw = random.Random(5)
    scalars = [1, -2.5, "x", "7", True, None, {"a": 1}, [1, 2], "2026-01-01T00:00:00Z", 1e300]
    names = ["id", "timestamp", "time", "temperature", "humidity", "other"]
    payloads = []
    for _ in range(300):
        text = json.dumps({name: draw.choice(scalars) for name in draw.sample(names, draw.randint(0, 6))})
        payloads.append(text[: draw.randint(0, len(text))] if draw.random() < 0.3 else text)
    test_one_pass_parse_equals_path_extraction(lambda _: texts([envelope(payload=p) for p in payloads]))


def test_to_bigint_follows_the_lenient_cast(spark, texts):
    values = ["1", "1.5", " 12 ", "12.", ".5", "-", ".", "+7", "-7.9", "- 7", "", "1e3", "0x10", "x"]
    values += ["9223372036854775807", "9223372036854775808", "9223372036854775808.1", "-.5", "1.2.3"]
    rows = texts(values, "t").select("t", to_bigint(F.col("t")).alias("ours"))
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    ours = {row.t: row.ours for row in rows.collect()}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        lenient = texts(values, "t").select("t", F.col("t").cast("bigint").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert ours == {row.t: row.n for row in lenient}


def test_typed_events(texts):
    payload = '{"id":"1.9","time":"2026-08-09T10:00:00Z","temperature":"20","humidity":null}'
    late = envelope(event_id=ID.format(2), payload='{"timestamp":"bad","temperature":-40}')
    rows = typed_events(valid_rows(flagged(texts([envelope(payload=payload), late]))))
    first, second = serving_records(rows).orderBy("event_id").collect()
    assert (first.record_id, str(first.event_timestamp), first.temperature_f) == (1, "2026-08-09 10:00:00", 68.0)
    assert first.humidity is None and first.payload == payload
    assert (str(second.event_timestamp), second.temperature_f) == ("2026-08-09 17:00:00", -40.0)
    assert second.processed_at is not None


def test_raw_lake_keeps_every_row(texts):
    rows = raw_lake_rows(parse_envelopes(texts(["hello", envelope()]))).collect()
    assert sorted((r.source or "", r.raw_value, r.year, r.month, r.day, r.hour) for r in rows) == [
        ("", "hello", None, None, None, None),
        ("m", envelope(), 2026, 8, 9, 17),
    ]


def test_json_is_parsed_once_per_row(texts):
    rows = serving_records(typed_events(valid_rows(flagged(texts([envelope()])))))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # envelope and payload


def test_constraint_report(spark):
    rows = spark.createDataFrame(
        [("a", "s", 20.0), ("a", "s", 200.0), ("a", None, None), (None, "s", float("nan")), (None, "s", 1.0)],
        "event_id STRING, source STRING, temperature DOUBLE",
    )
    report = constraint_report(rows, ["event_id"], ["event_id", "source"], {"temperature": (-50.0, 100.0)})
    assert {row.rule: row.violations for row in report.collect()} == {
        "range_temperature": 2,
        "not_null_event_id": 2,
        "not_null_source": 1,
        "unique_event_id": 2,
    }


def test_object_payload_is_kept_as_text(texts):
    raw = '{"event_id": "123", "source": "Meteo", "ingested_at": "2026", "payload": {"latitude": 12.97}}'
    row = parse_envelopes(texts([raw])).first()
    assert (row.event_id, row.source, row.ingested_at) == ("123", "Meteo", "2026")
    assert json.loads(row.payload) == {"latitude": 12.97}
    assert INGESTED not in raw
