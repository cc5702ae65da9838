import json
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.analytics import infer_schema
from gaugeline.operators.normalize import build_envelopes, normalize_payload, rejected_documents
from gaugeline.sources.readers import landed_documents

CASES = [
    ('[{"x":1},3,{"y":[1]}]', [{"x": 1}, {"y": [1]}]),
    (
        '{"time":["a","b"],"t":[1.5,2],"s":"k","n":null,"o":{"q":1}}',
        [{"time": "a", "t": 1.5, "s": "k", "n": None}, {"time": "b", "t": 2, "s": "k", "n": None}],
    ),
    (
        '{"lat":12,"meta":{"a":[1]," b":[1,2]},"z":{"time":["a","b"]},"hourly":{"time":["a"]}}',
        [{"lat": 12, "time": "a"}, {"lat": 12, "time": "b"}],
    ),
    ('{"a":[1,2],"b":[1]}', [{"a": [1, 2], "b": [1]}]),
    ('{"a":[],"b":1}', [{"a": [], "b": 1}]),
    ('{"a":1,"o":{"p":2}}', [{"a": 1, "o": {"p": 2}}]),
    ('{"x":1,"o":{"x":[7,8],"y":3}}', [{"x": 7}, {"x": 8}]),
    ('{"a":[null,1]}', [{"a": None}, {"a": 1}]),
    ("{}", [{}]),
    ("[]", []),
    ("7", []),
    ("bad", []),
    ("null", []),
    ("", []),
]


def normalized(texts, documents):
    rows = normalize_payload(texts(documents, "document")).collect()
    found = {document: [] for document in documents}
    for row in sorted(rows, key=lambda row: row.position):
        found[row.document].append(json.loads(row.record))
    return found


def test_documented_cases(texts):
    assert normalized(texts, [document for document, _ in CASES]) == dict(CASES)


def expected(value):
    """Plain restatement of the rules for the random test."""
    if isinstance(value, list):
        return [item for item in value if isinstance(item, dict)]
    if not isinstance(value, dict):
        return []
    shared = {k: v for k, v in value.items() if type(v) not in (dict, list)}
    for part in [value, *(v for v in value.values() if isinstance(v, dict))]:
        columns = {k: v for k, v in part.items() if isinstance(v, list)}
        sizes = {len(v) for v in columns.values()}
        if len(sizes) == 1 and sizes != {0}:
            return [shared | dict(zip(columns, cells)) for cells in zip(*columns.values())]
    return [value]


def test_random_documents(texts):
    draw = random.Random(3)

    def value(depth):
        choice = draw.random()
        if depth and choice < 0.35:
            return [value(depth - 1) for _ in range(draw.choice([0, 1, 2, 2, 2]))]
        if depth and choice < 0.6:
            return {draw.choice("zyxwvu"): value(depth - 1) for _ in range(draw.randint(0, 3))}
        return draw.choice([1, 2.5, "s", True, None, "é"])

    documents = list({json.dumps(value(3)) for _ in range(400)})
    assert normalized(texts, documents) == {text: expected(json.loads(text)) for text in documents}


def test_needs_no_shuffle(texts):
    plan = normalize_payload(texts(["{}"], "document"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_envelopes(spark):
    records = spark.createDataFrame([("test", '{"data": 1}')], "source STRING, record STRING")
    sent = build_envelopes(records, topic_prefix="x.raw").first()
    envelope = json.loads(sent.value)
    assert (sent.topic, sent.key) == ("x.raw.test", "test")
    assert envelope["source"] == "test" and json.loads(envelope["payload"]) == {"data": 1}
    assert len(envelope["event_id"]) == 36 and envelope["ingested_at"].endswith("Z")


def test_landed_documents(spark, tmp_path):
    folder = tmp_path / "source=meteo"
    folder.mkdir()
    (folder / "one.json").write_text('{"time":\n["a","b"],\n"t":[1,2]}')
    records = normalize_payload(landed_documents(spark, str(tmp_path)))
    assert [(row.source, json.loads(row.record)) for row in records.orderBy("position").collect()] == [
        ("meteo", {"time": "a", "t": 1}),
        ("meteo", {"time": "b", "t": 2}),
    ]


@pytest.mark.parametrize(
    "value, field_type",
    [
        (True, "boolean"),
        (3, "numeric"),
        (2.5, "numeric"),
        (10**25, "numeric"),
        ("plain", "string"),
        ("5", "string"),
        ("2026-01-01T00:00Z", "datetime"),
        ("TZ", "datetime"),
        ("10-11 12:13", "datetime"),
        ("10-11", "string"),
        (None, "string"),
        ([1], "string"),
        ({"a": 1}, "string"),
    ],
)
def test_infer_schema(texts, value, field_type):
    document = json.dumps({"f": value})
    for text in [document, f"[{document}, 5]"]:
        rows = infer_schema(texts([text], "document")).collect()
        assert [(row.field, row.field_type) for row in rows] == [("f", field_type)]


def test_infer_schema_of_other_values(texts):
    assert infer_schema(texts(["7", "bad", "[]", "[1]", '[[{"a":1}]]', "{}"], "document")).count() == 0


def test_generated_event_ids_differ(spark):
    records = spark.range(1000).select(F.lit("s").alias("source"), F.lit("{}").alias("record"))
    ids = build_envelopes(records).select(F.get_json_object("value", "$.event_id").alias("id"))
    assert ids.distinct().count() == 1000


def test_last_of_repeated_names_counts(texts):
    rows = normalize_payload(texts(['{"a":1,"a":2,"b":"x"}', '{"n":{"t":[1,2]},"n":{"t":[3,4]}}'], "document")).collect()
    assert [json.loads(row.record) for row in rows] == [{"a": 2, "b": "x"}, {"t": 3}, {"t": 4}]


def test_rejects_and_records_cover_all_documents(texts):
    documents = [None, " ", "{", "1", "[]", "[1]", '{"a":{"b":1,"b":2}}', '{"a":1}', '[{"a":1},2]', '{"a":[]}', "{}"]
    frame = texts(documents, "document")
    rejected = {row.document: row.reason for row in rejected_documents(frame).collect()}
    assert rejected == {
        None: "no text", " ": "no text", "{": "no JSON", "1": "no object", "[]": "no object", "[1]": "no object",
    }
    accepted = {row.document for row in normalize_payload(frame).collect()}
    assert accepted == set(documents) - rejected.keys()


def repeats(draw, depth):
    """A random JSON text in which every object may repeat its names, and every number may be none of JSON's."""
    choice = draw.random()
    if depth and choice < 0.35:
        return "[" + ",".join(repeats(draw, depth - 1) for _ in range(draw.choice([0, 1, 2, 2, 2]))) + "]"
    if depth and choice < 0.75:
        own = (f'"{draw.choice("zyx")}": {repeats(draw, depth - 1)}' for _ in range(draw.randint(0, 5)))
        return "{" + ", ".join(own) + "}"
    return draw.choice(["1", "2.5", '"s"', "true", "null", '"NaN \\" Infinity"', "NaN", "-Infinity", '"é"'])


def test_repeated_names_at_any_depth_equal_the_python_reader(texts):
    draw = random.Random(5)
    documents = list({repeats(draw, 4) for _ in range(500)})
    want = {text: expected(json.loads(text)) for text in documents}
    same = lambda found: {text: [json.dumps(r, sort_keys=True) for r in rows] for text, rows in found.items()}
    assert same(normalized(texts, documents)) == same(want)
    rejected = {row.document for row in rejected_documents(texts(documents, "document")).collect()}
    assert not rejected & {text for text, rows in want.items() if rows}


def test_fields_of_documents_with_repeats_below_the_top_level(texts):
    text = '{"temperature":1,"meta":{"a":1,"a":2},"limit":NaN,"name":"NaN","name":true}'
    rows = infer_schema(texts([text], "document")).collect()
    assert {row.field: row.field_type for row in rows} == {
        "temperature": "numeric", "meta": "string", "limit": "numeric", "name": "boolean"
    }


def test_a_long_text_is_read(texts):
    inner = "x" * 200_000 + "NaN" + '\\"' * 20_000
    document = '{"a":{"t":"' + inner + '","t":"' + inner + '"},"n":NaN}'
    (row,) = normalize_payload(texts([document], "document")).collect()
    assert json.dumps(json.loads(row.record)) == json.dumps(json.loads(document))
