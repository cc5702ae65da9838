import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from gaugeline.session import build_session  # noqa: E402

ID = "0000000{}-0000-4000-8000-000000000000"
INGESTED = "2026-08-09T17:00:00Z"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "gaugeline-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    """A DataFrame of one text column from a list of strings."""

    def make(values, column="raw_value"):
        return spark.createDataFrame([(value,) for value in values], f"{column} STRING")

    return make


def envelope(event_id=ID.format(1), source="m", ingested_at=INGESTED, payload="{}"):
    """An envelope as JSON text; None leaves a field out, an object payload stays an object."""
    fields = dict(event_id=event_id, source=source, ingested_at=ingested_at, payload=payload)
    return json.dumps({name: value for name, value in fields.items() if value is not None})


def reading(number, temperature=20.0, humidity=50, minute=0, source="m", **more):
    """A complete valid envelope with an event time ``minute`` minutes after noon."""
    moment = f"2026-08-09T{12 + minute // 60:02d}:{minute % 60:02d}:00Z"
    payload = dict(id=number, timestamp=moment, temperature=temperature, humidity=humidity, **more)
    event_id = f"00000000-0000-4000-8000-{number:012d}"
    return envelope(event_id, source, moment, json.dumps(payload))
