import random
from datetime import datetime, timedelta

import pytest

from gaugeline import schema
from gaugeline.operators.checks import keep_recent
from gaugeline.operators.upsert import merge_batches, merge_into_base
from gaugeline.sources.keyed import AGGREGATES, RECORDS, KeyedTable
from pyspark.sql import functions as F

START = datetime(2026, 8, 9, 12)


@pytest.fixture
def rows(spark):
    def make(*values):
        """Records from ``(key, temperature)`` pairs; the batch shows in every column."""
        full = [
            (key, f"source-{t}", START + timedelta(hours=t), t, START, float(t), 50.0, float(t), "{}", START)
            for key, t in values
        ]
        return spark.createDataFrame(full, schema.RECORDS)

    return make


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "records"), RECORDS)


def state(table):
    return {r.event_id: (r.source, r.temperature, r.temperature_f) for r in table.latest().collect()}


def test_conflicts_change_only_mutable_columns(table, rows):
    table.upsert(rows(("a", 1), ("b", 2)), 0)
    table.upsert(rows(("b", 3), ("c", 4)), 1)
    table.upsert(rows(("b", 5)), 2)
    assert state(table) == {
        "a": ("source-1", 1.0, 1.0),
        "b": ("source-2", 5.0, 2.0),
        "c": ("source-4", 4.0, 4.0),
    }


def test_first_copy_in_a_batch_wins(table, rows):
    table.upsert(rows(("a", 7), ("a", 3), ("a", 9)), 0)
    assert state(table) == {"a": ("source-3", 3.0, 3.0)}


def test_replayed_batch_replaces_itself(table, rows):
    table.upsert(rows(("a", 1), ("b", 2)), 0)
    table.upsert(rows(("b", 3)), 1)
    before = state(table)
    table.upsert(rows(("b", 3)), 1)
    assert state(table) == before


def test_empty_table(table):
    assert state(table) == {}


def test_compaction_keeps_the_view(table, rows):
    for batch in range(4):
        table.upsert(rows(("a", batch), (f"k{batch}", batch)), batch)
    before = state(table)
    table.compact(1)
    assert state(table) == before
    table.compact(3)
    assert state(table) == before
    table.upsert(rows(("a", 9), ("new", 9)), 4)
    assert state(table) == before | {"a": ("source-0", 9.0, 0.0), "new": ("source-9", 9.0, 9.0)}
    with pytest.raises(ValueError):
        table.compact(0)


def test_interrupted_compaction_leaves_the_old_base(table, rows, spark):
    table.upsert(rows(("a", 1)), 0)
    table.compact(0)
    rows(("junk", 5)).write.parquet(f"{table.path}/base/version=2")  # written, never named
    assert state(table) == {"a": ("source-1", 1.0, 1.0)}
    table.compact(0)
    assert state(table) == {"a": ("source-1", 1.0, 1.0)}


def test_purge_on_compaction(table, rows):
    old = rows(("old", 1)).withColumn("event_timestamp", F.lit("2026-08-01").cast("timestamp"))
    undated = rows(("undated", 1)).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    table.upsert(old.unionByName(undated).unionByName(rows(("new", 1))), 0)
    table.compact(0, keep=keep_recent(F.lit("2026-08-09 13:00:00").cast("timestamp")))
    assert set(state(table)) == {"new", "undated"}


def test_null_values_overwrite(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "windows"), AGGREGATES)
    end = START + timedelta(minutes=5)
    for batch, value in enumerate([1.5, None]):
        table.upsert(spark.createDataFrame([("s", START, end, value, 2.0, 1)], schema.AGGREGATES), batch)
    row = table.latest().first()
    assert (row.avg_temperature, row.avg_humidity, row.window_end) == (None, 2.0, end)


def test_hot_key_is_folded_before_the_shuffle(spark):
    log = spark.range(0, 10_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("first"),
        F.col("id").alias("last"),
        F.col("id").alias("batch_id"),
    )
    merged = merge_batches(log, ["k"], ["first"], ["last"])
    hot = merged.filter("k = 'hot'").first()
    assert (hot["first"], hot["last"]) == (1, 9998)
    assert "partial_max_by" in merged._jdf.queryExecution().executedPlan().toString()


def test_base_is_not_shuffled(spark, tmp_path):
    """A large base meets a small stored delta through broadcast joins."""
    base = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("k"), F.lit(0).alias("first"), F.lit(0).alias("last")
    )
    changes = [("7", 1, 1, 1), ("7", 2, 2, 2), ("new", 1, 1, 1)]
    delta = spark.createDataFrame(changes, "k STRING, first INT, last INT, batch_id INT")
    delta.write.parquet(str(tmp_path / "delta"))
    delta = spark.read.parquet(str(tmp_path / "delta"))
    merged = merge_into_base(base, delta, ["k"], ["first"], ["last"])
    changed = merged.filter("last > 0 OR first > 0").orderBy("k").collect()
    assert [tuple(row) for row in changed] == [("7", 0, 2), ("new", 1, 1)]
    assert merged.count() == 200_001
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1mb")  # less than the base
    try:
        merged = merge_into_base(base, delta, ["k"], ["first"], ["last"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Range (0, 200000") == 2
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert sorted("LeftOuter" in line for line in joins if "LeftAnti" not in line) == [False, True]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_merge_reads_base_and_delta_once_and_shuffles_the_delta_alone(table, rows, spark):
    table.upsert(rows(*((f"k{n}", n % 20) for n in range(200))), 0)
    table.compact()
    table.upsert(rows(("k1", 3), ("new", 4)), 1)
    names = {entry.name for entry in spark.catalog.listTables()}
    merged = table.latest()
    assert {entry.name for entry in spark.catalog.listTables()} == names
    plan = plan_of(merged)
    assert plan.count("FileScan") == 2 and plan.count("Join") == 1
    base = next(line for line in plan.splitlines() if "Bucketed: true" in line)
    before = plan.splitlines()[: plan.splitlines().index(base)]
    assert not any("Exchange" in line for line in before)
    assert merged.count() == 201


def test_compaction_leaves_the_base_in_its_buckets(table, rows, tmp_path):
    table.upsert(rows(*((f"k{n}", n % 20) for n in range(300))), 0)
    table.compact()
    table.upsert(rows(("k1", 3), ("new", 4)), 1)
    table.compact()
    files = [len(list((tmp_path / "records" / "base" / f"version={v}").glob("part-*.parquet"))) for v in (1, 2)]
    assert files == [8, 8]
    table.upsert(rows(("k2", 9)), 2)
    assert "Bucketed: true" in plan_of(table.latest())
    assert state(table) == {f"k{n}": (f"source-{n % 20}", float(n % 20), float(n % 20)) for n in range(300)} | {
        "k1": ("source-1", 3.0, 1.0), "k2": ("source-2", 9.0, 2.0), "new": ("source-4", 4.0, 4.0)
    }


def test_buckets_grow_with_the_table(table, rows, monkeypatch):
    table.upsert(rows(("a", 1), ("b", 2)), 0)
    table.compact()
    monkeypatch.setattr("gaugeline.sources.keyed.BUCKET_BYTES", 1000)
    table.upsert(rows(("b", 3), ("c", 4)), 1)
    before = state(table)
    table.compact()
    assert table._current().buckets > 8 and state(table) == before
    table.upsert(rows(("a", 5)), 2)
    assert state(table) == before | {"a": ("source-1", 5.0, 1.0)}


def test_frames_opened_before_a_compaction_stay_readable(table, rows):
    table.upsert(rows(("a", 1)), 0)
    table.compact()
    table.upsert(rows(("a", 2), ("b", 2)), 1)
    opened = table.latest()
    table.compact(keep=F.col("event_id") == "b")
    assert sorted(r.event_id for r in opened.collect()) == ["a", "b"]
    assert set(state(table)) == {"b"}
    again = table.latest()
    table.upsert(rows(("c", 1)), 2)
    table.compact()
    assert [r.event_id for r in again.collect()] == ["b"]
    table.vacuum(1)
    assert table.last_batch() == -1 and set(state(table)) == {"b", "c"}


def test_random_histories_equal_plain_upserts(spark, tmp_path, rows):
    chance = random.Random(4)
    for trial in range(3):
        table, want = KeyedTable(spark, str(tmp_path / f"t{trial}"), RECORDS), {}
        for batch in range(5):
            values = {f"k{chance.randrange(12)}": chance.randrange(20) for _ in range(6)}
            table.upsert(rows(*values.items()), batch)
            for key, t in values.items():
                first = want.get(key, (f"source-{t}", None, float(t)))
                want[key] = (first[0], float(t), first[2])
            if chance.random() < 0.5:
                table.compact()
        assert state(table) == want


def test_rows_that_break_a_constraint_are_kept_apart_with_their_rules(table, rows, spark):
    bad = rows(("hot", 500), ("cold", -51), ("cold", -51))
    unnamed = rows(("x", 1), ("y", 2)).withColumn("event_id", F.lit(None).cast("string"))
    edge = rows(("high", 100), ("low", -50)).withColumn("humidity", F.lit(None).cast("double"))
    wet = rows(("wet", 200)).withColumn("humidity", F.lit(101.0)).withColumn("source", F.lit(None).cast("string"))
    for batch, part in enumerate([bad, unnamed, edge, wet]):
        table.upsert(part.unionByName(rows((f"good{batch}", batch))), batch)
    kept = {f"good{n}" for n in range(4)} | {"high", "low"}
    want = [
        ("cold", "range_temperature"), ("hot", "range_temperature"),
        ("wet", "not_null_source,range_temperature,range_humidity"), (None, "not_null_event_id"), (None, "not_null_event_id"),
    ]
    told = lambda: sorted(((r.event_id, r.broken_rules) for r in table.rejects().collect()), key=repr)
    assert set(state(table)) == kept and told() == sorted(want, key=repr)
    table.compact(1)
    assert set(state(table)) == kept and told() == sorted(want, key=repr)
    for _ in range(3):
        table.compact()
    assert table.last_batch() == -1 and set(state(table)) == kept and told() == sorted(want, key=repr)


def test_a_broken_copy_does_not_hide_a_good_one(table, rows):
    table.upsert(rows(("a", 200), ("a", 7)), 0)
    assert state(table) == {"a": ("source-7", 7.0, 7.0)}
    assert [r.temperature for r in table.rejects().collect()] == [200.0]
