"""Data-quality rules, routing and table constraints."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schema
from gaugeline.functions.documents import is_json, is_whole_json
from gaugeline.functions.numbers import to_double


def _outside(value: Column, bounds: tuple[float, float]) -> Column:
    return (value < bounds[0]) | (value > bounds[1])


def _outside_if_given(text: Column, bounds: tuple[float, float]) -> Column:
    return text.isNotNull() & _outside(to_double(text), bounds)


def _not_a_number(text: Column) -> Column:
    return text.isNotNull() & to_double(text).isNull()


def flag_quality(
    parsed: DataFrame, strict_types: bool = False, strict_json: bool = False
) -> DataFrame:
    """Add one flag column per rule and ``is_valid``.

    The flags follow SQL's three-valued logic: a numeric field holding text
    makes the range rule, and with it ``is_valid``, null unless another rule
    fails. ``strict_types`` turns such text into a violation of its own;
    ``strict_json`` refuses payloads with text after the JSON value.
    """
    temperature, humidity = F.col("payload_temperature"), F.col("payload_humidity")
    json_rule = is_json(F.col("payload"), F.col("payload_broken"))
    if strict_json:
        json_rule = json_rule & is_whole_json(F.col("payload"))
    range_rule = _outside_if_given(temperature, schema.TEMPERATURE_RANGE) | _outside_if_given(
        humidity, schema.HUMIDITY_RANGE
    )
    flags = {
        "is_null_violation": F.col("event_id").isNull()
        | F.col("source").isNull()
        | F.col("ingested_at").isNull(),
        "is_format_violation": ~F.col("event_id").rlike(schema.EVENT_ID_PATTERN),
        "is_json_valid": json_rule,
        "is_range_violation": range_rule,
    }
    if strict_types:
        flags["is_range_violation"] = F.coalesce(range_rule, F.lit(False))
        flags["is_type_violation"] = _not_a_number(temperature) | _not_a_number(humidity)
    flagged = parsed.withColumns(flags)
    valid = (
        ~F.col("is_null_violation")
        & F.col("is_json_valid")
        & ~F.col("is_range_violation")
        & ~F.col("is_format_violation")
    )
    if strict_types:
        valid = valid & ~F.col("is_type_violation")
    return flagged.withColumn("is_valid", valid)


def valid_rows(flagged: DataFrame) -> DataFrame:
    """Rows for the serving side; their ingest time must be readable."""
    return flagged.filter(F.col("is_valid") & F.col("ingested_ts").isNotNull())


def quarantine_rows(flagged: DataFrame, with_reason: bool = False) -> DataFrame:
    """Rows that broke a rule, plus valid rows whose ingest time is unreadable."""
    bad = flagged.filter(~F.col("is_valid") | (F.col("is_valid") & F.col("ingested_ts").isNull()))
    if not with_reason:
        return bad.select("source", "raw_value")
    rules = [
        ("null", F.col("is_null_violation")),
        ("format", F.col("is_format_violation")),
        ("json", ~F.col("is_json_valid")),
        ("range", F.col("is_range_violation")),
        ("ingest_time", F.col("ingested_at").isNotNull() & F.col("ingested_ts").isNull()),
    ]
    if "is_type_violation" in flagged.columns:
        rules.append(("type", F.col("is_type_violation")))
    reasons = F.concat_ws(",", *[F.when(broken, name) for name, broken in rules])
    return bad.select("source", "raw_value", reasons.alias("reason"))


def constraint_report(
    rows: DataFrame,
    keys: list[str],
    required: list[str],
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Violations per table constraint: ``(rule, violations)``.

    One shuffle on the key counts repeats; the range and not-null checks ride
    along as sums, so the data is not read a second time.
    """
    checks = {f"range_{name}": _outside(F.col(name), span) for name, span in (ranges or {}).items()}
    checks |= {f"not_null_{name}": F.col(name).isNull() for name in required}
    unique = "unique_" + "_".join(keys)
    complete = reduce(lambda left, right: left & right, [F.col(key).isNotNull() for key in keys])
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.count_if(broken).alias(name) for name, broken in checks.items()],
    )
    repeats = F.when(complete, F.col("copies") - 1).otherwise(0)
    totals = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks],
        F.coalesce(F.sum(repeats), F.lit(0)).alias(unique),
    )
    return totals.unpivot([], [*checks, unique], "rule", "violations")


def broken_constraints(required: list[str], ranges: dict[str, tuple[float, float]] | None = None) -> Column:
    """The names of the row constraints that a row breaks, comma-joined; empty if it may be stored."""
    rules = [F.when(F.col(name).isNull(), f"not_null_{name}") for name in required]
    rules += [F.when(_outside(F.col(name), span), f"range_{name}") for name, span in (ranges or {}).items()]
    return F.concat_ws(",", *rules)
