"""API documents → records → envelopes → routed log messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.documents import as_list, as_map, kind, parse_document, plain_constants, readable
from gaugeline.functions.staging import staged

TOPIC_PREFIX = "telemetry.raw"


def _lists(object_map: Column) -> Column:
    """The list-valued members as ``array<struct<key, items>>``."""
    lists = F.transform(
        F.map_entries(object_map),
        lambda member: F.struct(member["key"].alias("key"), as_list(member["value"]).alias("items")),
    )
    return F.filter(lists, lambda member: member["items"].isNotNull())


def _row_count(lists: Column) -> Column:
    """Common length of the lists, 0 if there are none or the lengths differ."""
    lengths = F.transform(lists["items"], lambda items: F.size(items))
    shortest = F.array_min(lengths)
    return F.when(shortest == F.array_max(lengths), shortest).otherwise(0)


def normalize_payload(documents: DataFrame, column: str = "document") -> DataFrame:
    """One row per record of each document; adds ``position`` and ``record``.

    * a list gives its object elements;
    * an object whose lists all have one length gives one record per index,
      with the scalars of the object copied in;
    * else the first such object one level down, with the outer scalars;
    * else the object itself; other values give no rows.

    The last of repeated member names counts, at any depth. NaN and infinities,
    which JSON proper lacks, are read and written as they stand.

    All steps are per row, so the job needs no shuffle.
    """
    rows = staged(documents, _text=readable(F.col(column)))
    rows = staged(rows, _value=parse_document(F.col("_text")))
    rows = staged(rows, _list=as_list(F.col("_value")), _root=as_map(F.col("_value")))
    rows = staged(
        rows,
        _own=_lists(F.col("_root")),
        _nested=F.filter(
            F.transform(
                F.map_entries("_root"),
                lambda member: F.struct(
                    member["key"].alias("key"), _lists(as_map(member["value"])).alias("lists")
                ),
            ),
            lambda member: _row_count(member["lists"]) > 0,
        ),
    )
    # Members are sorted by name here, yet the first one in the text counts.
    nested_names = F.filter(
        F.json_object_keys("_text"), lambda name: F.array_contains(F.col("_nested")["key"], name)
    )
    rows = staged(rows, _name=F.when(F.size("_nested") > 1, F.get(nested_names, F.lit(0))))
    named = F.filter("_nested", lambda member: member["key"] == F.col("_name"))
    chosen = F.when(F.col("_name").isNull(), F.col("_nested")).otherwise(named)
    first_nested = F.get(chosen, F.lit(0))["lists"]
    rows = staged(
        rows, _columns=F.when(_row_count(F.col("_own")) > 0, F.col("_own")).otherwise(first_nested)
    )
    scalars = F.filter(
        F.map_entries("_root"),
        lambda member: ~kind(member["value"]).isin("ARRAY", "OBJECT")
        & ~F.array_contains(F.col("_columns")["key"], member["key"]),
    )
    rows = staged(
        rows,
        _scalars=F.when(F.col("_columns").isNotNull(), scalars),
        _indexes=F.sequence(F.lit(0), _row_count(F.col("_columns")) - 1),
    )

    def record_at(index: Column) -> Column:
        picked = F.transform(
            "_columns",
            lambda member: F.struct(
                member["key"].alias("key"), F.get(member["items"], index).alias("value")
            ),
        )
        return F.to_json(F.map_from_entries(F.concat("_scalars", picked)))

    objects = F.filter("_list", lambda item: kind(item) == "OBJECT")
    records = (
        F.when(F.col("_list").isNotNull(), F.transform(objects, lambda item: F.to_json(item)))
        .when(F.col("_columns").isNotNull(), F.transform("_indexes", record_at))
        .when(F.col("_root").isNotNull(), F.array(F.to_json("_value")))
    )
    rows = rows.select(*documents.columns, F.posexplode(records).alias("position", "record"))
    return rows.withColumn("record", plain_constants(F.col("record")))


def rejected_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """The documents that give no record, with a reason.

    * ``no text``: null or blank;
    * ``no JSON``: not readable;
    * ``no object``: a scalar, or a list without objects.
    """
    rows = staged(documents, _text=readable(F.col(column)))
    rows = staged(rows, _value=parse_document(F.col("_text")))
    rows = staged(rows, _list=as_list(F.col("_value")), _root=as_map(F.col("_value")))
    objects = F.exists("_list", lambda item: kind(item) == "OBJECT")
    reason = (
        F.when(F.coalesce(F.trim(column), F.lit("")) == "", "no text")
        .when(F.col("_value").isNull(), "no JSON")
        .when(F.col("_root").isNull() & ~F.coalesce(objects, F.lit(False)), "no object")
    )
    return rows.withColumn("reason", reason).filter("reason IS NOT NULL").select(*documents.columns, "reason")


def build_envelopes(
    records: DataFrame,
    event_id: Column | None = None,
    ingested_at: Column | None = None,
    topic_prefix: str = TOPIC_PREFIX,
) -> DataFrame:
    """``(source, record)`` → ``(topic, key, value)`` messages for the log.

    Give ``event_id`` where the data has one: the generated id is random, so a
    run that is repeated sends new ids.
    """
    moment = F.current_timestamp() if ingested_at is None else ingested_at
    envelope = F.struct(
        (F.uuid() if event_id is None else event_id).alias("event_id"),
        F.col("source"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        F.col("record").alias("payload"),
    )
    return records.select(
        F.concat(F.lit(topic_prefix + "."), F.col("source")).alias("topic"),
        F.col("source").alias("key"),
        F.to_json(envelope).alias("value"),
    )
