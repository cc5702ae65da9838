"""JSON document helpers built on Spark's JSON and VARIANT functions."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Same tolerance as JSON path extraction: control characters pass, NaN does not.
_PARSE_OPTIONS = {
    "columnNameOfCorruptRecord": "broken_text",
    "allowUnquotedControlChars": "true",
    "allowNonNumericNumbers": "false",
}
PAYLOAD_MEMBERS = ["id", "timestamp", "time", "temperature", "humidity"]

#: With it Spark's reader keeps the last of repeated member names, in every object, instead of refusing the text.
LAST_NAME_WINS = "spark.sql.variant.allowDuplicateKeys"

#: Marks a number that JSON has no text for, inside the string that stands for it.
MARK = "\ue000"
CONSTANTS = "-?Infinity|NaN"

NUMBERS = ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]


def payload_fields(payload: Column) -> Column:
    """The addressed payload members as text, from one pass over the document.

    ``broken_text`` is set where the text is no JSON object.
    """
    columns = ", ".join(f"{name} STRING" for name in [*PAYLOAD_MEMBERS, "broken_text"])
    return F.from_json(payload, columns, _PARSE_OPTIONS)


def first_member(document: Column, name: str, last: Column) -> Column:
    """The first member called ``name``, given the ``last`` one from a parse.

    Only a document in which the quoted name stands twice is read again.
    """
    up_to_second = F.substring_index(document, f'"{name}"', 2)
    twice = F.octet_length(up_to_second) < F.octet_length(document)
    return F.when(twice, F.get_json_object(document, f"$.{name}")).otherwise(last)


def is_json(payload: Column, broken_text: Column) -> Column:
    """Whether ``payload`` starts with a JSON value.

    An object was already read by :func:`payload_fields`; only the rest is
    looked at again, so the common case costs nothing.
    """
    read = broken_text.isNull() & (F.trim(payload) != "")
    return payload.isNotNull() & (read | F.get_json_object(payload, "$").isNotNull())


def is_whole_json(text: Column) -> Column:
    """Whether ``text`` is one JSON value and nothing else.

    Spark's parsers stop after the first value. Text after it cannot fit into
    both a list and an object around the whole.
    """
    listed = parse_document(F.concat(F.lit("["), text, F.lit("]")))
    wrapped = parse_document(F.concat(F.lit('{"value":'), text, F.lit("}")))
    return F.coalesce(F.size(as_list(listed)) == 1, F.lit(False)) & wrapped.isNotNull()


def parse_document(text: Column) -> Column:
    """A JSON text as a variant, null where it cannot be read.

    Where an object at any depth repeats a member name, the last one counts. The
    session keeps the setting that says so, since Spark asks for it once more
    when a query runs.
    """
    SparkSession.active().conf.set(LAST_NAME_WINS, "true")
    return F.try_parse_json(text)


def readable(text: Column) -> Column:
    """The text with NaN and infinities, where a document cannot be read for them, as marked strings.

    Other readers take them for numbers. ``plain_constants`` undoes it.
    """
    has_one = (F.contains(text, F.lit("NaN")) | F.contains(text, F.lit("Infinity"))) & ~F.contains(text, F.lit(MARK))
    strings = F.regexp_replace(text, rf'("[^"\\]*+(?:\\.[^"\\]*+)*+")|({CONSTANTS})', f"$1{MARK}$2{MARK}")
    marked = F.regexp_replace(F.replace(strings, F.lit(MARK * 2), F.lit("")), f"{MARK}({CONSTANTS}){MARK}", f'"{MARK}$1"')
    return F.when(has_one & parse_document(text).isNull(), marked).otherwise(text)


def plain_constants(text: Column) -> Column:
    """A document's text with marked strings as the numbers they stand for."""
    return F.when(F.contains(text, F.lit(MARK)), F.regexp_replace(text, f'"{MARK}({CONSTANTS})"', "$1")).otherwise(text)


def as_map(value: Column, path: str = "$") -> Column:
    """The members of a variant object, null for any other value."""
    return F.try_variant_get(value, path, "map<string,variant>")


def as_list(value: Column) -> Column:
    """The elements of a variant array, null for any other value."""
    return F.try_variant_get(value, "$", "array<variant>")


def members(document: Column) -> Column:
    """The members of a JSON object in a text column."""
    return as_map(parse_document(document))


def kind(value: Column) -> Column:
    """Base type of a variant: BOOLEAN, one of NUMBERS, STRING, ARRAY, OBJECT or VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def number(value: Column, value_kind: Column) -> Column:
    """Variant to double; booleans count as 1 and 0, text does not count."""
    return F.when(value_kind.isin(NUMBERS), F.try_variant_get(value, "$", "double")).when(
        value_kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double")
    )
