"""Columns computed in an operator of their own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps may use many times at the cost of one.

    The optimizer merges neighbouring projections and copies an expression to
    each place of use, filters and lambda bodies included. For a JSON parse
    that means parsing again and again. ``inline`` over one struct cannot be
    merged away, and needs no shuffle.
    """
    struct = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select("*", F.inline(F.array(struct)))
