"""Aggregates that Spark lacks or types otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_exact(column: Column) -> Column:
    """Sum of bigints as an exact number: it cannot overflow 64 bits."""
    return F.sum(column.cast("decimal(38,0)"))


def sum_float4(column: Column) -> Column:
    return F.sum(column).cast("float")


def avg_exact(column: Column, scale: int = 4) -> Column:
    """Average of exact numbers with `scale` digits; null without values."""
    return (F.sum(column.cast(f"decimal(28,{scale})")).cast(f"decimal(38,{scale})") / F.count(column)).cast(f"decimal(38,{scale})")


def array_agg(column: Column) -> Column:
    """All values in an array, nulls too. The array holds a whole group: only for groups of a bounded size."""
    return F.transform(F.collect_list(F.struct(column.alias("x"))), lambda s: s["x"])


def array_agg_ordered(column: Column, *keys: Column) -> Column:
    """All values, nulls too, in the order of the keys (ascending; pass -key to turn a number's order)."""
    fields = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    return F.transform(F.array_sort(F.collect_list(F.struct(*fields, column.alias("x")))), lambda s: s["x"])


def hypothetical_rank(value: Column, column: Column) -> Column:
    """rank(value) WITHIN GROUP (ORDER BY column)"""
    return (F.count_if(column < value) + 1).cast("bigint")


def percentile_per_group(column: Column, fraction: Column) -> Column:
    """percentile_cont of which each group has its own fraction; holds a group's values."""
    values = F.array_sort(F.collect_list(column.cast("double")))
    at = fraction * (F.size(values) - 1)
    low, high = F.floor(at).cast("int") + 1, F.ceil(at).cast("int") + 1
    return F.when(F.size(values) > 0, F.element_at(values, low) + (at - F.floor(at)) * (F.element_at(values, high) - F.element_at(values, low)))
