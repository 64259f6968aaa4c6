"""Column helpers for PostgreSQL semantics that differ from Spark's, and vector distances."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def pg_asc(column: str | Column) -> Column:
    """Ascending, nulls last."""
    return (F.col(column) if isinstance(column, str) else column).asc_nulls_last()


def pg_desc(column: str | Column) -> Column:
    """Descending, nulls first."""
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_first()


def int_div(a: Column, b: Column) -> Column:
    """Integer division that truncates towards zero."""
    return F.call_function("div", a, b)


def round_double(column: Column, digits: int = 0) -> Column:
    """Half to even, as for doubles; exact numbers use F.round, half away from zero."""
    return F.bround(column, digits)


def is_distinct(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def any_of(array: Column, test: Callable[[Column], Column]) -> Column:
    """x op ANY(array), with SQL's three-valued logic."""
    return F.exists(array, test)


def all_of(array: Column, test: Callable[[Column], Column]) -> Column:
    """x op ALL(array), with SQL's three-valued logic."""
    return F.forall(array, test)


def subscript(array: Column, at: int | Column) -> Column:
    """array[at], from 1; null where there is no such element."""
    position = F.lit(at) if isinstance(at, int) else at
    return F.when(position >= 1, F.try_element_at(array, position))


def array_slice(array: Column, low: int, high: int) -> Column:
    """array[low:high], both included; what lies outside is left out."""
    start = max(low, 1)
    return F.slice(array, start, max(high - start + 1, 0))


def char_equal(a: Column, b: Column) -> Column:
    """Comparison of char(n) values, for which trailing spaces don't count."""
    return F.rtrim(a) == F.rtrim(b)


def vector(values: Sequence[float], dimensions: int | None = None) -> Column:
    """A vector literal; checks the number of dimensions, if given."""
    if dimensions is not None and len(values) != dimensions:
        raise ValueError(f"expected {dimensions} dimensions, not {len(values)}")
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda total, x: total + x)


def _double(array: Column) -> Column:
    return array.cast("array<double>")


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(_double(a), _double(b), lambda x, y: x * y))


def l2_distance(a: Column, b: Column) -> Column:
    """a <-> b"""
    return F.sqrt(_sum(F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y))))


def negative_inner_product(a: Column, b: Column) -> Column:
    """a <#> b"""
    return -inner_product(a, b)


def cosine_distance(a: Column, b: Column) -> Column:
    """a <=> b"""
    return 1 - inner_product(a, b) / (F.sqrt(inner_product(a, a)) * F.sqrt(inner_product(b, b)))
