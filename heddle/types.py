"""SQL type names and Spark types, and the schema text of a declared table."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: SQL names, their Spark type and their name in schema text.
_PLAIN = {
    "bool": (T.BooleanType(), "int8"),
    "int2": (T.ShortType(), "int16"),
    "int4": (T.IntegerType(), "int32"),
    "int8": (T.LongType(), "int64"),
    "int128": (T.DecimalType(38, 0), "int128"),
    "float4": (T.FloatType(), "float"),
    "float8": (T.DoubleType(), "double"),
    "money": (T.DecimalType(19, 2), "decimal:0:0"),
    "date": (T.DateType(), "date"),
    "time": (T.TimeType(6), "time"),
    "timestamp": (T.TimestampNTZType(), "timestamp"),
    "timestamptz": (T.TimestampType(), "timestamp"),
    "interval": (T.DayTimeIntervalType(), "interval"),
    "text": (T.StringType(), "string"),
    "bytea": (T.BinaryType(), "bytea"),
}
_ALIASES = {
    "boolean": "bool", "smallint": "int2", "int": "int4", "integer": "int4", "bigint": "int8", "real": "float4", "double precision": "float8", "double": "float8",
    "float": "float8", "decimal": "numeric", "varchar": "text", "character varying": "text", "char": "text", "character": "text", "bpchar": "text", "string": "text",
    "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamptz", "time without time zone": "time", "uuid": "text", "json": "text", "jsonb": "text", "enum": "text",
}
MAX_PRECISION = 38
MAX_DIMENSIONS = 16000


class DeclaredType:
    """A parsed SQL type: name, modifiers, whether it is an array, Spark type, schema text and, for char(n), its width."""

    def __init__(self, text: str):
        shape = re.fullmatch(r"\s*([a-z][a-z0-9_ ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*(-?\d+)\s*)?\))?\s*(with(?:out)? time zone)?\s*(\[\s*\d*\s*\])?\s*", text.lower())
        if not shape:
            raise ValueError(f"not a type: {text!r}")
        base, first, second, zone, array = shape.groups()
        base = f"{base} {zone}" if zone else base
        self.name = _ALIASES.get(base, base)
        self.array = array is not None
        self.width = int(first) if base in ("char", "character", "bpchar") and first else 1 if base in ("char", "character") else None
        self.dimensions = None
        if self.name == "vector":
            if self.array or not first or not 1 <= int(first) <= MAX_DIMENSIONS:
                raise ValueError(f"vector needs 1 to {MAX_DIMENSIONS} dimensions: {text!r}")
            self.dimensions = int(first)
            self.spark, self.schema_text = T.ArrayType(T.FloatType(), False), "float[]"
            return
        if self.name == "numeric":
            if not first:
                raise ValueError("numeric needs a precision and a scale, such as numeric(18,2)")
            precision, scale = int(first), int(second or 0)
            if not 1 <= precision <= MAX_PRECISION or not 0 <= scale <= precision:
                raise ValueError(f"numeric of at most {MAX_PRECISION} digits with 0 <= scale <= precision: {text!r}")
            spark, name, rest = T.DecimalType(precision, scale), "decimal", f":{precision}:{scale}"
        else:
            spark, whole = _PLAIN.get(self.name, _PLAIN["text"])  # anything unknown is text
            name, _, rest = whole.partition(":")
            rest = rest and f":{rest}"
        self.spark = T.ArrayType(spark) if self.array else spark
        self.schema_text = f"{name}{'[]' if self.array else ''}{rest}"


def spark_type(text: str) -> T.DataType:
    return DeclaredType(text).spark


def schema_text(columns: list[tuple[str, str]]) -> str:
    """A line for each column: name:type, and for decimals name:decimal:precision:scale."""
    return "".join(f"{name}:{DeclaredType(kind).schema_text}\n" for name, kind in columns)


def division_type(p1: int, s1: int, p2: int, s2: int) -> tuple[int, int]:
    """Precision and scale of a quotient of exact numbers; scale is 4 at least."""
    scale = max(4, s1 + p2 - s2 + 1)
    return _held(p1 - s1 + s2 + scale, scale)


def sum_type(p1: int, s1: int, p2: int, s2: int) -> tuple[int, int]:
    scale = max(s1, s2)
    return _held(max(p1 - s1, p2 - s2) + 1 + scale, scale)


def product_type(p1: int, s1: int, p2: int, s2: int) -> tuple[int, int]:
    return _held(p1 + p2 + 1, s1 + s2)


def modulo_type(p1: int, s1: int, p2: int, s2: int) -> tuple[int, int]:
    return _held(max(p1, p2), max(s1, s2))


def _held(precision: int, scale: int) -> tuple[int, int]:
    if precision > MAX_PRECISION:
        raise OverflowError(f"{precision} digits are more than {MAX_PRECISION}")
    return precision, scale
