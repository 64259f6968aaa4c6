"""Readers and writers of the files under a declared table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import boolean
from ..types import DeclaredType

Columns = list[tuple[str, str, str]]  # source name, name, declared type


def read_parquet(spark: SparkSession, path: str, columns: Columns) -> DataFrame:
    """Declared columns of Parquet files; the declaration, not the files, gives the types.

    A file's own type may differ: the column is then read as it is and cast, which still lets the scan prune columns.
    """
    found = spark.read.parquet(path)
    own = {f.name: f.dataType for f in found.schema}
    missing = [s for s, _, _ in columns if s not in own]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    out = []
    for source, name, kind in columns:
        declared = DeclaredType(kind)
        column = F.col(f"`{source}`")
        if own[source] != declared.spark and not isinstance(declared.spark, T.ArrayType):
            column = column.cast(declared.spark)
        elif isinstance(declared.spark, T.ArrayType) and declared.dimensions is None:
            column = column.cast(declared.spark)
        out.append(checked(column, declared).alias(name))
    return found.select(*out)


def checked(column: Column, declared: DeclaredType) -> Column:
    """A vector column that raises where a value has another number of dimensions or a null in it."""
    if declared.dimensions is None:
        return column
    values = column.cast("array<float>")
    bad = (F.size(values) != declared.dimensions) | F.exists(values, lambda x: x.isNull())
    return F.when(column.isNull(), None).when(bad, F.raise_error(F.lit(f"expected {declared.dimensions} dimensions without nulls")).cast("array<float>")).otherwise(values)


def read_csv(spark: SparkSession, path: str, columns: Columns, options: dict[str, str], multiline: bool = True) -> DataFrame:
    """Declared columns of CSV files, by position. The schema is never inferred.

    Types that the CSV source reads well are read so when the null string is empty; others, and all for another null
    string, are read as text and converted: then an empty field is an empty text and only the null string is null.

    With multiline a quoted field may hold line ends, for which a file cannot be split and is one task; without it large
    files are read by many tasks.
    """
    declared = [(name, DeclaredType(kind)) for _, name, kind in columns]
    nullstr = options["csv_nullstr"]
    direct = [not nullstr and _direct(d) for _, d in declared]
    schema = T.StructType([T.StructField(name, d.spark if ok else T.StringType()) for (name, d), ok in zip(declared, direct, strict=True)])
    reader = spark.read.schema(schema).option("sep", options["csv_delimiter"]).option("quote", options["csv_quote"]).option("escape", options["csv_escape"])
    reader = reader.option("header", boolean(options["csv_header"])).option("enforceSchema", True).option("multiLine", multiline).option("mode", "FAILFAST")
    # A null string that no field can have keeps empty fields apart from null ones.
    rows = reader.option("nullValue", nullstr if not nullstr else "\x00").option("emptyValue", "").csv(path)
    out = []
    for (name, d), ok in zip(declared, direct, strict=True):
        column = F.col(f"`{name}`")
        if nullstr:
            column = F.coalesce(column, F.lit(""))
            column = F.when(column == nullstr, None).otherwise(column)
        out.append((column if ok else from_text(column, d)).alias(name))
    return rows.select(*out)


def _direct(d: DeclaredType) -> bool:
    return not isinstance(d.spark, T.ArrayType | T.TimeType | T.BooleanType | T.DayTimeIntervalType | T.BinaryType)


def from_text(column: Column, d: DeclaredType) -> Column:
    """A text field as a value: arrays and vectors are {a,b} or [a,b], booleans t or f and their long forms."""
    if isinstance(d.spark, T.ArrayType):
        inner = F.regexp_replace(column, r"^\s*[\[{]|[\]}]\s*$", "")
        element = d.spark.elementType
        parts = F.when(F.trim(inner) == "", F.array().cast("array<string>")).otherwise(F.split(inner, ","))
        values = F.transform(parts, lambda x: F.when(F.upper(F.trim(x)) == "NULL", None).otherwise(_scalar(F.trim(x), element)))
        return checked(F.when(column.isNotNull(), values), d)
    return _scalar(column, d.spark)


def _scalar(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.BooleanType):
        low = F.lower(F.trim(column))
        return F.when(low.isin("t", "true", "y", "yes", "on", "1"), True).when(low.isin("f", "false", "n", "no", "off", "0"), False).when(low.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), column)).cast("boolean"))
    if isinstance(kind, T.BinaryType):
        return F.when(column.startswith("\\x"), F.unhex(F.regexp_replace(column, r"^\\x", ""))).otherwise(column.cast("binary"))
    if isinstance(kind, T.DayTimeIntervalType):
        return column.cast(kind)
    return F.trim(column).cast(kind)


def write(df: DataFrame, path: str, fmt: str, options: dict[str, str] | None = None) -> None:
    """A sink for results, in either format; CSV with the same dialect that read_csv reads."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
        return
    o = options or {}
    writer = writer.option("sep", o.get("csv_delimiter", ",")).option("quote", o.get("csv_quote", '"')).option("escape", o.get("csv_escape", '"'))
    writer.option("header", boolean(o.get("csv_header", "false"))).option("nullValue", o.get("csv_nullstr", "")).option("emptyValue", '""').csv(path)
