import pytest
from pyspark.sql import types as T

from heddle.options import extension_list, merged, validate
from heddle.types import DeclaredType, division_type, modulo_type, product_type, schema_text, spark_type, sum_type


@pytest.mark.parametrize(
    ("text", "kind", "named"),
    [
        ("bool", T.BooleanType(), "int8"), ("int2", T.ShortType(), "int16"), ("INTEGER", T.IntegerType(), "int32"), ("bigint", T.LongType(), "int64"), ("real", T.FloatType(), "float"),
        ("double precision", T.DoubleType(), "double"), ("numeric(10,2)", T.DecimalType(10, 2), "decimal:10:2"), ("numeric(38)", T.DecimalType(38, 0), "decimal:38:0"),
        ("date", T.DateType(), "date"), ("timestamp", T.TimestampNTZType(), "timestamp"), ("timestamp with time zone", T.TimestampType(), "timestamp"), ("varchar(10)", T.StringType(), "string"),
        ("uuid", T.StringType(), "string"), ("mood", T.StringType(), "string"), ("bytea", T.BinaryType(), "bytea"), ("int4[]", T.ArrayType(T.IntegerType()), "int32[]"),
        ("numeric(10,2)[]", T.ArrayType(T.DecimalType(10, 2)), "decimal[]:10:2"), ("vector(3)", T.ArrayType(T.FloatType(), False), "float[]"), ("money", T.DecimalType(19, 2), "decimal:0:0"),
    ],
)
def test_types(text, kind, named):
    assert spark_type(text) == kind
    assert DeclaredType(text).schema_text == named


@pytest.mark.parametrize("text", ["numeric", "numeric(39,2)", "numeric(4,5)", "vector", "vector(0)", "vector(16001)", "", "int4)("])
def test_bad_types(text):
    with pytest.raises(ValueError):
        DeclaredType(text)


def test_schema_text():
    assert schema_text([("a", "int4"), ("b", "numeric(12,3)"), ("c", "text[]")]) == "a:int32\nb:decimal:12:3\nc:string[]\n"


def test_decimal_rules():
    assert sum_type(10, 2, 8, 4) == (13, 4)
    assert product_type(10, 2, 8, 4) == (19, 6)
    assert division_type(20, 0, 10, 0) == (31, 11)
    assert modulo_type(10, 2, 8, 4) == (10, 4)
    with pytest.raises(OverflowError):
        product_type(30, 0, 20, 0)


def test_options():
    assert validate("server", {"host": "a,b", "fragcnt": 4})["fragcnt"] == "4"
    for kind, bad in (("server", {"fmt": "csv"}), ("table", {"tabel_name": "x"}), ("table", {"fetch_size": "0"}), ("table", {"fetch_size": "x"}), ("server", {"fdw_startup_cost": "-1"}), ("server", {"async_capable": "maybe"}), ("table", {"fmt": "orc"}), ("table", {"csv_quote": "''"}), ("server", {"extensions": "a b,"}), ("column", {"name": "x"})):
        with pytest.raises(ValueError):
            validate(kind, bad)
    with pytest.raises(ValueError, match="table_name"):
        validate("table", {"tabel_name": "x"})
    assert extension_list("a, b") == ["a", "b"]
    assert merged({"fetch_size": "5", "fragcnt": "2"}, {"fetch_size": "7"}) == {"fragcnt": "2", "fetch_size": "7", "csv_delimiter": ",", "csv_quote": '"', "csv_escape": '"', "csv_header": "false", "csv_nullstr": ""}
