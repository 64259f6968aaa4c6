import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heddle.functions import aggs as A
from heddle.functions import exprs as X


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r.x for r in df.orderBy(X.pg_asc("x")).collect()] == [1, 3, None]
    assert [r.x for r in df.orderBy(X.pg_desc("x")).collect()] == [None, 3, 1]


def test_expressions(spark):
    row = spark.range(1).select(
        X.int_div(F.lit(-7), F.lit(2)).alias("d"), X.round_double(F.lit(2.5)).alias("r"), X.is_distinct(F.lit(None).cast("int"), F.lit(1)).alias("i"),
        X.subscript(F.array(F.lit(5), F.lit(6)), 2).alias("s"), X.subscript(F.array(F.lit(5)), 0).alias("z"), X.subscript(F.array(F.lit(5)), 9).alias("n"),
        X.array_slice(F.array(F.lit(1), F.lit(2), F.lit(3)), 2, 7).alias("t"), X.char_equal(F.lit("a  "), F.lit("a")).alias("c"),
        X.any_of(F.array(F.lit(1), F.lit(None).cast("int")), lambda x: x == 2).alias("a"), X.all_of(F.array(F.lit(1), F.lit(2)), lambda x: x > 0).alias("l"),
    ).first()
    assert (row.d, row.r, row.i, row.s, row.z, row.n, row.t, row.c, row.a, row.l) == (-3, 2.0, True, 6, None, None, [2, 3], True, None, True)


def test_vector_distances(spark):
    a, b = X.vector([1, 2, 3], 3), X.vector([4, 6, 3])
    row = spark.range(1).select(X.l2_distance(a, b).alias("l"), X.negative_inner_product(a, b).alias("i"), X.cosine_distance(a, b).alias("c")).first()
    assert row.l == 5.0 and row.i == -25.0
    assert math.isclose(row.c, 1 - 25 / math.sqrt(14 * 61))
    with pytest.raises(ValueError):
        X.vector([1, 2], 3)


def test_aggregates(spark):
    df = spark.createDataFrame([(1, 2**62, "b", 1.0), (1, 2**62, None, 2.0), (1, 2**62, "a", 4.0)], "k int, x long, s string, d double")
    row = df.groupBy("k").agg(A.sum_exact(F.col("x")).alias("s"), A.avg_exact(F.col("k"), 2).alias("a"), A.array_agg(F.col("s")).alias("all"), A.array_agg_ordered(F.col("s"), F.col("d")).alias("o"), A.hypothetical_rank(F.lit(3.0), F.col("d")).alias("r"), A.percentile_per_group(F.col("d"), F.lit(0.75)).alias("p"), A.sum_float4(F.col("d").cast("float")).alias("f")).first()
    assert int(row.s) == 3 * 2**62 and str(row.a) == "1.00" and len(row["all"]) == 3 and row.o == ["b", None, "a"] and row.r == 3 and row.p == 3.0 and row.f == 7.0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5)), st.text("abc", max_size=3)), min_size=1, max_size=30))
def test_fragments_do_not_change_aggregates(spark, rows):
    df = spark.createDataFrame(rows, "k int, x int, s string")
    results = []
    for n in (1, 4, 16):
        out = df.repartition(n).groupBy("k").agg(F.count("x"), F.count_distinct("x"), F.min("s"), F.max("s"), F.sum("x"), F.avg("x"), F.expr("count(*) FILTER (WHERE x > 0)"))
        results.append(sorted(map(tuple, out.collect())))
        assert out.orderBy("k").limit(2).count() == min(2, len({r[0] for r in rows}))
    assert results[0] == results[1] == results[2]
