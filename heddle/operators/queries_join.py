"""Joins, subqueries, set operations, statistics and user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Engine
from .registry import frame, sql, table, views
from .stats import analyze

sql("join_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
sql("join_three", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
sql("join_left", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 100000")
sql("join_left_on_vs_where", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 100000 OR o_orderkey IS NULL")
sql("join_right", "SELECT n_name, s_suppkey FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) s RIGHT JOIN nation ON s_nationkey = n_nationkey")
sql("join_full", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM (SELECT * FROM nation WHERE n_nationkey < 15) a FULL JOIN (SELECT * FROM nation WHERE n_nationkey > 8) b ON a.n_nationkey = b.n_nationkey")
sql("join_full_where", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM (SELECT * FROM nation WHERE n_nationkey < 15) a FULL JOIN (SELECT * FROM nation WHERE n_nationkey > 8) b ON a.n_nationkey = b.n_nationkey WHERE a.n_nationkey IS NULL OR b.n_regionkey > 1")
sql("join_full_true", "SELECT r_regionkey, n_nationkey FROM region FULL JOIN (SELECT * FROM nation WHERE n_nationkey < 4) n ON (true)", "SELECT r_regionkey, n_nationkey FROM region CROSS JOIN (SELECT * FROM nation WHERE n_nationkey < 4) n")
sql("join_full_true_empty", "SELECT r_regionkey, n_nationkey FROM region FULL JOIN (SELECT * FROM nation WHERE n_nationkey < 0) n ON (true)", "SELECT r_regionkey, CAST(NULL AS INTEGER) AS n_nationkey FROM region")
sql("join_outer_chain", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, c.s_suppkey AS c FROM (SELECT * FROM nation WHERE n_nationkey < 12) a FULL JOIN (SELECT * FROM nation WHERE n_nationkey > 6) b ON a.n_nationkey = b.n_nationkey LEFT JOIN supplier c ON b.n_nationkey = c.s_nationkey")
sql("join_outer_chain_right", "SELECT a.n_nationkey AS a, r_name AS r FROM (SELECT * FROM nation WHERE n_nationkey < 3) a LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 9) b ON a.n_regionkey = b.n_nationkey RIGHT JOIN region ON r_regionkey = b.n_regionkey")
sql("join_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
sql("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
sql("join_anti_some", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
sql("join_cross", "SELECT r_regionkey, n_nationkey FROM region CROSS JOIN nation WHERE n_nationkey < 5")
sql("join_theta", "SELECT a.n_nationkey AS a, b.r_regionkey AS b FROM nation a JOIN region b ON a.n_regionkey <= b.r_regionkey AND a.n_nationkey + 1 > b.r_regionkey * 2")
sql("join_text_key", "SELECT a.p_partkey AS a, b.n_nationkey AS b FROM part a JOIN nation b ON a.p_brand = 'Brand#' || CAST(b.n_nationkey AS STRING)")
sql("join_self", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, c.n_nationkey AS c FROM nation a JOIN nation b ON a.n_nationkey = b.n_nationkey + 1 JOIN nation c ON b.n_nationkey = c.n_nationkey + 1")
sql("join_lateral", "SELECT n_nationkey, x.m FROM nation, LATERAL (SELECT max(s_suppkey) AS m FROM supplier WHERE s_nationkey = n_nationkey) x")
sql("join_lateral_agg_rewrite", "SELECT n_nationkey, CAST(sum(s_suppkey + n_regionkey) AS BIGINT) AS s FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey", "SELECT n_nationkey, x.s FROM nation, LATERAL (SELECT CAST(sum(s_suppkey + n_regionkey) AS BIGINT) AS s FROM supplier WHERE s_nationkey = n_nationkey) x WHERE x.s IS NOT NULL")


@frame("SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_totalprice > 250000")
def join_hint_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").where("o_totalprice > 250000")
    return left.join(right.hint("merge"), left.l_orderkey == right.o_orderkey).select("l_orderkey", "l_linenumber", "o_orderstatus")


sql("join_partitionwise", "SELECT a.l_orderkey AS k, a.n AS a, b.n AS b FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) a FULL JOIN (SELECT o_orderkey, count(*) AS n FROM orders WHERE o_totalprice > 150000 GROUP BY o_orderkey) b ON a.l_orderkey = b.o_orderkey")
sql("join_parameterised_inner", "SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'")

sql("sub_in", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
sql("sub_scalar", "SELECT o_orderkey FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)")
sql("sub_exists_select", "SELECT n_nationkey, EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000) AS rich FROM nation")
sql("sub_any_array", "SELECT n_nationkey FROM nation WHERE array_contains((SELECT collect_set(s_nationkey) FROM supplier WHERE s_acctbal > 9000), n_nationkey)", "SELECT n_nationkey FROM nation WHERE n_nationkey = ANY (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
sql("sub_correlated_agg_rewrite", "SELECT r_regionkey, count(CASE WHEN n_nationkey > r_regionkey * 3 THEN 1 END) AS n FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey", "SELECT r_regionkey, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey > r_regionkey * 3) AS n FROM region")
sql("cte", "WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), top AS (SELECT max(n) AS m FROM big) SELECT o_custkey, n FROM big JOIN top ON n = m")
sql("union", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
sql("union_all", "SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0 UNION ALL SELECT s_nationkey FROM supplier")
sql("intersect", "SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
sql("intersect_all", "SELECT l_linenumber AS k FROM lineitem WHERE l_quantity > 48 INTERSECT ALL SELECT l_linenumber FROM lineitem WHERE l_quantity < 2")
sql("except", "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
sql("except_some", "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000")
sql("except_all", "SELECT l_linenumber AS k FROM lineitem WHERE l_quantity > 48 EXCEPT ALL SELECT l_linenumber FROM lineitem WHERE l_quantity < 2")


@frame("SELECT n_nationkey AS k FROM nation UNION ALL SELECT n_nationkey FROM nation")
def append_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several paths are one scan."""
    path = f"{sf_dir}/nation.parquet"
    return spark.read.parquet(path, path).select(F.col("n_nationkey").alias("k"))


@frame("SELECT o_orderkey FROM orders WHERE o_custkey = 7 AND o_totalprice > 1000.0 ORDER BY o_orderkey LIMIT 5")
def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT o_orderkey FROM orders WHERE o_custkey = :c AND o_totalprice > :p ORDER BY o_orderkey LIMIT :n"
    views(spark, sf_dir, text)
    return Engine(spark).sql(text, {"c": 7, "p": 1000.0, "n": 5})


@frame("SELECT n_name, n_regionkey FROM nation WHERE n_regionkey = 2")
def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "nation").where("n_regionkey = 2").createOrReplaceTempView("v_nation_two")
    return spark.sql("SELECT n_name, n_regionkey FROM v_nation_two")


@frame("SELECT count(*) AS n, greatest(1, CAST(ceil(count(*) / 200) AS BIGINT)) AS pages FROM lineitem")
def analyze_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analyze(table(spark, sf_dir, "lineitem").select("l_orderkey"), 100)
    return spark.createDataFrame([(found.rows, found.pages)], "n long, pages long")


@frame()
def analyze_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyze(table(spark, sf_dir, "orders"), 1000, seed=1).sample


@frame("SELECT 1000 AS n, 1000 AS inside, 1000 AS keys")
def analyze_sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample has as many rows as asked for, each of them a row of the table, and none twice."""
    orders = table(spark, sf_dir, "orders")
    drawn = analyze(orders, 1000, seed=3).sample.select("o_orderkey", "o_custkey")
    both = drawn.join(orders.select("o_orderkey", F.col("o_custkey").alias("c")), "o_orderkey")
    return both.agg(F.count("*").cast("int").alias("n"), F.count_if(F.col("o_custkey") == F.col("c")).cast("int").alias("inside"), F.countDistinct("o_orderkey").cast("int").alias("keys"))


@frame("SELECT n_nationkey, n_nationkey * 2 + 1 AS d FROM nation")
def udf_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL function is inlined by Catalyst and stays in generated code."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION twice_and_one(x INT) RETURNS INT RETURN x * 2 + 1")
    views(spark, sf_dir, "nation")
    return spark.sql("SELECT n_nationkey, twice_and_one(n_nationkey) AS d FROM nation")


@frame("SELECT p_partkey, reverse(p_name) AS r FROM part")
def udf_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("string")
    def turned(s: pd.Series) -> pd.Series:
        return s.str[::-1]

    return table(spark, sf_dir, "part").select("p_partkey", turned("p_name").alias("r"))


@frame("SELECT n_nationkey, CAST(unnest(generate_series(0, n_regionkey)) AS INTEGER) AS step FROM nation")
def udtf_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION steps(n INT) RETURNS TABLE (step INT) RETURN SELECT explode(sequence(0, n))")
    views(spark, sf_dir, "nation")
    return spark.sql("SELECT n_nationkey, step FROM nation, LATERAL steps(n_regionkey)")


@frame("SELECT n_regionkey, CAST(min(least(n_nationkey, length(n_name))) AS BIGINT) AS m FROM nation GROUP BY n_regionkey")
def udaf_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user aggregate of several arguments."""

    @F.pandas_udf("long")
    def least_of(a: pd.Series, b: pd.Series) -> int:
        return int(pd.concat([a, b]).min())

    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(least_of("n_nationkey", F.length("n_name")).alias("m"))


@frame("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey % 10, n_nationkey LIMIT 9")
def user_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order of the user's own is a key expression."""
    return table(spark, sf_dir, "nation").orderBy(F.col("n_nationkey") % 10, "n_nationkey").limit(9).select("n_nationkey", "n_name")
