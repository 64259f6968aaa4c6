"""Aggregates, grouping, windows and order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import aggs as A
from ..functions import exprs as X
from .registry import frame, sql, table

MONEY = "CAST(l_extendedprice AS DECIMAL(12,2))"

PRICING = """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_base_price,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS sum_disc_price,
       round(avg(l_quantity), 6) AS avg_qty, min(l_linenumber) AS low, max(l_linenumber) AS high, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus
"""
sql("pricing_summary", PRICING)
sql("agg_count", "SELECT count(*) AS n, count(nullif(l_linenumber, 1)) AS some FROM lineitem")
sql("agg_count_rows", "SELECT n_regionkey, count(struct(n_nationkey, n_name)) AS n FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, count({'a': n_nationkey, 'b': n_name}) AS n FROM nation GROUP BY n_regionkey")
sql("agg_sum_int", "SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS s, CAST(sum(CAST(l_linenumber AS SMALLINT)) AS BIGINT) AS t FROM lineitem GROUP BY l_returnflag")


@frame("SELECT CAST(sum(CAST(o_orderkey AS HUGEINT) * 1000000000000) AS STRING) AS s FROM orders")
def agg_sum_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums that leave 64 bits."""
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey").cast("decimal(20,0)") * F.lit(1000000000000).cast("decimal(14,0)")).alias("x")).agg(A.sum_exact(F.col("x")).cast("string").alias("s"))


@frame("SELECT l_returnflag, CAST(sum(CAST(l_quantity AS REAL)) AS REAL) AS s, sum(l_quantity) AS d FROM lineitem GROUP BY l_returnflag")
def agg_sum_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(A.sum_float4(F.col("l_quantity").cast("float")).alias("s"), F.sum("l_quantity").alias("d"))


sql("agg_sum_decimal", f"SELECT l_returnflag, CAST(sum({MONEY}) AS DECIMAL(25,2)) AS s FROM lineitem GROUP BY l_returnflag")
sql("agg_avg_int", "SELECT l_returnflag, avg(l_linenumber) AS a FROM lineitem GROUP BY l_returnflag")
sql("agg_avg_bigint", "SELECT o_orderstatus, avg(o_custkey) AS a FROM orders GROUP BY o_orderstatus")
sql("agg_avg_decimal", f"SELECT l_returnflag, CAST(sum({MONEY}) AS DOUBLE) / count({MONEY}) AS a FROM lineitem GROUP BY l_returnflag")
sql("agg_avg_double", "SELECT l_returnflag, round(avg(l_quantity), 6) AS a FROM lineitem GROUP BY l_returnflag")


@frame("SELECT l_returnflag, CAST(CAST(sum(l_linenumber) AS DECIMAL(30,4)) / count(*) AS DECIMAL(38,2)) AS a FROM lineitem GROUP BY l_returnflag")
def agg_avg_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(A.avg_exact(F.col("l_linenumber"), 2).alias("a"))


sql("agg_minmax_num", "SELECT l_returnflag, min(l_linenumber) AS a, max(l_linenumber) AS b, min(l_quantity) AS c, max(l_quantity) AS d, min(CAST(l_tax AS FLOAT)) AS e, max(l_orderkey) AS f, min(CAST(l_linenumber AS SMALLINT)) AS g FROM lineitem GROUP BY l_returnflag")
sql("agg_minmax_date_ts", "SELECT o_orderstatus, CAST(min(o_orderdate) AS STRING) AS a, CAST(max(o_orderdate) AS STRING) AS b, CAST(max(CAST(o_orderdate AS DATE)) AS STRING) AS c FROM orders GROUP BY o_orderstatus")
sql("agg_minmax_decimal", f"SELECT l_returnflag, min({MONEY}) AS a, max({MONEY}) AS b FROM lineitem GROUP BY l_returnflag")
sql("agg_minmax_text", "SELECT p_brand, min(p_name) AS a, max(p_name) AS b, max(p_type) AS c FROM part GROUP BY p_brand")
sql("agg_minmax_time", "SELECT event_type, min(date_format(ts, 'HH:mm:ss')) AS a, max(date_format(ts, 'HH:mm:ss')) AS b FROM events GROUP BY event_type", "SELECT event_type, strftime(min(CAST(strftime(ts, '%H:%M:%S') AS TIME)) + DATE '2000-01-01', '%H:%M:%S') AS a, strftime(max(CAST(strftime(ts, '%H:%M:%S') AS TIME)) + DATE '2000-01-01', '%H:%M:%S') AS b FROM events GROUP BY event_type")
sql("agg_minmax_time_interval_array", "SELECT n_regionkey, array_join(max(array(n_nationkey, n_regionkey)), ',') AS a, CAST(extract(DAY FROM max(make_dt_interval(n_nationkey))) AS BIGINT) AS i FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, array_to_string(max([n_nationkey, n_regionkey]), ',') AS a, CAST(extract(DAY FROM max(to_days(n_nationkey))) AS BIGINT) AS i FROM nation GROUP BY n_regionkey")
sql("agg_stddev_var", "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS s, round(var_pop(l_quantity), 6) AS v, round(corr(l_quantity, l_extendedprice), 6) AS c FROM lineitem GROUP BY l_returnflag")
sql("agg_bool", "SELECT l_returnflag, bool_and(l_quantity > 0) AS a, bool_or(l_quantity > 49) AS o, bit_and(l_linenumber) AS b, bit_or(l_linenumber) AS c FROM lineitem GROUP BY l_returnflag")
sql("agg_distinct", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS n, CAST(sum(DISTINCT o_custkey) AS BIGINT) AS s FROM orders GROUP BY o_orderstatus")
sql("agg_filter", "SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS n, CAST(sum(l_linenumber) FILTER (WHERE l_tax < 0.03) AS BIGINT) AS s FROM lineitem GROUP BY l_returnflag")
sql("agg_distinct_filter", "SELECT o_orderstatus, CAST(sum(DISTINCT o_custkey) FILTER (WHERE o_custkey % 3 = 1) AS BIGINT) AS s FROM orders GROUP BY o_orderstatus")
sql("agg_filter_subquery", "SELECT count(m) AS n FROM (SELECT CASE WHEN k IS NOT NULL THEN 1 END AS m FROM orders LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal < 0) c ON o_custkey = k)", "SELECT count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS n FROM orders")


@frame("SELECT n_regionkey, array_to_string(list(n_name ORDER BY n_name DESC), ',') AS names FROM nation GROUP BY n_regionkey")
def agg_array_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group is a region's nations."""
    ordered = F.reverse(A.array_agg_ordered(F.col("n_name"), F.col("n_name")))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(ordered, ",").alias("names"))


@frame("SELECT n_regionkey, CAST(len(list(nullif(n_nationkey, 3))) AS INTEGER) AS n FROM nation GROUP BY n_regionkey")
def agg_array_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.size(A.array_agg(F.expr("nullif(n_nationkey, 3)"))).alias("n"))


sql("agg_listagg", "SELECT n_regionkey, listagg(n_name, ';') WITHIN GROUP (ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ';' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
sql("agg_percentile", "SELECT l_returnflag, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY l_quantity), 6) AS c, percentile_disc(0.5) WITHIN GROUP (ORDER BY l_linenumber) AS d FROM lineitem GROUP BY l_returnflag", "SELECT l_returnflag, round(quantile_cont(l_quantity, 0.25), 6) AS c, CAST(quantile_disc(l_linenumber, 0.5) AS DOUBLE) AS d FROM lineitem GROUP BY l_returnflag")
sql("agg_mode_value", "SELECT l_returnflag, l_linestatus, mode(l_linenumber, true) AS m FROM lineitem GROUP BY l_returnflag, l_linestatus", "SELECT l_returnflag, l_linestatus, l_linenumber AS m FROM (SELECT l_returnflag, l_linestatus, l_linenumber, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY count(*) DESC, l_linenumber) AS r FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber) WHERE r = 1")
sql("agg_mode", "SELECT o_orderstatus, CAST(max(n) AS BIGINT) AS n FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority) GROUP BY o_orderstatus")


@frame("SELECT n_regionkey, round(CASE n_regionkey WHEN 0 THEN quantile_cont(n_nationkey, 0.0) WHEN 1 THEN quantile_cont(n_nationkey, 0.2) WHEN 2 THEN quantile_cont(n_nationkey, 0.4) WHEN 3 THEN quantile_cont(n_nationkey, 0.6) ELSE quantile_cont(n_nationkey, 0.8) END, 9) AS p FROM nation GROUP BY n_regionkey")
def agg_percentile_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.percentile_per_group(F.col("n_nationkey"), F.first(F.col("n_regionkey")) / F.lit(5.0))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.round(p, 9).alias("p"))


@frame("SELECT l_returnflag, 1 + count(*) FILTER (WHERE l_quantity < 25) AS r FROM lineitem GROUP BY l_returnflag")
def agg_hypothetical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(A.hypothetical_rank(F.lit(25), F.col("l_quantity")).alias("r"))


sql("agg_least_of", "SELECT l_returnflag, min(least(l_linenumber, CAST(l_quantity AS INT), 5)) AS m FROM lineitem GROUP BY l_returnflag")
sql("agg_global_empty", "SELECT count(*) AS n, sum(l_linenumber) AS s, max(l_quantity) AS m FROM lineitem WHERE l_quantity < 0", "SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s, max(l_quantity) AS m FROM lineitem WHERE l_quantity < 0")

sql("grp_expr", "SELECT l_linenumber % 3 AS k, count(*) AS n FROM lineitem GROUP BY l_linenumber % 3")
sql("grp_ordinal_alias_const", "SELECT o_orderstatus AS s, 9 AS c, count(*) AS n FROM orders GROUP BY 1, 2")
sql("grp_no_agg", "SELECT l_returnflag, l_linestatus FROM lineitem GROUP BY l_returnflag, l_linestatus")
sql("grp_null_key", "SELECT nullif(n_regionkey, 2) AS k, count(*) AS n FROM nation GROUP BY nullif(n_regionkey, 2)")
sql("grp_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12 AND max(o_totalprice) > 1000")
sql("grp_expr_over_agg", "SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) * 2 + count(*) AS x, count(*) > 100 AS many FROM lineitem GROUP BY l_returnflag")
sql("grp_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_linestatus) AS BIGINT) AS g FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
sql("grp_cube", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
sql("grp_sets", "SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
sql("grp_distinct_over_agg", "SELECT DISTINCT count(*) % 5 AS m FROM orders GROUP BY o_custkey")
sql("grp_over_join", "SELECT n_name, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS s FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
sql("grp_over_union", "SELECT k, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier) u GROUP BY k")
sql("grp_partitionwise", "SELECT l_orderkey % 30 AS a, count(*) AS n, min(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey % 30 HAVING avg(l_linenumber) < 4")


@frame("SELECT count(*) AS n FROM orders")
def grp_volatile_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A volatile key is evaluated once a row; the counts add up to the rows."""
    return table(spark, sf_dir, "orders").groupBy((F.rand(1) * 3).cast("int")).count().agg(F.sum("count").alias("n"))


@frame("SELECT o_orderkey, nullif(o_orderkey % 5, 2) AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderkey % 5, 2) DESC NULLS FIRST, o_orderkey) AS r FROM orders")
def sort_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of each customer's orders, nulls first."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.expr("nullif(o_orderkey % 5, 2)").alias("k"))
    order = Window.partitionBy("o_custkey").orderBy(X.pg_desc("k"), X.pg_asc("o_orderkey"))
    return rows.select("o_orderkey", "k", F.row_number().over(order).cast("bigint").alias("r"))


sql("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 25")
sql("limit_offset_ordered", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 100")
sql("limit_after_group", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 15")
sql("sort_expr", "SELECT n_nationkey, n_name FROM nation ORDER BY length(n_name) DESC, n_name LIMIT 7")


@frame("SELECT 40 AS n")
def limit_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a limit without order keeps is open; how many is not."""
    return table(spark, sf_dir, "orders").limit(40).agg(F.count("*").cast("int").alias("n"))


sql("win_partition_agg", "SELECT o_custkey, n, count(*) OVER (PARTITION BY n) AS peers FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) t")
sql("win_running", "SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS running FROM orders")
sql("win_range_following", "SELECT n_regionkey, n_nationkey, CAST(sum(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS s FROM nation")
sql("win_rank", "SELECT o_orderkey, CAST(row_number() OVER w AS BIGINT) AS rn, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS rk, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS dr, lag(o_orderkey) OVER w AS before, lead(o_orderkey, 2) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
sql("win_array", "SELECT n_nationkey, array_join(collect_list(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC), ',') AS seen FROM nation", "SELECT n_nationkey, array_to_string(list(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC), ',') AS seen FROM nation")
