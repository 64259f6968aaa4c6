"""Scans, predicates, scalar functions and vectors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Engine
from ..functions import exprs as X
from ..sources.files import write
from .registry import frame, sql, table

NATION = [("n_nationkey", "int4"), ("n_name", "text"), ("n_regionkey", "int4")]


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one that the cluster shares, or below a temporary one of this machine in local runs."""
    base = spark.conf.get("spark.checkpoint.dir", None) or "file://" + os.path.join(tempfile.gettempdir(), "heddle-files")
    return f"{base.rstrip('/')}/heddle-{spark.sparkContext.applicationId}-files/{uuid.uuid4().hex[:12]}"


@frame("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Engine(spark).create_table("t_scan_parquet", NATION, base_dir=sf_dir, options={"fmt": "parquet", "table_name": "nation.parquet"}).df


@frame("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS STRING) AS o_orderdate, o_orderpriority FROM orders")
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    dialect = {"csv_delimiter": "|", "csv_header": "true"}
    write(table(spark, sf_dir, "orders"), folder, "csv", dialect)
    columns = [("o_orderkey", "int8"), ("o_custkey", "int8"), ("o_orderstatus", "text"), ("o_totalprice", "float8"), ("o_orderdate", "timestamp"), ("o_orderpriority", "text")]
    read = Engine(spark).create_table("t_scan_csv", columns, options={"fmt": "csv", "table_name": folder, **dialect}).df
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@frame("SELECT n_nationkey, n_name FROM nation")
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Engine(spark).create_table("t_scan_glob", NATION[:2], base_dir=sf_dir, options={"fmt": "parquet", "table_name": "natio*.parquet"}).df


@frame("SELECT n_nationkey AS id, n_name AS label FROM nation")
def scan_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [("id", "int4", {"column_name": "n_nationkey"}), ("label", "text", {"column_name": "n_name"})]
    return Engine(spark).create_table("t_scan_rename", columns, base_dir=sf_dir, options={"fmt": "parquet", "table_name": "nation.parquet"}).df


@frame("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_whole_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.struct("*").alias("row")).select("row.*")


@frame("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey FROM nation")
def scan_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fragment count changes how many tasks there are, and no result."""
    engine = Engine(spark)
    server = engine.create_server("s", {"fragcnt": "4", "fetch_size": "10", "host": "a:1,b:2"})
    return engine.create_table("t_fragments", [("n_nationkey", "int8")], server, sf_dir, {"fmt": "parquet", "table_name": "nation.parquet"}).df


@frame("SELECT n_nationkey, 'nation' AS tableoid FROM nation")
def scan_system_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant for the table; the file of a row is _metadata.file_path."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("_metadata.file_path").alias("path"))
    return rows.where(F.col("path").contains("nation")).select("n_nationkey", F.lit("nation").alias("tableoid"))


sql("scan_empty_projection", "SELECT CAST(NULL AS BIGINT) AS x FROM nation")
sql("pred_compare_and_or_not", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_quantity > 45 AND NOT l_discount < 0.05) OR (l_tax = 0.08 AND l_quantity <= 2)")
sql("pred_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
sql("pred_null_test", "SELECT n_nationkey, nullif(n_regionkey, 2) IS NULL AS missing FROM nation WHERE nullif(n_name, 'FRANCE') IS NOT NULL")
sql("pred_is_distinct", "SELECT n_nationkey FROM nation WHERE nullif(n_regionkey, 1) IS DISTINCT FROM 3 AND NOT (nullif(n_regionkey, 1) IS DISTINCT FROM nullif(n_regionkey, 1) AND n_regionkey = 9)")


@frame("SELECT o_orderkey FROM orders WHERE o_custkey % 7 = ANY([1, 3, NULL])")
def pred_any_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    array = F.array(F.lit(1), F.lit(3), F.lit(None).cast("int"))
    return table(spark, sf_dir, "orders").where(X.any_of(array, lambda x: F.col("o_custkey") % 7 == x)).select("o_orderkey")


@frame("SELECT o_orderkey FROM orders WHERE o_custkey % 7 > 2 AND o_custkey % 7 > 4")
def pred_all_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(X.all_of(F.array(F.lit(2), F.lit(4)), lambda x: F.col("o_custkey") % 7 > x)).select("o_orderkey")


sql("pred_in_list", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 3, 5) AND l_returnflag IN ('A', 'R')")
sql("pred_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%a%' AND p_type NOT LIKE 'S%' AND p_brand LIKE 'Brand__%'")
sql("pred_case_searched", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 'low' WHEN l_quantity < 30 THEN 'middle' ELSE 'high' END AS band FROM lineitem")
sql("pred_case_simple", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS code FROM orders")
sql("pred_empty", "SELECT o_orderkey FROM orders WHERE 1 = 0")
sql("pred_boolean_tests", "SELECT n_nationkey, (nullif(n_regionkey, 1) > 2) IS TRUE AS yes, (nullif(n_regionkey, 1) > 2) IS NOT FALSE AS not_no FROM nation")

sql("fn_math", "SELECT l_orderkey, l_linenumber, abs(-l_quantity) AS a, sqrt(l_quantity) AS s, -l_linenumber AS m, l_linenumber * 3 + 1 AS p, CAST(floor(l_extendedprice) AS BIGINT) AS f, CAST(ceil(l_extendedprice) AS BIGINT) AS c, round(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS r FROM lineitem")
sql("fn_int_div_mod", "SELECT o_orderkey, o_custkey div 7 AS q, -o_custkey div 7 AS nq, o_custkey % 7 AS r, -o_custkey % 7 AS nr FROM orders", "SELECT o_orderkey, o_custkey // 7 AS q, -(o_custkey // 7) AS nq, o_custkey % 7 AS r, -o_custkey % 7 AS nr FROM orders")


@frame("SELECT o_orderkey, o_custkey // 7 AS q FROM orders")
def fn_int_div_helper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", X.int_div(F.col("o_custkey"), F.lit(7)).alias("q"))


sql("fn_string", "SELECT p_partkey, upper(p_name) AS u, lower(p_name) AS l, length(p_name) AS n, p_brand || '-' || p_type AS b, substr(p_name, 2, 3) AS s, trim(p_name) AS t, replace(p_name, 'a', 'bb') AS r FROM part", "SELECT p_partkey, upper(p_name) AS u, lower(p_name) AS l, CAST(length(p_name) AS INTEGER) AS n, p_brand || '-' || p_type AS b, substr(p_name, 2, 3) AS s, trim(p_name) AS t, replace(p_name, 'a', 'bb') AS r FROM part")
sql("fn_char_padding", "SELECT n_nationkey, rtrim(rpad(n_name, 30, ' ')) = rtrim(n_name || '  ') AS same FROM nation")
sql("fn_date", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d, CAST(o_orderdate + INTERVAL '3' DAY AS STRING) AS later, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(date_trunc('month', o_orderdate) AS STRING) AS t FROM orders", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d, CAST(o_orderdate + INTERVAL '3' DAY AS STRING) AS later, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS STRING) AS t FROM orders")
sql("fn_to_char_pad", "SELECT n_nationkey, lpad(CAST(n_nationkey AS STRING), 4, '0') AS padded FROM nation")
sql("fn_cast", "SELECT l_orderkey, l_linenumber, l_quantity::BIGINT AS q, CAST(l_orderkey AS STRING) AS k, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_linenumber AS SMALLINT) AS s FROM lineitem")
sql("fn_coalesce_nullif_greatest", "SELECT n_nationkey, coalesce(nullif(n_regionkey, 2), -1) AS c, greatest(n_nationkey, n_regionkey, 7) AS g, least(n_nationkey, n_regionkey) AS l FROM nation")


@frame("SELECT n_nationkey, list_extract([n_nationkey, n_regionkey, 5], n_regionkey) AS e, array_to_string(list_slice([n_nationkey, n_regionkey, 5], 2, 9), ',') AS s FROM (SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_regionkey FROM nation WHERE n_regionkey > 0)")
def fn_array_subscript_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    array = F.array("n_nationkey", "n_regionkey", F.lit(5))
    rows = table(spark, sf_dir, "nation").where("n_regionkey > 0")
    return rows.select("n_nationkey", X.subscript(array, F.col("n_regionkey")).alias("e"), F.array_join(X.array_slice(array, 2, 9), ",").alias("s"))


sql("fn_array_literal", "SELECT n_nationkey, array_join(array(n_nationkey, n_regionkey), ',') AS a, size(array(1, 2, NULL)) AS n FROM nation", "SELECT n_nationkey, array_to_string([n_nationkey, n_regionkey], ',') AS a, CAST(len([1, 2, NULL]) AS INTEGER) AS n FROM nation")
sql("fn_generate_series", "SELECT n_nationkey, g FROM nation LATERAL VIEW explode(sequence(1, n_regionkey + 1)) s AS g", "SELECT n_nationkey, CAST(unnest(generate_series(1, n_regionkey + 1)) AS INTEGER) AS g FROM nation")
sql("fn_json", "SELECT event_id, get_json_object(props, '$.k') AS k FROM events", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
sql("fn_regexp", "SELECT p_partkey, regexp_replace(p_name, '[aeiou]+', '_') AS r, p_type RLIKE '^[A-M]' AS m FROM part", "SELECT p_partkey, regexp_replace(p_name, '[aeiou]+', '_', 'g') AS r, regexp_matches(p_type, '^[A-M]') AS m FROM part")

QUERY = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding beside the one of vec_id 0, a single row."""
    rows = table(spark, sf_dir, "embeddings")
    one = rows.where("vec_id = 0").select(F.col("embedding").alias("q")).limit(1)
    return rows.crossJoin(F.broadcast(one))


def _distance(name: str) -> str:
    return f"SELECT vec_id, round({name}, 6) AS d FROM (SELECT vec_id, embedding::DOUBLE[] AS e, {QUERY}::DOUBLE[] AS q FROM embeddings)"


@frame(_distance("list_distance(e, q)"))
def vec_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).select("vec_id", F.round(X.l2_distance(F.col("embedding"), F.col("q")), 6).alias("d"))


@frame(_distance("-list_inner_product(e, q)"))
def vec_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).select("vec_id", F.round(X.negative_inner_product(F.col("embedding"), F.col("q")), 6).alias("d"))


@frame(_distance("1 - list_cosine_similarity(e, q)") + " WHERE vec_id > 0")
def vec_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).where("vec_id > 0").select("vec_id", F.round(X.cosine_distance(F.col("embedding"), F.col("q")), 6).alias("d"))


@frame(_distance("list_distance(e, q)") + " ORDER BY list_distance(e, q), vec_id LIMIT 10")
def vec_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = X.l2_distance(F.col("embedding"), F.col("q"))
    return _near(spark, sf_dir).select("vec_id", d.alias("d")).orderBy("d", "vec_id").limit(10).withColumn("d", F.round("d", 6))


@frame(_distance("list_distance(e, q)") + " WHERE list_distance(e, q) < 1.2")
def vec_filter_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = X.l2_distance(F.col("embedding"), F.col("q"))
    return _near(spark, sf_dir).where(d < 1.2).select("vec_id", F.round(d, 6).alias("d"))


@frame("SELECT vec_id, CAST(round(list_distance(embedding::DOUBLE[], list_resize([1.0]::DOUBLE[], 64, 0.0)), 6) AS DOUBLE) AS d FROM embeddings")
def vec_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = X.vector([1.0] + [0.0] * 63, 64)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(X.l2_distance(F.col("embedding"), q), 6).alias("d"))
