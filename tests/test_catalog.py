import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from heddle.catalog import Engine


def test_csv_glob_dialect(spark, tmp_path):
    (tmp_path / "warehouse1").write_text('1|"a|b"|2020-01-02 03:04:05\n2||\n')
    (tmp_path / "warehouse2").write_text('3|"say ""hi""\nthere"|2021-01-01 00:00:00\n')
    engine = Engine(spark)
    table = engine.create_table("warehouse", [("warehouse_id", "int"), ("warehouse_name", "text"), ("warehouse_created", "timestamp")], base_dir=str(tmp_path), options={"table_name": "warehouse*", "fmt": "csv", "csv_delimiter": "|"})
    rows = {r.warehouse_id: r for r in table.rows()}
    assert rows[1].warehouse_name == "a|b" and rows[1].warehouse_created == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert rows[2].warehouse_name is None and rows[2].warehouse_created is None
    assert rows[3].warehouse_name == 'say "hi"\nthere'
    assert engine.sql("SELECT count(*) AS n FROM warehouse WHERE warehouse_id > :k", {"k": 1}).first().n == 2


def test_csv_nullstr_and_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,flag,tags,v,price,t,d\n1,t,"{a,NULL,c}","[1,2,3]",1.50,10:20:30,2020-02-29\n2,NA,{},NA,NA,NA,NA\n3,false,NA,"{0,0,1}",-2.25,00:00:01,1999-12-31\n')
    columns = [("id", "int8"), ("flag", "bool"), ("tags", "text[]"), ("v", "vector(3)"), ("price", "numeric(10,2)"), ("t", "time"), ("d", "date")]
    df = Engine(spark).create_table("t_types", columns, base_dir=str(tmp_path), options={"fmt": "csv", "table_name": "t.csv", "csv_header": "true", "csv_nullstr": "NA"}).df
    one, two, three = df.withColumn("t", F.col("t").cast("string")).orderBy("id").collect()
    assert (one.flag, one.tags, one.v, one.price, one.t, one.d) == (True, ["a", None, "c"], [1.0, 2.0, 3.0], Decimal("1.50"), "10:20:30", dt.date(2020, 2, 29))
    assert (two.flag, two.tags, two.v, two.price, two.t, two.d) == (None, [], None, None, None, None)
    assert three.flag is False and three.v == [0.0, 0.0, 1.0]


def test_empty_text_is_not_nullstr(spark, tmp_path):
    (tmp_path / "e.csv").write_text("1,\n2,NA\n")
    df = Engine(spark).create_table("t_empty", [("id", "int4"), ("x", "text")], base_dir=str(tmp_path), options={"fmt": "csv", "table_name": "e.csv", "csv_nullstr": "NA"}).df
    assert [r.x for r in df.orderBy("id").collect()] == ["", None]


def test_csv_splits_without_multiline(spark, tmp_path):
    (tmp_path / "s.csv").write_text("".join(f"{i},x\n" for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        make = lambda name, multiline: Engine(spark).create_table(name, [("id", "int4"), ("x", "text")], base_dir=str(tmp_path), options={"fmt": "csv", "table_name": "s.csv"}, multiline=multiline).df
        whole, split = make("t_whole", True), make("t_split", False)
        assert whole.agg(F.sum("id")).first() == split.agg(F.sum("id")).first()
        parts = lambda df: df.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts(whole) == 1 < parts(split)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_rename_and_declared_type(spark, tmp_path):
    spark.range(3).select(F.col("id").cast("int").alias("C 1"), F.lit("x").alias("c2")).write.parquet(str(tmp_path / "p.parquet"))
    engine = Engine(spark)
    table = engine.create_table("t_renamed", [("c1", "int8", {"column_name": "C 1"}), ("c2", "text")], base_dir=str(tmp_path), options={"fmt": "parquet", "table_name": "p.parquet"})
    assert table.df.dtypes == [("c1", "bigint"), ("c2", "string")]
    assert table.schema_text == "C 1:int64\nc2:string\n"
    with pytest.raises(ValueError, match="no column"):
        engine.create_table("t_bad", [("zz", "int8")], base_dir=str(tmp_path), options={"fmt": "parquet", "table_name": "p.parquet"})


def test_missing_fmt_and_duplicates(spark):
    engine = Engine(spark)
    with pytest.raises(ValueError, match="fmt is not specified"):
        engine.create_table("x", [("a", "int4")])
    with pytest.raises(ValueError, match="twice"):
        engine.create_table("x", [("a", "int4"), ("A", "int4")], options={"fmt": "csv"})
    engine.create_server("s", {"extensions": "vector"})
    with pytest.raises(ValueError, match="exists"):
        engine.create_server("s")


def test_vector_dimensions_are_checked(spark, tmp_path):
    spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>").write.parquet(str(tmp_path / "v.parquet"))
    df = Engine(spark).create_table("t_vec", [("v", "vector(3)")], base_dir=str(tmp_path), options={"fmt": "parquet", "table_name": "v.parquet"}).df
    with pytest.raises(Exception, match="expected 3 dimensions"):
        df.collect()


def test_options_never_change_results(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "r.parquet"))
    engine = Engine(spark)
    for fragments in ("1", "4", "16"):
        server = engine.create_server(f"s{fragments}", {"fragcnt": fragments, "fetch_size": "7"})
        df = engine.create_table(f"t{fragments}", [("id", "int8")], server, str(tmp_path), {"fmt": "parquet", "table_name": "r.parquet"}).df
        assert df.agg(F.sum("id")).first()[0] == 499500


def test_pushdown_report_and_functions(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 3).alias("k"), F.lit("x").alias("w")).write.parquet(str(tmp_path / "q.parquet"))
    engine = Engine(spark)
    engine.create_table("q", [("id", "int8"), ("k", "int8"), ("w", "text")], base_dir=str(tmp_path), options={"fmt": "parquet", "table_name": "q.parquet"})
    found = engine.explain_pushdown(engine.sql("SELECT k, sum(id) AS s FROM q WHERE id > 10 GROUP BY k"))
    assert "GreaterThan(id,10)" in found.filters[0] and "w:" not in found.columns[0] and found.partial_aggregate and found.exchanges >= 1
    engine.register_function("plus_two", lambda x: x + 2, "long", "mine")
    assert engine.sql("SELECT plus_two(5) AS x").first().x == 7
    assert engine.is_pushable("plus_two", engine.create_server("e", {"extensions": "mine,vector"})) and not engine.is_pushable("plus_two", engine.create_server("f"))
    stats = engine.analyze("q", sample=10, seed=3)
    assert stats.rows == 100 and stats.pages == 1 and stats.sample.count() <= 10
    assert [t.name for t in engine.import_directory(str(tmp_path), ["q"])] == ["q"]
