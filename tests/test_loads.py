"""Files that are loaded once, rejected rows, and rows counted as they are written."""

from pyspark.sql import types as T

from matchloom.plans.pipeline import resolve_to_tables
from matchloom.sources import tables

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])


def test_files_load_once(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    (tmp_path / "a.csv").write_text('id,name,day\n1,"x, y",2024-01-01\nnot a number,z,2024-01-02\n2, b ,\n3,c\n')
    (tmp_path / "b.csv").write_text("NAME,extra,ID\nq,1,4\nr,2,5,6\n")
    (tmp_path / "empty.csv").write_text("id,name,day\n")
    load = lambda: tables.load_files(spark, f"file://{tmp_path}/*.csv", SCHEMA, "loads.people")
    assert load() == {"files": 3, "rows": 3, "rejected": 3}
    assert load() == {"files": 0, "rows": 0, "rejected": 0}
    rows = sorted((r.id, r.name, str(r.day)) for r in spark.table("loads.people").collect())
    assert rows == [(1, "x, y", "2024-01-01"), (2, "b", "None"), (4, "q", "None")]
    bad = sorted((r.file.rpartition("/")[2], r.line, r.record) for r in spark.table("loads.people__rejected").collect())
    assert bad == [("a.csv", 3, "not a number,z,2024-01-02"), ("a.csv", 5, "3,c"), ("b.csv", 3, "r,2,5,6")]
    (tmp_path / "c.csv").write_text("id,name,day\n9,new,2024-05-05\n")
    assert load() == {"files": 1, "rows": 1, "rejected": 0}
    assert spark.table("loads.people").count() == 4 and spark.table("loads.people__loads").count() == 4


def test_rows_are_counted_as_they_are_written(spark):
    master = spark.createDataFrame([(f"Company {k}", f"c{k % 3}") for k in range(20)], "name string, city string")
    other = spark.createDataFrame([(f"company {k}", f"c{k % 3}") for k in range(0, 20, 2)], "name string, city string")
    counts: dict[str, int] = {}
    out = resolve_to_tables({"Master": master, "Other": other}, "counted", counts=counts)
    assert set(counts) == set(out) and all(counts[name] == df.count() for name, df in out.items())
    assert counts["metadata"] == 4
