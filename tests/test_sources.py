import os

import pytest

from scenaria.sources import io


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_read_two_scenarios_with_dotted_names(spark, tmp_path):
    write(tmp_path / "a.csv", "Time,f1,A_label\n0,1.5,1\n1,2.5,0\n")
    write(tmp_path / "b.v2.csv", "Time,f1,A_label\n0,3.5,2\n")
    df, roles = io.read_scenarios(spark, str(tmp_path))
    got = sorted((r.scenario_id, r.Time, r.f1, r.A_label) for r in df.collect())
    assert got == [("a", 0.0, 1.5, 1), ("a", 1.0, 2.5, 0), ("b.v2", 0.0, 3.5, 2)]
    assert roles.features == ("f1",) and roles.labels == ("A_label",)
    assert dict(df.dtypes)["A_label"] == "tinyint" and dict(df.dtypes)["f1"] == "float"
    df2, _ = io.read_scenarios(spark, str(tmp_path), first_dot=True)
    assert {r.scenario_id for r in df2.collect()} == {"a", "b"}


def test_files_are_united_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "Time,f1,f2,A_label\n0,1,2,1\n")
    write(tmp_path / "b.csv", "Time,f2,f1,A_label\n0,20,10,0\n")
    write(tmp_path / "c.csv", "A_label,Time,f3\n2,5,30\n")
    df, roles = io.read_scenarios(spark, str(tmp_path))
    got = {r.scenario_id: (r.Time, r.f1, r.f2, r.A_label, r.f3) for r in df.collect()}
    assert got == {"a": (0.0, 1.0, 2.0, 1, None), "b": (0.0, 10.0, 20.0, 0, None), "c": (5.0, None, None, 2, 30.0)}
    assert roles.features == ("f1", "f2", "f3")


def test_absent_and_broken_reports(spark, tmp_path):
    assert io.read_report(spark, str(tmp_path / "none")) is None
    (tmp_path / "dir").mkdir()
    with pytest.raises(Exception):
        io.read_report(spark, str(tmp_path / "dir"))


def test_roles_survive_parquet(spark, tmp_path):
    write(tmp_path / "a.csv", "Time,f1,A_label\n0,1.5,1\n")
    df, _ = io.read_scenarios(spark, str(tmp_path))
    out = str(tmp_path / "snap")
    io.write_snapshot(df.withColumn("split", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("train")), out)
    back = io.read_snapshot(spark, out, "train")
    r = io.roles_from_metadata(back)
    assert r.features == ("f1",) and r.labels == ("A_label",)


def test_bucketed_tables_are_read_without_a_shuffle(spark, tmp_path):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from scenaria.sources import io
    rows = spark.range(2000).select((F.col("id") % 23).alias("sid"), F.col("id").alias("t"), (F.xxhash64("id") % 1000).alias("x"))
    try:
        io.write_bucketed(rows, "bucketed_series", str(tmp_path / "b"), "sid", ["t"], 4)
        back = spark.table("bucketed_series")
        w = Window.partitionBy("sid").orderBy("t")
        out = back.withColumn("d", F.col("x") - F.lag("x").over(w)).join(back.groupBy("sid").agg(F.count(F.lit(1)).alias("n")), "sid")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        want = rows.withColumn("d", F.col("x") - F.lag("x").over(w)).agg(F.sum(F.hash("sid", "t", "d"))).first()[0]
        assert out.agg(F.sum(F.hash("sid", "t", "d"))).first()[0] == want and out.count() == 2000
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_series")
