from pyspark.sql import functions as F

from scenaria.functions import combo_ints, combo_key
from scenaria.operators import clean, metrics, sequences, stats
from scenaria.sources import io


def test_keyless_windows_cover_whole_table(spark):
    df = spark.createDataFrame([(float(i), i % 6) for i in range(50)], "t double, y int")
    out = sequences.keyless(df, ["t"], 20, 15)
    assert out.select("seq_id").distinct().count() == 3 and out.count() == 60


def test_combo_key_round_trip(spark):
    df = spark.createDataFrame([(1, 0, 5)], "a int, b int, c int")
    r = df.select(*combo_ints(combo_key(["a", "b", "c"]), 3)).first()
    assert tuple(r) == (1, 0, 5)


def test_min_class_count_and_union(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 2)], "a int, b int")
    got = {r.label: r.min_n for r in stats.min_class_count(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 1}
    u = stats.class_union(stats.long_labels(df, ["a"]), stats.long_labels(df, ["b"]))
    assert u.count() == 4


def test_null_total_and_epoch_mean(spark):
    df = spark.createDataFrame([(None, 1.0), (2, None)], "a int, b double")
    assert clean.null_total(df).first().null_total == 2
    h = spark.createDataFrame([(1, "x", 0.5), (1, "y", 0.7)], "epoch int, output string, value double")
    assert abs(metrics.epoch_mean(h).first().value - 0.6) < 1e-12


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.5)], "label string, accuracy double")
    io.write_report(df, str(tmp_path / "r"))
    back = io.read_report(spark, str(tmp_path / "r"), "label string, accuracy double")
    assert back.first().accuracy == 0.5
    assert io.read_report(spark, str(tmp_path / "missing")) is None
