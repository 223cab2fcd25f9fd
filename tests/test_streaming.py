from scenaria.streaming import append_to_snapshot, scenario_stream


def test_stream_appends_scenario_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("Time,f1,A_label\n0,1.5,1\n1,2.5,0\n")
    (src / "b.csv").write_text("Time,f1,A_label\n0,3.5,2\n")
    q = append_to_snapshot(scenario_stream(spark, str(src)), str(tmp_path / "snap"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = sorted((r.scenario_id, r.Time) for r in spark.read.parquet(str(tmp_path / "snap")).collect())
    assert got == [("a", 0.0), ("a", 1.0), ("b", 0.0)]
