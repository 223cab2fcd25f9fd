"""End to end: scenario CSVs derived from the driver's events -> prepare -> train -> evaluate."""

import os

import pytest
from pyspark.sql import functions as F

from scenaria.plans import views
from scenaria.plans.evaluate import evaluate
from scenaria.plans.prepare import PrepareConfig, prepare
from scenaria.plans.train import train
from scenaria.sources import io

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_prepare_train_evaluate(spark, tmp_path):
    s = views.series(spark, SF).where(F.col("scenario_id") < 12)
    for sid in [r.scenario_id for r in s.select("scenario_id").distinct().collect()]:
        s.where(F.col("scenario_id") == sid).select("Time", "f1", "f2", "A_label", "B_label", "C_label") \
            .coalesce(1).write.option("header", True).csv(str(tmp_path / "in" / f"sc{sid}.csv"))
    df, roles = io.read_scenarios(spark, str(tmp_path / "in"))
    df = df.withColumn("rid", F.monotonically_increasing_id())
    from scenaria.roles import Roles
    roles = Roles(key="scenario_id", time="Time", features=roles.features, labels=roles.labels, tie="rid")
    p = prepare(df, roles, PrepareConfig(primary="C_label", seq_len=5, train_step=3, eval_starts=4),
                out=str(tmp_path / "prep"))
    t = p["table"]
    assert t.count() == df.count()
    assert {r.split for r in p["split"].collect()} <= {"train", "val", "test"}
    counts = p["balanced"].groupBy("A_label").count().collect()
    assert len({r["count"] for r in counts}) == 1          # every class raised to the majority
    x_roles = p["roles"]
    m = train(t, p["sequences"], x_roles, ["f1", "f2"], seq_len=5, n_trees=5, cv=False, out=str(tmp_path / "models"),
              balanced=p["balanced"])
    ev = evaluate(t, p["sequences"], x_roles, ["f1", "f2"], m["trees"], m["sequence"], m["weights"], seq_len=5,
                  out=str(tmp_path / "reports"), optimised=m["optimised"])
    comp = {r.label: r for r in ev["comparison"].collect()}
    assert "overall" in comp and comp["overall"].tree is not None
    assert comp["overall"].blend is not None and comp["overall"].best_model != "N/A"
    assert ev["reports"].where("cls = 'accuracy'").count() == 3 * 3
    assert m["validation"].count() > 0
    again = evaluate(t, p["sequences"], x_roles, ["f1", "f2"], m["trees"], m["sequence"], m["weights"], seq_len=5,
                     earlier=io.read_report(spark, str(tmp_path / "reports" / "comparison")))
    assert {r.before_tree == r.tree for r in again["change"].where("label = 'overall'").collect()} <= {True, False}
