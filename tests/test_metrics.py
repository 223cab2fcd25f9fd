import pytest

from scenaria.operators import ensemble, metrics


def fwp_predictions(spark):
    """Rebuilds the published FWP sequence report: supports 40/30/10/10/30/20, 40 hits of 140."""
    plan = {0: [(0, 37), (2, 3)], 1: [(1, 2), (0, 28)], 2: [(0, 10)], 3: [(0, 10)], 4: [(0, 29), (2, 1)],
            5: [(5, 1), (0, 19)]}
    rows, i = [], 0
    for t, preds in plan.items():
        for p, n in preds:
            for _ in range(n):
                rows.append(("seq", "FWP_label", i, t, p))
                i += 1
    return spark.createDataFrame(rows, "model string, label string, row_id long, y_true int, y_pred int")


def test_class_report_matches_published_csv(spark):
    r = {x.cls: x for x in metrics.class_report(fwp_predictions(spark)).collect()}
    assert r["0"].precision == pytest.approx(0.2781954887218045) and r["0"].recall == pytest.approx(0.925)
    assert r["0"].f1_score == pytest.approx(0.4277456647398844)
    assert r["1"].precision == 1.0 and r["5"].f1_score == pytest.approx(0.09523809523809523)
    assert r["accuracy"].precision == pytest.approx(0.2857142857142857)
    assert r["macro avg"].precision == pytest.approx(0.37969924812030076)
    assert r["macro avg"].recall == pytest.approx(0.17361111111111113)
    assert r["macro avg"].f1_score == pytest.approx(0.10799729332966328)
    assert r["weighted avg"].precision == pytest.approx(0.43662728249194416)
    assert r["weighted avg"].f1_score == pytest.approx(0.16260420353112343)
    assert r["weighted avg"].support == 140.0


def test_pooled_vs_macro(spark):
    rows = [("m", "a", 0, 1, 1), ("m", "a", 1, 1, 0), ("m", "b", 2, 0, 0), ("m", "b", 3, 0, 0),
            ("m", "b", 4, 0, 0), ("m", "b", 5, 0, 0)]
    p = spark.createDataFrame(rows, "model string, label string, row_id long, y_true int, y_pred int")
    assert metrics.pooled_accuracy(p).first().accuracy == pytest.approx(5 / 6)
    assert metrics.macro_accuracy(p).first().accuracy == pytest.approx(0.75)


def test_confusion_sets(spark):
    rows = [("m", "a", 0, 0, 0), ("m", "a", 1, 1, 2), ("m", "a", 2, 1, 1)]
    p = spark.createDataFrame(rows, "model string, label string, row_id long, y_true int, y_pred int")
    assert metrics.confusion(p, union=False).count() == 4
    assert metrics.confusion(p, union=True).count() == 9


def test_best_weight_lowest_on_tie_and_default(spark):
    c = spark.createDataFrame([("a", 0.0, 0.5), ("a", 0.3, 0.7), ("a", 0.6, 0.7), ("b", 0.0, 0.0), ("b", 1.0, 0.0)],
                              "label string, weight double, accuracy double")
    got = {r.label: r.weight for r in ensemble.best_weight(c).collect()}
    assert got == {"a": 0.3, "b": 0.5}


def test_best_model_na(spark):
    t = spark.createDataFrame([("a", 0.5, 0.7, 0.7), ("b", 0.5, None, 0.1)], "label string, t double, s double, h double")
    got = {r.label: r.best_model for r in ensemble.best_model(t, ["t", "s", "h"]).collect()}
    assert got == {"a": "s", "b": "N/A"}
