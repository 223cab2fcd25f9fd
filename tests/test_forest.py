import math

import pytest
from pyspark.sql import functions as F

from scenaria.operators import forest, model


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(3000).select("id", *[(F.xxhash64("id", F.lit(i)) % 1000 / 100.0).alias(f"x{i}") for i in range(5)])
    base = base.withColumn("x3", F.when(F.col("id") % 11 == 0, F.lit(math.nan)).otherwise(F.floor("x3"))).withColumn(
        "x4", F.when(F.col("id") % 13 != 0, F.col("x4")))
    y = F.floor(F.abs(F.col("x0") + F.col("x1") * F.col("x2") / 5)) % 5
    return base.select("*", (F.when(y == 3, 7).otherwise(y)).cast("int").alias("many"), (F.col("x0") > F.col("x1")).cast("int").alias("two"),
                       F.lit(4).alias("one"), F.array("x0", "x1", "x2").alias("v"))


FEATURES = [f"x{i}" for i in range(5)]


def whole(rows):
    """What a fit takes: no missing values."""
    return rows.select(*[F.coalesce(F.nanvl(c, F.lit(None)), F.lit(-1.0)).alias(c) if c in FEATURES else c for c in rows.columns])


def compare(spark, models, rows, features):
    assert forest.flatten(spark, models) is not None
    a = {(r.row_id, r.label): r for r in model.score(models, rows, features, "id").collect()}
    b = {(r.row_id, r.label): r for r in model.score(models, rows, features, "id", flat=False).collect()}
    assert a.keys() == b.keys() and len(a) == rows.count() * len(models)
    for k, x in a.items():
        assert (x.y_pred, x.y_true, len(x.p)) == (b[k].y_pred, b[k].y_true, len(b[k].p))
        assert all(math.isclose(p, q, rel_tol=1e-12, abs_tol=1e-15) for p, q in zip(x.p, b[k].p, strict=True))


@pytest.mark.parametrize("depth", [0, 3, 5, 9])
def test_flat_scores_equal_transform(spark, rows, depth):
    """Forests and boosters, with null and NaN features, and trees of more than 64 leaves."""
    models = model.fit_per_label(whole(rows), FEATURES, ["many", "two", "one"], max_depth=depth, n_trees=7)
    compare(spark, models, rows, FEATURES)


def test_one_booster_per_class_and_array_features(spark, rows):
    models = model.fit_per_label(whole(rows), FEATURES, ["many"], boosted=True, max_depth=2, n_trees=3)
    compare(spark, models, rows, FEATURES)
    models = model.fit_per_label(rows, ["v"], ["many", "two"], max_depth=4, n_trees=5)
    compare(spark, models, rows, ["v"])


def test_stored_models_are_flattened_and_no_rows_score_nothing(spark, rows, tmp_path):
    models = model.fit_per_label(whole(rows), FEATURES, ["many"], max_depth=3, n_trees=3)
    model.save(models, str(tmp_path / "m"))
    loaded = model.load(str(tmp_path / "m"), ["many"])
    compare(spark, loaded, rows, FEATURES)
    assert model.score(loaded, rows.where("id < 0"), FEATURES, "id").collect() == []
    assert forest.flatten(spark, {"many": object()}) is None
