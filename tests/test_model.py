import os

import pytest
from pyspark.sql import functions as F

from scenaria.operators import model
from scenaria.plans import views

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_cv_save_load_and_score(spark, tmp_path):
    e = views.table(spark, SF, "embeddings")
    best, table = model.cross_validate(e, ["embedding"], "label", depths=(2, 3), folds=2, n_trees=5)
    assert sorted(r.max_depth for r in table.collect()) == [2, 3]
    model.save({"label": best}, str(tmp_path / "store"))
    loaded = model.load(str(tmp_path / "store"), ["label", "absent_label"])
    assert set(loaded) == {"label"}                         # a missing model is absent, not an error
    s = model.score(loaded, e, ["embedding"], "vec_id")
    r = s.agg(F.count("*").alias("n"), F.min(F.size("p")).alias("k")).first()
    assert r.n == e.count()                                  # one long row per input row and label
    assert r.k == e.agg(F.max("label")).first()[0] + 1       # one probability per class


def test_tree_fits_read_few_partitions(spark, monkeypatch):
    """A fit shuffles counts by node from every partition: few rows are few partitions, however they come."""
    seen = []
    fit = model.RandomForestClassifier.fit
    monkeypatch.setattr(model.RandomForestClassifier, "fit", lambda self, x, *a: (seen.append(x.rdd.getNumPartitions()), fit(self, x, *a))[1])
    rows = spark.range(0, 400, 1, 16).select("id", *[(F.xxhash64("id", F.lit(i)) % 100 / 10.0).alias(f"x{i}") for i in range(3)],
                                             (F.col("id") % 3).cast("int").alias("y"))
    assert rows.rdd.getNumPartitions() == 16
    model.fit_per_label(rows, ["x0", "x1", "x2"], ["y"], max_depth=2, n_trees=2)
    for id_col in (None, "id"):
        _best, table = model.cross_validate(rows, ["x0", "x1", "x2"], "y", depths=(1, 2), folds=3, n_trees=2, id_col=id_col)
        assert [r.max_depth for r in table.collect()] == [1, 2]
        assert all(0 <= r.accuracy <= 1 for r in table.collect())
    assert len(seen) == 1 + 2 * (2 * 3 + 1)  # every depth in every fold, and the best on all rows
    assert max(seen) <= model.FIT_PARTS


def test_own_folds_without_rows_are_refused(spark):
    rows = spark.range(6).select(F.lit(1).alias("id"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    with pytest.raises(ValueError, match="folds"):
        model.cross_validate(rows, ["x"], "y", depths=(1,), folds=3, n_trees=1, id_col="id")
