"""Two-model probability blending, weight search and model comparison.

Probability tables are (row key..., label, y_true, p array<double>) per model.  Models are aligned
by an equi-join on the row key and label (J3); the weight search turns each joined row into the interval
of weights at which it is right and sweeps over the intervals' ends, for any grid or for none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.functions import argmax_cols, argmax_first, blend, blend_cols, renormalize


#: Blends this close may be ordered by rounding: values up to 1 carry errors of a few 2^-53.
TIE = 1e-13


def predict(p: Column) -> Column:
    """Class of a probability vector of any length, the lowest class on ties."""
    return argmax_first(p)


def predict_blend(p1: Column, p2: Column, w) -> Column:
    """F13 + T7: class of weight * p1 + (1 - weight) * p2, for vectors of any length."""
    return argmax_first(blend(p1, p2, w))


def n_classes(j: DataFrame, a: str = "p1", b: str = "p2") -> int:
    """The longest vector of either model (one aggregate row)."""
    return int(j.agg(F.max(F.greatest(F.size(a), F.size(b)))).first()[0] or 0)


def align(p1: DataFrame, p2: DataFrame, keys, a: str = "p1", b: str = "p2") -> DataFrame:
    """Row-by-row alignment of two models (inner equi-join on the row key)."""
    keys = list(keys)
    x = p1.select(*keys, "y_true", F.col("p").alias(a))
    y = p2.select(*keys, F.col("p").alias(b))
    return x.join(y, keys)


def truncate_common(j: DataFrame, a: str = "p1", b: str = "p2") -> DataFrame:
    """cut both vectors to the smaller class count and renormalise; a vector whose mass lies wholly in
    the cut classes stays all zero (its class is 0)."""
    k = F.least(F.size(a), F.size(b))
    j = j.withColumn(a, F.slice(a, 1, k)).withColumn(b, F.slice(b, 1, k))
    return j.withColumn(a, renormalize(F.col(a))).withColumn(b, renormalize(F.col(b)))


def blended(j: DataFrame, weight, a: str = "p1", b: str = "p2") -> DataFrame:
    """F13 + T7: weight * p1 + (1 - weight) * p2 and its class."""
    return j.withColumn("y_pred", predict_blend(F.col(a), F.col(b), weight))


def weight_grid(n_steps: int) -> list[float]:
    """n_steps + 1 evenly spaced weights in [0, 1]."""
    return [i / float(n_steps) for i in range(n_steps + 1)]


def _lines(j: DataFrame, by, a: str, b: str, n: int) -> DataFrame:
    """(by..., y, a, b, q<c>, d<c>): with weight w on the first model the truth's blend is above that of class c by
    q<c> + w * d<c>; null for the truth itself and for classes that a vector lacks.  SQL text: the expressions are
    unrolled over the classes, and thousands of column objects are slow to make."""
    x = j.select(*by, F.col("y_true").cast("int").alias("y"), F.col(a).alias("a"), F.col(b).alias("b"))
    x = x.selectExpr("*", "get(a, CASE WHEN y >= 0 THEN y END) AS ya", "get(b, CASE WHEN y >= 0 THEN y END) AS yb")
    x = x.selectExpr("*", *[f"CASE WHEN y <> {c} THEN yb - get(b, {c}) END AS q{c}" for c in range(n)])
    return x.selectExpr("*", *[f"ya - get(a, {c}) - q{c} AS d{c}" for c in range(n)])


def _range(n: int, margin: float) -> tuple[str, str]:
    """SQL of the weights in [0, 1] at which the truth is above every other class by ``margin`` or more (from, to)."""
    m = f"{margin!r}D"
    lo = [f"CASE WHEN d{c} > 0 THEN try_divide({m} - q{c}, d{c}) WHEN d{c} = 0 AND q{c} < {m} THEN double('infinity') ELSE 0D END" for c in range(n)]
    hi = [f"CASE WHEN d{c} < 0 THEN try_divide({m} - q{c}, d{c}) ELSE 1D END" for c in range(n)]
    return f"greatest(0D, {', '.join(lo)})", f"least(1D, {', '.join(hi)})"


def grid_counts(j: DataFrame, n_steps: int = D.WEIGHT_STEPS, by=("label",), a: str = "p1", b: str = "p2",
                n: int | None = None) -> DataFrame:
    """One row per label: rows (``_n``), hits of each model alone (``_first``, ``_second``) and hits of
    the blend at every weight of the grid (``_c<i>`` for weight i / n_steps).

    A class's blend is a line in the weight, so a row is right on one interval of weights, where the truth's line is
    on the upper envelope.  Rows are counted by the grid weights between which their interval lies (map-side, no
    copy of a row is made); only the counts meet the grid.  Weights at which lines are so close that rounding may
    decide (within ``TIE``) are evaluated as they are blended, so ties fall as they do there.  Expressions are
    unrolled over ``n`` classes, the longest vector if not given."""
    by = list(by)
    n = max(1, n_classes(j, a, b) if n is None else n)
    ranges = zip(("lo", "hi", "least", "most"), (*_range(n, TIE), *_range(n, -TIE)), strict=True)
    odd = " OR ".join(f"coalesce(isnan(d{c}), false)" for c in range(n))
    x = _lines(j, by, a, b, n).selectExpr("*", *[f"{v} AS r_{k}" for k, v in ranges], f"{odd} AS odd", "ya IS NOT NULL AND yb IS NOT NULL AS known")
    x = x.selectExpr(
        *by, "y", "a", "b",
        f"CASE WHEN known AND NOT odd AND r_lo <= r_hi AND r_lo <= 1 THEN CASE WHEN r_lo > 0 THEN cast(ceil(r_lo * {n_steps} + 1e-9D) AS int) ELSE 0 END END AS lo",
        f"CASE WHEN known AND NOT odd AND r_lo <= r_hi AND r_lo <= 1 THEN CASE WHEN r_hi < 1 THEN cast(floor(r_hi * {n_steps} - 1e-9D) AS int) ELSE {n_steps} END END AS hi",
        f"CASE WHEN odd THEN 0 WHEN known AND r_least <= r_most THEN greatest(cast(ceil(least(r_least, 2D) * {n_steps} - 1e-9D) AS int), 0) END AS least",
        f"CASE WHEN odd THEN {n_steps} WHEN known AND r_least <= r_most THEN least(cast(floor(r_most * {n_steps} + 1e-9D) AS int), {n_steps}) END AS most")
    x = x.selectExpr(*by, "y", "a", "b", "least", "most", "CASE WHEN lo <= hi THEN lo END AS lo", "CASE WHEN lo <= hi THEN hi END AS hi")
    alone = lambda c: F.coalesce(argmax_cols([F.get(c, F.lit(i)) for i in range(n)]) == F.col("y"), F.lit(False))
    weights = F.array(*[F.lit(w) for w in weight_grid(n_steps)])
    hit = lambda i: F.coalesce(argmax_cols(blend_cols(F.col("a"), F.col("b"), F.get(weights, i), n)) == F.col("y"), F.lit(False))
    sure = lambda i: F.coalesce((i >= F.col("lo")) & (i <= F.col("hi")), F.lit(False))
    tried = F.when(F.expr("least <= most AND NOT (least <=> lo AND most <=> hi)"),
                   F.filter(F.sequence("least", "most"), lambda i: ~sure(i) & hit(i)))
    x = x.select(*by, "lo", "hi", tried.alias("tried"), alone(F.col("a")).alias("f"), alone(F.col("b")).alias("s"))
    x = x.groupBy(*by, "lo", "hi", "tried", "f", "s").agg(F.count(F.lit(1)).alias("k"))
    on = [f"sum(CASE WHEN coalesce(lo <= {i} AND {i} <= hi, false) OR coalesce(array_contains(tried, {i}), false) THEN k ELSE 0L END) AS _c{i}"
          for i in range(n_steps + 1)]
    return x.groupBy(*by).agg(F.sum("k").alias("_n"), F.expr("sum(CASE WHEN f THEN k ELSE 0L END) AS _first"),
                              F.expr("sum(CASE WHEN s THEN k ELSE 0L END) AS _second"), *[F.expr(e) for e in on])


def exact_weight(j: DataFrame, by=("label",), a: str = "p1", b: str = "p2", n: int | None = None, default: float = D.DEFAULT_WEIGHT,
                 pieces: int = 4096) -> DataFrame:
    """M7 without a grid: (by..., weight, upto, hits, accuracy) of the first interval of weights in [0, 1] with the most
    hits.  ``weight`` is its beginning, or its middle where it begins behind a weight of fewer hits; ``upto`` its end.

    Every row enters at the lower end of its interval and leaves at the upper one; at an end where the truth ties
    with a lower class it is not yet, or no longer, right.  Ends are collapsed to one row per distinct weight,
    then swept in ``pieces`` of [0, 1] with the sums of the pieces before, so no label is one task."""
    by = list(by)
    n = max(1, n_classes(j, a, b) if n is None else n)
    lo, hi = _range(n, 0.0)
    x = _lines(j, by, a, b, n).selectExpr("*", f"{lo} AS lo", f"{hi} AS hi")
    open_lo, open_hi = (" OR ".join(f"coalesce(y > {c} AND d{c} {sign} 0 AND try_divide(-q{c}, d{c}) = {at}, false)" for c in range(n))
                        for sign, at in ((">", "lo"), ("<", "hi")))
    never = " OR ".join(f"coalesce(y > {c} AND d{c} = 0 AND q{c} = 0, false)" for c in range(n))
    x = x.selectExpr(*by, "lo", "hi", f"cast({open_lo} AS int) AS ol", f"cast({open_hi} AS int) AS oh",
                     f"ya IS NOT NULL AND yb IS NOT NULL AND NOT ({never}) AS ever")
    right = "ever AND lo <= 1 AND (lo < hi OR (lo = hi AND ol + oh = 0))"
    # rows that are never right leave through an empty array: a filter would be moved below all these expressions
    ends = x.selectExpr(*by, f"explode(CASE WHEN {right} THEN array(named_struct('w', lo, 'side', ol, 'h', 1L), named_struct('w', hi, 'side', 1 - oh, 'h', -1L)) "
                             "ELSE array(named_struct('w', cast(NULL AS double), 'side', 0, 'h', 0L)) END) AS e").select(*by, "e.*")
    ends = ends.groupBy(*by, "w", "side").agg(F.sum("h").alias("h"), F.count(F.lit(1)).alias("k")).withColumn("piece", F.floor(F.col("w") * pieces))
    rows = ends.groupBy(*by).agg(F.sum(F.expr("CASE WHEN w IS NULL THEN 2 * k ELSE k END")).alias("k2"))
    ends = ends.where("w is not null")
    sums = ends.groupBy(*by, "piece").agg(F.sum("h").alias("_s"), F.min("w").alias("_first"))
    w = Window.partitionBy(*by).orderBy("piece")
    sums = sums.select(*by, "piece", F.coalesce(F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                       F.lead("_first").over(w).alias("_after"))
    inside = Window.partitionBy(*by, "piece").orderBy("w", "side")
    swept = ends.join(sums, [*by, "piece"]).select(*by, "w", "side", (F.sum("h").over(inside) + F.col("_before")).alias("hits"),
                                                   F.coalesce(F.lead("w").over(inside), F.col("_after"), F.lit(1.0)).alias("upto"))
    best = swept.groupBy(*by).agg(F.min(F.struct((-F.col("hits")).alias("m"), F.col("w"), F.col("side"), F.col("upto"))).alias("_b"))
    ok = F.coalesce(F.col("_b.m") < 0, F.lit(False))
    start = F.when(F.col("_b.side") == 0, F.col("_b.w")).otherwise((F.col("_b.w") + F.col("_b.upto")) / 2)
    return rows.join(best, by, "left").select(
        *by, F.when(ok, start).otherwise(F.lit(default)).alias("weight"), F.when(ok, F.col("_b.upto")).otherwise(F.lit(default)).alias("upto"),
        F.when(ok, -F.col("_b.m")).otherwise(F.lit(0)).cast("long").alias("hits"),
        F.when(ok, -F.col("_b.m") / (F.col("k2") / 2)).otherwise(F.lit(0.0)).alias("accuracy"))


def curve_from_counts(g: DataFrame, n_steps: int, grid_steps: int = 20, by=("label",)) -> DataFrame:
    """The accuracy curve of an ``n_steps`` grid read off a finer ``grid_steps`` count table
    (``grid_steps`` must be a multiple of ``n_steps``: i / n == (i * r) / (n * r) exactly)."""
    r = grid_steps // n_steps
    ws = weight_grid(n_steps)
    return g.select(*by, F.explode(F.array(*[F.struct(F.lit(w).alias("weight"), (F.col(f"_c{i * r}") / F.col("_n"))
                                                      .alias("accuracy")) for i, w in enumerate(ws)])).alias("t")) \
        .select(*by, "t.weight", "t.accuracy")


def weight_curve(j: DataFrame, n_steps: int = D.WEIGHT_STEPS, by=("label",), a: str = "p1", b: str = "p2",
                 n: int | None = None) -> DataFrame:
    """M6/M7: accuracy of the blend at each weight of the grid: (by..., weight, accuracy)."""
    return curve_from_counts(grid_counts(j, n_steps, by, a, b, n), n_steps, n_steps, by)


def best_weight(curve: DataFrame, by=("label",), default: float = D.DEFAULT_WEIGHT) -> DataFrame:
    """The lowest weight reaching the highest accuracy; ``default`` if nothing beats 0."""
    best = curve.groupBy(*by).agg(F.min(F.struct((-F.col("accuracy")).alias("na"), F.col("weight").alias("w"))).alias("b"))
    ok = -F.col("b.na") > 0
    return best.select(*by, F.when(ok, F.col("b.w")).otherwise(F.lit(default)).alias("weight"),
                       F.when(ok, -F.col("b.na")).otherwise(F.lit(0.0)).alias("accuracy"))


def single_class(j: DataFrame, by=("label",)) -> DataFrame:
    """A13 for the search: is the truth of a label of more than one class?"""
    return j.groupBy(*by).agg((F.countDistinct("y_true") > 1).alias("reliable"))


def tuned_weight(j: DataFrame, n_steps: int = D.WEIGHT_STEPS, by=("label",), default: float = D.DEFAULT_WEIGHT) -> DataFrame:
    """M7: the best weight of the grid per label; ``default`` where the truth has a single class, for then the
    search says nothing."""
    best = best_weight(weight_curve(j, n_steps, by), by, default)
    weight = F.when(F.col("reliable"), F.col("weight")).otherwise(F.lit(default))
    return best.join(single_class(j, by), list(by)).select(*by, weight.alias("weight"), "accuracy")


def before_after(earlier: DataFrame | None, now: DataFrame, by: str = "label") -> DataFrame:
    """An earlier comparison's columns (as ``before_<model>``) beside the present ones, by label; without an
    earlier report, or a label in it, they are null."""
    models = [c for c in now.columns if c != by]
    names = {m: f"before_{m}" for m in models}
    if earlier is None:
        old = now.select(by, *[F.lit(None).cast("double").alias(names[m]) for m in models])
    else:
        old = earlier.select(by, *[(F.col(m) if m in earlier.columns else F.lit(None)).cast("double").alias(names[m]) for m in models])
    out = now.join(old, by, "left")
    return out.select(by, *[c for m in models for c in (F.col(names[m]), F.col(m), (F.col(m) - F.col(names[m])).alias(f"gain_{m}"))])


def accuracy_at(j: DataFrame, weights: DataFrame, by=("label",), default: float = D.DEFAULT_WEIGHT,
                a: str = "p1", b: str = "p2") -> DataFrame:
    """Accuracy of the blend with a per-label weight (J4: missing weight -> default)."""
    jw = j.join(weights.select(*by, F.col("weight").alias("_w")), list(by), "left")
    w = F.coalesce(F.col("_w"), F.lit(default))
    ok = (predict_blend(F.col(a), F.col(b), w) == F.col("y_true")).cast("double")
    return jw.groupBy(*by).agg(F.avg(ok).alias("accuracy"))


def mismatch(p1: DataFrame, p2: DataFrame, keys, weights: DataFrame | None = None, by=("label",),
             default: float = D.DEFAULT_WEIGHT) -> DataFrame:
    """J7 + M9: row counts of both models, rows present in both, the model chosen per label when the
    rows do not align (weight >= 0.5 picks the first), that model's real accuracy, and the accuracy of
    the blend over the aligned rows."""
    keys = list(keys)
    x = p1.select(*keys, "y_true", predict(F.col("p")).alias("y1"), F.col("p").alias("p1"))
    y = p2.select(*keys, F.col("y_true").alias("y_true2"), predict(F.col("p")).alias("y2"), F.col("p").alias("p2"))
    fo = x.join(y, keys, "full_outer")
    agg = fo.groupBy(*by).agg(
        F.count("y1").alias("n_first"), F.count("y2").alias("n_second"),
        F.count(F.when(F.col("y1").isNotNull() & F.col("y2").isNotNull(), 1)).alias("n_aligned"),
        F.avg(F.when(F.col("y1").isNotNull(), (F.col("y1") == F.col("y_true")).cast("double"))).alias("acc_first"),
        F.avg(F.when(F.col("y2").isNotNull(), (F.col("y2") == F.col("y_true2")).cast("double"))).alias("acc_second"),
        F.avg(F.when(F.col("y1").isNotNull() & F.col("y2").isNotNull(),
                     (predict_blend(F.col("p1"), F.col("p2"), default) == F.col("y_true")).cast("double")))
        .alias("acc_aligned"))
    if weights is not None:
        agg = agg.join(weights.select(*by, F.col("weight").alias("_w")), list(by), "left")
        w = F.coalesce(F.col("_w"), F.lit(default))
    else:
        w = F.lit(default)
    first = w >= 0.5
    return agg.select(*by, "n_first", "n_second", "n_aligned",
                      (F.col("n_first") != F.col("n_second")).alias("mismatch"),
                      F.when(first, "first").otherwise("second").alias("chosen"),
                      F.when(first, F.col("acc_first")).otherwise(F.col("acc_second")).alias("acc_chosen"),
                      "acc_aligned")


def best_model(table: DataFrame, models, by: str = "label") -> DataFrame:
    """Per row the model with the highest accuracy (first on ties); 'N/A' if any is missing."""
    models = list(models)
    arr = F.array(*[F.col(m) for m in models])
    names = F.array(*[F.lit(m) for m in models])
    any_null = F.exists(arr, lambda x: x.isNull())
    return table.withColumn("best_model", F.when(any_null, F.lit("N/A"))
                            .otherwise(F.element_at(names, F.array_position(arr, F.array_max(arr)).cast("int"))))


def comparison(acc_long: DataFrame, models, overall: DataFrame | None = None) -> DataFrame:
    """Label x model accuracy table (missing -> null), plus an optional 'overall' row."""
    models = list(models)
    t = acc_long.groupBy("label").pivot("model", models).agg(F.first("accuracy"))
    if overall is not None:
        o = overall.groupBy().pivot("model", models).agg(F.first("accuracy")).select(F.lit("overall").alias("label"), *models)
        t = t.unionByName(o)
    return t


def blend_improves(table: DataFrame, a: str, b: str, blend_col: str) -> DataFrame:
    """Blend better than both single models."""
    return table.withColumn("blend_improves", F.col(blend_col) > F.greatest(F.col(a), F.col(b)))
