"""Mixing sources to target weights, as a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to.  The flow routes the token capacity of
each pattern to the quotas of its sources; every further repetition of a pattern costs one more than the
one before, so repetitions are spread as evenly as the quotas allow.  The pattern table alone goes to the
driver (one row per distinct membership set; more than ``max_patterns`` is an error, never a cut).  Inside
a pattern, every document is taken as often as whole rounds fit, and a seeded order decides which ones
are taken once more, passing over those that no longer fit.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, written

BUCKET_BITS = 12


def word_count(text):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def share(sizes: dict[str, int], weights: tuple[float, ...], total: float, most: float) -> dict[str, float]:
    """Target per source: ``total`` shared by cyclic ``weights`` in key order, none above ``most`` times its
    size; what is cut off is shared again by weight among the others."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    target: dict[str, float] = {}
    free, left = set(sizes), float(total)
    while free:
        per = left / sum(weight[s] for s in free)
        full = [s for s in sorted(free) if weight[s] * per > most * sizes[s]]
        if not full:
            target.update({s: weight[s] * per for s in free})
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.discard(s)
        left = max(left, 0.0)
    return target


def route(capacity: dict[tuple[str, ...], int], quota: dict[str, int], most: int) -> dict[tuple[str, ...], int]:
    """Tokens to take from each pattern: successive shortest paths, one arc per repetition round with the
    round's number as its cost.  Patterns that share no source are solved apart."""
    taken: dict[tuple[str, ...], int] = {}
    by_source = defaultdict(list)
    for p in capacity:
        for s in p:
            by_source[s].append(p)
    seen: set = set()
    for start in sorted(capacity):
        if start in seen:
            continue
        group, todo = [], [start]
        seen.add(start)
        while todo:
            p = todo.pop()
            group.append(p)
            for s in p:
                for q in by_source[s]:
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
        taken.update(_flow(sorted(group), capacity, quota, most))
    return taken


def _flow(patterns, capacity, quota, most):
    sources = sorted({s for p in patterns for s in p})
    at = {("p", p): i + 2 for i, p in enumerate(patterns)}
    at.update({("s", s): len(patterns) + 2 + i for i, s in enumerate(sources)})
    arcs: list[list] = [[] for _ in range(len(at) + 2)]  # [to, room, cost, position of the reverse arc]

    def arc(u, v, room, cost):
        arcs[u].append([v, room, cost, len(arcs[v])])
        arcs[v].append([u, 0, -cost, len(arcs[u]) - 1])

    total = sum(quota[s] for s in sources)
    for p in patterns:
        for k in range(most):
            arc(0, at["p", p], capacity[p], k)
        for s in p:
            arc(at["p", p], at["s", s], total, 0)
    for s in sources:
        arc(at["s", s], 1, quota[s], 0)
    height = [0] * len(arcs)
    while True:
        far, came = [float("inf")] * len(arcs), [None] * len(arcs)
        far[0], heap = 0, [(0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for i, (v, room, cost, _) in enumerate(arcs[u]):
                if room > 0 and d + cost + height[u] - height[v] < far[v]:
                    far[v], came[v] = d + cost + height[u] - height[v], (u, i)
                    heapq.heappush(heap, (far[v], v))
        if came[1] is None:
            break
        height = [h + (f if f < float("inf") else 0) for h, f in zip(height, far, strict=True)]
        v, room = 1, float("inf")
        while v:
            u, i = came[v]
            room, v = min(room, arcs[u][i][1]), u
        v = 1
        while v:
            u, i = came[v]
            arcs[u][i][1] -= room
            arcs[v][arcs[u][i][3]][1] += room
            v = u
    return {p: sum(most_room - a[1] for a, most_room in ((a, capacity[p]) for a in arcs[0] if a[0] == at["p", p]))
            for p in patterns}


def _keyed(docs: DataFrame, id_col: str, size, sources, seed: int) -> DataFrame:
    """The rows of ``docs`` as __doc, with __pattern (sorted distinct sources, null as ~), __size, __id and __h, the
    place in the order."""
    key = F.array_sort(F.array_distinct(F.transform(
        F.coalesce(sources, F.array().cast("array<string>")),
        lambda s: F.when(s.isNull(), F.lit("~")).otherwise(F.concat(F.lit("s"), s)))))
    return docs.select(F.struct("*").alias("__doc"), key.alias("__pattern"), F.coalesce(size, F.lit(0)).cast("long").alias("__size"),
                       F.col(id_col).alias("__id"), F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 1).alias("__h"))


def _plan(sized: DataFrame, weights, max_repeats: int, max_patterns: int) -> tuple[DataFrame, list[tuple[str, int, float]]]:
    """What every pattern takes, one row each (at most ``max_patterns``), and (source, size, target) of each source."""
    spark = sized.sparkSession
    rows = sized.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} distinct sets of sources; raise max_patterns")
    capacity = {tuple(r.pattern): r.size for r in rows if len(r.pattern)}
    sizes: dict[str, int] = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            sizes[s] += n
    target = share(sizes, weights, sum(r.size for r in rows), max_repeats)
    flow = route(capacity, {s: round(t) for s, t in target.items()}, max_repeats)
    plan = []
    for p, n in sorted(capacity.items()):
        rounds, rest = divmod(flow[p], n) if n else (0, 0)
        plan.append((list(p), rounds, rest))
    schema = "pattern array<string>, rounds int, rest long"
    plan_df = spark.createDataFrame(plan, schema) if plan else spark.createDataFrame([], schema)
    decided = written(_decide(sized, plan_df), "decided")
    return decided, [(s, sizes[s], target[s]) for s in sorted(sizes)]


def _decide(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with what its rest takes: the rows inside ``steps`` but not inside ``drops``, and the rows at ``fill``
    and ``add``.

    The seeded order goes first.  Of what it leaves out, the longest unit that fits the gap is filled in.  Where a gap
    stays, every unit left is longer than it; the shortest of them is added and rows that the order took are dropped
    for it, if that comes closer."""
    some = sized.join(F.broadcast(plan.where("rest > 0")), "pattern").where("size > 0")
    at = F.struct("h", "id", "size")
    # rows of equal id and size share one fate
    units = written(some.groupBy("pattern", "h", "id", "size").agg(F.sum("size").alias("total"))
                    .select("pattern", at.alias("at"), "size", "total"), "units")
    picked = _pick(units, plan.where("rest > 0").select("pattern", F.col("rest").alias("gap")))
    left = units.join(F.broadcast(picked.where("gap > 0")), "pattern").where(~_inside("steps", F.col("at"), F.col("size")))
    fill = (left.where("total <= gap").groupBy("pattern").agg(F.min(F.struct((-F.col("total")).alias("less"), "at")).alias("f"))
            .select("pattern", F.col("f.at").alias("fill"), F.col("f.less").alias("less")))
    filled = written(picked.join(fill, "pattern", "left").withColumn("gap", F.col("gap") + F.coalesce("less", F.lit(0)))
                     .drop("less"), "filled")
    others = units.join(F.broadcast(filled.where("gap > 0")), "pattern")
    taken = _inside("steps", F.col("at"), F.col("size"))
    add = (others.where(~taken & (F.col("total") > F.col("gap")) & (F.col("fill").isNull() | (F.col("at") != F.col("fill"))))
           .groupBy("pattern").agg(F.min(F.struct((F.col("total") - F.col("gap")).alias("over"), "at")).alias("a"))
           .select("pattern", F.col("a.over").alias("over"), F.col("a.at").alias("add")))
    add = written(add, "add")
    dropped = _pick(others.where(taken).select(*units.columns), add.select("pattern", F.col("over").alias("gap")))
    dropped = dropped.select("pattern", F.col("gap").alias("over"), F.col("steps").alias("drops"))
    better = (filled.join(dropped, "pattern").where("over < gap").join(add.select("pattern", "add"), "pattern")
              .select("pattern", "add", "drops"))
    return plan.join(filled.drop("gap"), "pattern", "left").join(better, "pattern", "left")


def _pick(units: DataFrame, gaps: DataFrame) -> DataFrame:
    """(pattern, gap, steps): the units inside ``steps`` make up each pattern's gap but for what ``gap`` then says.

    A step follows the seeded order over the units of at most ``cap`` up to one that overshoots.  That one is left
    out, and the next step goes on behind it under half the cap or half the gap left: a longer unit fits once at
    most.  So there are as many steps as the gap has bits, at most."""
    place = units.schema["at"].dataType.simpleString()
    state = written(gaps.select("pattern", "gap", F.col("gap").alias("cap"), F.lit(None).cast(place).alias("from"),
                                F.array().cast(f"array<struct<cap: bigint, from: {place}, to: {place}>>").alias("steps"),
                                (F.col("gap") > 0).alias("open")), "state")
    while not state.where("open").isEmpty():
        now = state.where("open").select("pattern", "gap", "cap", "from")
        live = (units.join(F.broadcast(now), "pattern")
                .where((F.col("size") <= F.col("cap")) & (F.col("from").isNull() | (F.col("at") > F.col("from"))))
                .withColumn("bucket", F.shiftright(F.col("at.h"), 63 - BUCKET_BITS)))
        # where the order overshoots: first the bucket, then the unit
        sums = live.groupBy("pattern", "gap", "bucket").agg(F.sum("total").alias("n"))
        sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket")))
        sums = written(sums.withColumn("before", F.col("upto") - F.col("n")), "sums")
        edge = sums.where("upto > gap and before <= gap").select("pattern", "bucket", "before")
        upto = F.col("before") + F.sum("total").over(Window.partitionBy("pattern").orderBy("at"))
        stop = (live.join(F.broadcast(edge), ["pattern", "bucket"]).withColumn("upto", upto).where("upto > gap")
                .groupBy("pattern").agg(F.min(F.struct("at", (F.col("upto") - F.col("total")).alias("n"))).alias("stop")))
        every = sums.groupBy("pattern").agg(F.max("upto").alias("every"))
        gap = F.col("gap") - F.coalesce("stop.n", "every", F.lit(0))
        step = F.array(F.struct("cap", F.col("from"), F.col("stop.at").alias("to")))
        half = F.when(F.col("cap") > 1, F.greatest(F.lit(1), F.expr("least(cap, left) div 2"))).otherwise(0)
        after = (state.join(stop, "pattern", "left").join(every, "pattern", "left")
                 .withColumn("left", F.when(F.col("open"), gap).otherwise(F.col("gap"))).withColumn("half", half.cast("long")))
        state = written(after.select(
            "pattern", F.col("left").alias("gap"), F.col("half").alias("cap"), F.col("stop.at").alias("from"),
            F.when(F.col("open"), F.concat("steps", step)).otherwise(F.col("steps")).alias("steps"),
            (F.col("open") & F.col("stop").isNotNull() & (F.col("left") > 0) & (F.col("half") > 0)).alias("open")), "state")
    return state.select("pattern", "gap", "steps")


def _inside(steps: str, at, size):
    """Does a step take the row of this place in the order and this size?"""
    return F.exists(steps, lambda s: (size <= s["cap"]) & (s["from"].isNull() | (at > s["from"])) & (s["to"].isNull() | (at < s["to"])))


def _times(keyed: DataFrame, decided: DataFrame) -> DataFrame:
    """``keyed`` with __times, how often the mix takes the row."""
    at = F.struct(F.col("__h").alias("h"), F.col("__id").alias("id"), F.col("__size").alias("size"))
    plan = decided.select([F.col(c).alias(f"__{c}") for c in decided.columns]).withColumnRenamed("__pattern", "__plan")
    kept = _inside("__steps", at, F.col("__size")) & ~F.coalesce(_inside("__drops", at, F.col("__size")), F.lit(False))
    once = (F.col("__rest") > 0) & (kept | F.coalesce((at == F.col("__fill")) | (at == F.col("__add")), F.lit(False)))
    times = F.coalesce("__rounds", F.lit(0)) + F.when(F.coalesce(once, F.lit(False)), 1).otherwise(0)
    # at most max_patterns rows, which _plan has checked
    return keyed.join(F.broadcast(plan), F.col("__pattern") == F.col("__plan"), "left").withColumn("__times", times)


def _sized(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col("__id").alias("id"), F.col("__pattern").alias("pattern"), F.col("__size").alias("size"), F.col("__h").alias("h"))


def mix_sources(docs: DataFrame, id_col: str, size, sources, weights: tuple[float, ...] = (5, 2, 1),
                max_repeats: int = 3, seed: int = 42, max_patterns: int = 100_000) -> DataFrame:
    """(id, sources, size, source_size, target, taken), one row per row of ``docs``.

    ``size`` is an expression for a document's token count (null: 0), ``sources`` one for the array of
    sources it belongs to; a null element is a source of its own, last in order, and a document of no
    source is never taken.  ``source_size`` and ``target`` are arrays beside ``sources``.  ``taken`` is
    size times the number of times the mix takes the document, at most ``max_repeats``.  Rows of equal id
    and size share one fate.  An empty table gives an empty result; a source without words has the
    target 0."""
    sized = written(_sized(_keyed(docs, id_col, size, sources, seed)), "sized")
    decided, facts = _plan(sized, weights, max_repeats, max_patterns)
    keyed = sized.select(*[F.col(c).alias(f"__{c}") for c in sized.columns])
    source_map = F.from_json(F.lit(json.dumps({s: {"n": n, "t": t} for s, n, t in facts})), "map<string, struct<n: bigint, t: double>>")
    return _times(keyed, decided).select(
        F.col("__id").alias("id"), F.transform("__pattern", lambda s: F.when(s != "~", F.substr(s, F.lit(2)))).alias("sources"),
        F.col("__size").alias("size"), F.transform("__pattern", lambda s: F.element_at(source_map, s)["n"]).alias("source_size"),
        F.transform("__pattern", lambda s: F.element_at(source_map, s)["t"]).alias("target"),
        (F.col("__size") * F.col("__times")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str, size, sources, weights: tuple[float, ...] = (5, 2, 1),
                    max_repeats: int = 3, seed: int = 42, max_patterns: int = 100_000) -> DataFrame:
    """The rows of ``docs``, each as often as the mix of ``mix_sources`` takes it; whole rows are not shuffled.

    Nulls, repeated rows and empty tables are as there: a row without words or without a source is never taken.
    Columns keep their names, order and types, whatever they are called."""
    keyed = _keyed(docs, id_col, size, sources, seed)
    decided, _ = _plan(written(_sized(keyed), "sized"), weights, max_repeats, max_patterns)
    taken = _times(keyed, decided).where("__times > 0").select("__doc", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return taken.select("__doc.*")
