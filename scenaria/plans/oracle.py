"""DuckDB oracle SQL for each registered query (same column names, rounded the same way)."""

from __future__ import annotations

SERIES = """series as (
  select user_id as scenario_id, event_id, epoch_us(ts)/1e6 as Time,
         case when event_type='error' then null else value end as f1,
         cast(regexp_extract(props,'([0-9]+)',1) as double) as f2,
         cast(least(5, floor(value/30)) as int) as A_label,
         cast(case event_type when 'view' then 0 when 'click' then 1 when 'signup' then 2
              when 'purchase' then 3 else 4 end as int) as B_label,
         cast(cast(regexp_extract(props,'([0-9]+)',1) as int) % 6 as int) as C_label
  from events)"""

POSITIONED = """pos as (select *, row_number() over (partition by scenario_id order by Time, event_id) as rn
  from series)"""

PROBS = """raw as (
  select event_id, C_label as y, c,
         cast((event_id*7+c*11)%13+1+case when c=C_label and event_id%3=0 then 6 else 0 end as double) as a,
         cast((event_id*5+c*3)%11+1+case when c=C_label and event_id%3=1 then 6 else 0 end as double) as b
  from series cross join (select unnest(range(0,6)) as c) k),
probs as (select event_id, y, c, a/sum(a) over (partition by event_id) as pt,
                 b/sum(b) over (partition by event_id) as ps from raw)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


W = "window w as (partition by scenario_id order by Time, event_id)"

ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


register("rolling_mean", with_(SERIES) + f"""
select event_id, scenario_id,
       round(avg(f2) over (w rows between 9 preceding and current row), 6) as f2_rolling_mean_10
from series {W}""")

register("rolling_std", with_(SERIES) + f"""
select event_id, scenario_id,
       round(coalesce(stddev_samp(f2) over (w rows between 9 preceding and current row), 0), 6) as f2_rolling_std_10
from series {W}""")

register("diff", with_(SERIES) + f"""
select event_id, scenario_id, round(coalesce(f2 - lag(f2) over w, 0), 6) as f2_diff
from series {W}""")

register("ema", with_(SERIES, POSITIONED) + """
select a.event_id, a.scenario_id,
       round(sum(b.f2 * power(9/11.0, a.rn - b.rn)) / sum(power(9/11.0, a.rn - b.rn)), 6) as f2_ema_10
from pos a join pos b on a.scenario_id = b.scenario_id and b.rn <= a.rn
group by a.event_id, a.scenario_id""")

register("time_since_start", with_(SERIES) + """
select event_id, scenario_id, round(Time - min(Time) over (partition by scenario_id), 6) as time_since_start
from series""")

register("time_to_failure", with_(SERIES) + """,
st as (select scenario_id, min(Time) t0, max(Time) t1, max(A_label) ml from series group by scenario_id),
mt as (select s.scenario_id, max(s.Time) tm from series s join st on s.scenario_id = st.scenario_id
       and s.A_label = st.ml group by s.scenario_id)
select s.event_id, s.scenario_id,
       round(case when st.ml > 0 and st.t1 - st.t0 > 0
             then 1 - least(greatest((mt.tm - s.Time) / (st.t1 - st.t0), 0), 1) end, 6) as A_time_to_failure
from series s join st using (scenario_id) join mt using (scenario_id)""")


FILLS = """fills as (select *,
    last_value(case when f1 is not null then rn end ignore nulls) over (partition by scenario_id order by rn
        rows between unbounded preceding and current row) as prn,
    last_value(f1 ignore nulls) over (partition by scenario_id order by rn
        rows between unbounded preceding and current row) as pv,
    first_value(case when f1 is not null then rn end ignore nulls) over (partition by scenario_id order by rn
        rows between current row and unbounded following) as nrn,
    first_value(f1 ignore nulls) over (partition by scenario_id order by rn
        rows between current row and unbounded following) as nv
  from pos)"""

register("interpolate", with_(SERIES, POSITIONED, FILLS) + """
select event_id, scenario_id,
       round(case when f1 is not null then f1
                  when prn is not null and nrn is not null then pv + (nv - pv) * (rn - prn) / (nrn - prn)
                  when prn is not null then pv end, 6) as f1
from fills""")

register("ffill_bfill", with_(SERIES, POSITIONED, FILLS) + """
select event_id, scenario_id,
       round(case when f1 is not null then f1
                  when prn is not null and nrn is not null then pv + (nv - pv) * (rn - prn) / (nrn - prn)
                  when prn is not null then pv else nv end, 6) as f1
from fills""")

register("mode_fill", with_(SERIES) + """,
s as (select event_id, case when event_id % 17 <> 0 then A_label end as A_label from series),
m as (select A_label as v from s where A_label is not null group by A_label order by count(*) desc, A_label limit 1)
select event_id, cast(coalesce(A_label, (select v from m)) as int) as A_label from s""")

register("mean_fill", with_(SERIES) + """
select event_id, round(coalesce(f1, (select avg(f1) from series)), 6) as f1 from series""")

register("nonfinite_to_zero", with_(SERIES) + """,
x as (select event_id, case when f1 is null then cast('NaN' as double)
                            when event_id % 7 = 0 then cast('Infinity' as double)
                            when event_id % 11 = 0 then cast('-Infinity' as double)
                            else f1 / ln(f2 + 2) end as x from series)
select event_id, round(case when isnan(x) or isinf(x) then 0 else x end, 6) as x from x""")

register("null_audit", with_(SERIES) + """
select 'scenario_id' as column_name, cast(count(*) - count(scenario_id) as bigint) as null_count from series
union all select 'event_id', count(*) - count(event_id) from series
union all select 'Time', count(*) - count(Time) from series
union all select 'f1', count(*) - count(f1) from series
union all select 'f2', count(*) - count(f2) from series
union all select 'A_label', count(*) - count(A_label) from series
union all select 'B_label', count(*) - count(B_label) from series
union all select 'C_label', count(*) - count(C_label) from series""")


LONG_LABELS = """lng as (select scenario_id, event_id, 'A_label' as label, A_label as class from series
  union all select scenario_id, event_id, 'B_label', B_label from series
  union all select scenario_id, event_id, 'C_label', C_label from series)"""

MODES = LONG_LABELS + """,
mc as (select scenario_id, label, class, count(*) as n from lng group by all),
mr as (select *, row_number() over (partition by scenario_id, label order by n desc, class) as rk from mc),
modes as (select scenario_id, cast(max(case when label='A_label' then class end) as int) as A_label,
                 cast(max(case when label='B_label' then class end) as int) as B_label,
                 cast(max(case when label='C_label' then class end) as int) as C_label
          from mr where rk = 1 group by scenario_id)"""

register("scenario_modes", with_(SERIES, MODES) + "select * from modes")

register("class_counts", with_(SERIES, LONG_LABELS) + """
select label, cast(class as int) as class, count(*) as n from lng group by all""")

COMBO = "concat_ws(',', cast(A_label as varchar), cast(B_label as varchar), cast(C_label as varchar))"

register("combo_counts", with_(SERIES) + f"select {COMBO} as combo, count(*) as n from series group by all")

register("top_combos", with_(SERIES) + f"""
select {COMBO} as combo, count(*) as n from series group by all order by n desc, combo limit 10""")

register("diversity", with_(SERIES, LONG_LABELS) + """
select label, count(distinct class) as n_classes, count(distinct class) > 1 as diverse from lng group by label""")

SPLIT = MODES + """,
sr as (select scenario_id, C_label as cls,
              row_number() over (partition by C_label order by md5(concat('42', cast(scenario_id as varchar))), scenario_id) as rank,
              count(*) over (partition by C_label) as n from modes),
s1 as (select *, cast(greatest(floor(n * 0.7::double), 1) as bigint) as ntr from sr),
s2 as (select *, case when n - ntr > 1 then cast(greatest(floor((n - ntr) * 0.5::double), 1) as bigint) else 0 end as nv0 from s1),
s3 as (select *, case when n - ntr - nv0 = 0 and nv0 > 1 then nv0 - 1 else nv0 end as nv from s2),
split as (select scenario_id, case when rank <= ntr then 'train' when rank <= ntr + nv then 'val' else 'test' end as split,
                 cls, rank from s3)"""

register("split_scenarios", with_(SERIES, SPLIT) + "select * from split")

register("split_report", with_(SERIES, SPLIT) + """
select p.split, l.label, cast(l.class as int) as class, count(*) as n
from lng l join split p using (scenario_id) group by all""")

register("split_missing_classes", with_(SERIES, SPLIT) + """,
present as (select distinct p.split, l.label, cast(l.class as int) as class from lng l join split p using (scenario_id)),
allc as (select distinct label, class from present),
grid as (select * from allc cross join (select unnest(['train','val','test']) as split) s)
select g.label, g.class, g.split from grid g anti join present p using (split, label, class)""")

register("row_split", with_(SERIES) + """,
r as (select event_id,
             row_number() over (partition by A_label, B_label, C_label order by md5(concat('42', cast(event_id as varchar))), event_id) as rk,
             count(*) over (partition by A_label, B_label, C_label) as n from series),
c as (select *, cast(floor(n * 0.7::double) as bigint) as ntr from r),
d as (select *, cast(floor((n - ntr) * 0.5::double) as bigint) as nv from c)
select event_id, case when rk <= ntr then 'train' when rk <= ntr + nv then 'val' else 'test' end as split from d""")


LENGTHS = """lens as (select scenario_id, count(*) as n from series group by scenario_id)"""

STRIDED = LENGTHS + """,
sq as (select scenario_id, unnest(range(0, (n - 20) // 15 + 1)) as seq_id from lens where n >= 20),
strided as (select p.scenario_id, s.seq_id, p.rn - 1 - s.seq_id * 15 as step, p.event_id, p.f2,
                   p.A_label, p.B_label, p.C_label, p.f1
            from sq s join pos p on p.scenario_id = s.scenario_id
             and p.rn - 1 between s.seq_id * 15 and s.seq_id * 15 + 19)"""

register("sequences_strided", with_(SERIES, POSITIONED, STRIDED) + """
select scenario_id, seq_id, step, event_id, round(f2, 6) as f2 from strided""")

register("last_step", with_(SERIES, POSITIONED, STRIDED) + """
select scenario_id, seq_id, event_id, A_label, B_label, C_label from strided where step = 19""")

register("sequences_even", with_(SERIES, POSITIONED, LENGTHS) + """,
st as (select scenario_id, n - 19 as m, least(n - 19, 10) as k from lens where n >= 20),
ks as (select scenario_id, m, k, unnest(range(0, k)) as seq_id from st),
starts as (select scenario_id, seq_id, case when k = 1 then 0 when seq_id = k - 1 then m - 1
                  else cast(floor(seq_id * ((m - 1)::double / (k - 1)::double)) as bigint) end as s from ks)
select p.scenario_id, t.seq_id, p.rn - 1 - t.s as step, p.event_id, round(p.f2, 6) as f2
from starts t join pos p on p.scenario_id = t.scenario_id and p.rn - 1 between t.s and t.s + 19""")

register("sequences_random", with_(SERIES, POSITIONED, LENGTHS) + """,
pick as (select scenario_id, n from lens order by md5(concat('42', cast(scenario_id as varchar))), scenario_id limit 50),
st as (select scenario_id, ('0x' || substr(md5(concat('42s', cast(scenario_id as varchar))), 1, 8))::bigint % (n - 19) as s
       from pick where n >= 20)
select p.scenario_id, cast(0 as bigint) as seq_id, p.rn - 1 - t.s as step, p.event_id, round(p.f2, 6) as f2
from st t join pos p on p.scenario_id = t.scenario_id and p.rn - 1 between t.s and t.s + 19""")


register("feature_stats", with_(SERIES, POSITIONED, STRIDED) + """
select 'f1' as feature, round(avg(f1), 6) as mean, round(stddev_pop(f1) + 1e-8, 6) as std from strided
union all select 'f2', round(avg(f2), 6), round(stddev_pop(f2) + 1e-8, 6) from strided""")

register("standardize", with_(SERIES, POSITIONED, STRIDED) + """,
st as (select avg(f1) as m1, stddev_pop(f1) + 1e-8 as s1, avg(f2) as m2, stddev_pop(f2) + 1e-8 as s2 from strided)
select scenario_id, seq_id, step, round(coalesce((f1 - m1) / s1, 0), 6) as f1, round(coalesce((f2 - m2) / s2, 0), 6) as f2
from strided cross join st""")

register("one_hot", with_(SERIES, POSITIONED, STRIDED) + """
select scenario_id, seq_id, cast(k.c as int) as class, cast(C_label = k.c as int) as hot
from strided cross join (select unnest(range(0, 6)) as c) k where step = 19""")

PRED = """am as (select *, row_number() over (partition by event_id order by pt desc, c) as rt,
                 row_number() over (partition by event_id order by ps desc, c) as rs from probs),
pred as (select 'tree' as model, 'C_label' as label, event_id as row_id, y as y_true, cast(c as int) as y_pred from am where rt = 1
  union all select 'seq', 'C_label', event_id, y, cast(c as int) from am where rs = 1
  union all select 'tree', 'quality', doc_id, quality, toxic from labels),
cnt as (select model, label, y_true, y_pred, count(*) as n from pred group by all),
acc as (select model, label, count(*) as n, sum(case when y_true = y_pred then 1 else 0 end)::bigint as correct,
               sum(case when y_true = y_pred then 1 else 0 end)::double / count(*) as accuracy from pred group by all)"""

register("accuracy", with_(SERIES, PROBS, PRED) + """
select model, label, n, correct, round(accuracy, 6) as accuracy from acc""")

register("pooled_accuracy", with_(SERIES, PROBS, PRED) + """
select model, round(sum(correct)::double / sum(n), 6) as accuracy from acc group by model""")

register("macro_accuracy", with_(SERIES, PROBS, PRED) + """
select model, round(avg(accuracy), 6) as accuracy from acc group by model""")

register("class_recall", with_(SERIES, PROBS, PRED) + """
select model, label, y_true as class, count(*) as n,
       round(sum(case when y_true = y_pred then 1 else 0 end)::double / count(*), 6) as recall
from pred group by all""")

register("confusion_truth", with_(SERIES, PROBS, PRED) + """,
cls as (select distinct model, label, y_true as c from cnt),
grid as (select a.model, a.label, a.c as y_true, b.c as y_pred from cls a join cls b using (model, label))
select g.model, g.label, g.y_true, g.y_pred, coalesce(n, 0)::bigint as n
from grid g left join cnt using (model, label, y_true, y_pred)""")

register("confusion_union", with_(SERIES, PROBS, PRED) + """,
cls as (select distinct model, label, y_true as c from cnt union select distinct model, label, y_pred from cnt),
grid as (select a.model, a.label, a.c as y_true, b.c as y_pred from cls a join cls b using (model, label))
select g.model, g.label, g.y_true, g.y_pred, coalesce(n, 0)::bigint as n
from grid g left join cnt using (model, label, y_true, y_pred)""")

register("class_report", with_(SERIES, PROBS, PRED) + """,
cls as (select distinct model, label, y_true as c from cnt union select distinct model, label, y_pred from cnt),
tp as (select model, label, y_true as c, sum(n) as tp from cnt where y_true = y_pred group by all),
sup as (select model, label, y_true as c, sum(n) as support from cnt group by all),
np as (select model, label, y_pred as c, sum(n) as npred from cnt group by all),
per as (select model, label, c, coalesce(tp, 0) as tp, coalesce(support, 0) as support, coalesce(npred, 0) as npred
        from cls left join tp using (model, label, c) left join sup using (model, label, c) left join np using (model, label, c)),
m as (select *, case when npred > 0 then tp::double / npred else 0 end as precision,
                case when support > 0 then tp::double / support else 0 end as recall from per),
m2 as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1_score from m)
select model, label, cast(c as varchar) as cls, round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1_score, 6) as f1_score, round(support::double, 6) as support from m2
union all select model, label, 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), round(accuracy, 6) from acc
union all select model, label, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
                 round(sum(support)::double, 6) from m2 group by all
union all select model, label, 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1_score * support) / sum(support), 6),
                 round(sum(support)::double, 6) from m2 group by all""")

BLEND50 = """bl as (select event_id, y, c, 0.5::double * pt + (1.0::double - 0.5::double) * ps as pb from probs),
bla as (select *, row_number() over (partition by event_id order by pb desc, c) as rb from bl)"""

register("blend", with_(SERIES, PROBS, BLEND50) + """
select event_id, y as y_true, cast(c as int) as y_pred from bla where rb = 1""")

register("blend_truncated", with_(SERIES, PROBS) + """,
sums as (select event_id, list_reduce(list(pt order by c), lambda x, z: x + z) as st, list_reduce(list(ps order by c), lambda x, z: x + z) as ss
         from probs where c < 5 group by event_id),
tr as (select event_id, y, c, pt / st as qt, ps / ss as qs from probs join sums using (event_id) where c < 5),
bl as (select *, 0.5::double * qt + (1.0::double - 0.5::double) * qs as pb from tr),
bla as (select *, row_number() over (partition by event_id order by pb desc, c) as rb from bl)
select event_id, y as y_true, cast(c as int) as y_pred from bla where rb = 1""")

register("blend_mismatch", with_(SERIES, PROBS, PRED, BLEND50) + """,
t as (select row_id as event_id, y_true, y_pred from pred where model = 'tree' and label = 'C_label'),
s as (select row_id as event_id, y_true, y_pred from pred where model = 'seq' and label = 'C_label' and row_id % 10 <> 0),
b as (select event_id, y, c from bla where rb = 1 and event_id % 10 <> 0)
select 'C_label' as label, (select count(*) from t) as n_first, (select count(*) from s) as n_second,
       (select count(*) from t join s using (event_id)) as n_aligned,
       (select count(*) from t) <> (select count(*) from s) as mismatch, 'first' as chosen,
       round((select sum(case when y_true = y_pred then 1 else 0 end)::double / count(*) from t), 6) as acc_chosen,
       round((select sum(case when y = c then 1 else 0 end)::double / count(*) from b), 6) as acc_aligned""")


def curve(n: int, name: str = "cv") -> str:
    return f"""{name}_w as (select i::double / {n}.0::double as w from range(0, {n + 1}) t(i)),
{name}_b as (select p.event_id, p.y, p.c, q.w, q.w * p.pt + (1.0::double - q.w) * p.ps as pb from probs p cross join {name}_w q),
{name}_a as (select *, row_number() over (partition by event_id, w order by pb desc, c) as r from {name}_b),
{name} as (select 'C_label' as label, w as weight, sum(case when c = y then 1 else 0 end)::double / count(*) as accuracy
           from {name}_a where r = 1 group by w),
{name}_best as (select label, case when max(accuracy) > 0 then min(weight) filter (where accuracy = mx) else 0.5 end as weight,
                case when max(accuracy) > 0 then max(accuracy) else 0.0 end as accuracy
                from (select *, max(accuracy) over () as mx from {name}) group by label)"""


register("weight_curve", with_(SERIES, PROBS, curve(20)) + """
select label, round(weight, 6) as weight, round(accuracy, 6) as accuracy from cv""")

register("best_weight", with_(SERIES, PROBS, curve(20)) + """
select label, round(weight, 6) as weight, round(accuracy, 6) as accuracy from cv_best""")

ACCS = """accs as (select 'C_label' as label,
   (select sum(case when y_true = y_pred then 1 else 0 end)::double / count(*) from pred where model = 'tree' and label = 'C_label') as tree,
   (select sum(case when y_true = y_pred then 1 else 0 end)::double / count(*) from pred where model = 'seq' and label = 'C_label') as seq,
   (select sum(case when y = c then 1 else 0 end)::double / count(*) from bla where rb = 1) as blend_50,
   (select sum(case when c = y then 1 else 0 end)::double / count(*) from
      (select p.event_id, p.y, p.c, row_number() over (partition by p.event_id
              order by o.weight * p.pt + (1.0::double - o.weight) * p.ps desc, p.c) as r
       from probs p cross join cv_best o) where r = 1) as blend_opt,
   (select weight from c10_best) as weight_orig, (select weight from cv_best) as weight_opt)"""

register("blend_gain", with_(SERIES, PROBS, PRED, BLEND50, curve(20), curve(10, "c10"), ACCS) + """
select label, round(blend_50, 6) as acc_default, round(blend_opt, 6) as acc_opt, round(blend_opt - blend_50, 6) as improvement
from accs""")

register("best_model", with_(SERIES, PROBS, PRED, BLEND50, curve(20), curve(10, "c10"), ACCS) + """
select label, round(tree, 6) as tree, round(seq, 6) as seq, round(blend_50, 6) as blend,
       case when tree is null or seq is null or blend_50 is null then 'N/A'
            when tree >= seq and tree >= blend_50 then 'tree' when seq >= blend_50 then 'seq' else 'blend' end as best_model,
       blend_50 > greatest(tree, seq) as blend_improves
from accs""")

register("model_comparison", with_(SERIES, PROBS, PRED) + """
select label, round(max(case when model = 'tree' then accuracy end), 6) as tree,
       round(max(case when model = 'seq' then accuracy end), 6) as seq from acc group by label
union all select 'overall', round(sum(correct) filter (where model = 'tree')::double / sum(n) filter (where model = 'tree'), 6),
                 round(sum(correct) filter (where model = 'seq')::double / sum(n) filter (where model = 'seq'), 6) from acc""")

register("before_after", with_(SERIES, PROBS, PRED, BLEND50, curve(20), curve(10, "c10"), ACCS) + """
select label, round(tree, 6) as tree, round(seq, 6) as seq, round(blend_50, 6) as blend_50, round(blend_opt, 6) as blend_opt,
       round(weight_orig, 6) as weight_orig, round(weight_opt, 6) as weight_opt from accs
union all select 'overall', round(avg(tree), 6), round(avg(seq), 6), round(avg(blend_50), 6), round(avg(blend_opt), 6),
                 cast(null as double), cast(null as double) from accs""")


register("knn_in_class", """
with e as (select vec_id, label, embedding from embeddings),
d as (select a.vec_id, b.vec_id as nbr_id,
             list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::double - z[2]::double) * (z[1]::double - z[2]::double))) as d2
      from e a join e b on a.label = b.label and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by vec_id order by d2, nbr_id) as rank from d)
select vec_id, cast(rank as int) as rank, nbr_id, round(d2, 6) as d2 from r where rank <= 5""")

register("smote_counts", """
with c as (select label as class, count(*) as n from embeddings group by label)
select class, case when (select min(n) from c) < 100 then (select max(n) from c) else n end as n from c""")

register("smote_combo_counts", """
with t as (select quality, toxic, count(*) as n from labels l join documents d using (doc_id) group by all)
select quality, toxic, case when (select min(n) from t) >= 5 then (select max(n) from t) else n end as n from t""")

register("read_roles", with_(SERIES) + """
select Time, cast(f1 as float) as f1, cast(f2 as float) as f2, cast(A_label as tinyint) as A_label,
       cast(B_label as tinyint) as B_label, cast(C_label as tinyint) as C_label,
       case when cast(floor(Time * 1e6) as bigint) % 2 = 0 then 'a' else 'b.v2' end as scenario_id
from series""")

register("min_class_count", with_(SERIES, LONG_LABELS) + """
select label, min(n) as min_n from (select label, class, count(*) as n from lng group by all) group by label""")

register("null_total", with_(SERIES) + """
select cast((count(*) - count(scenario_id)) + (count(*) - count(event_id)) + (count(*) - count(Time))
     + (count(*) - count(f1)) + (count(*) - count(f2)) + (count(*) - count(A_label))
     + (count(*) - count(B_label)) + (count(*) - count(C_label)) as bigint) as null_total from series""")

register("sequences_keyless", with_(SERIES) + """,
g as (select event_id, f2, row_number() over (order by Time, event_id) as rn, count(*) over () as n from series),
sq as (select unnest(range(0, (max(n) - 20) // 15 + 1)) as seq_id from g)
select s.seq_id, g.rn - 1 - s.seq_id * 15 as step, g.event_id, round(g.f2, 6) as f2
from sq s join g on g.rn - 1 between s.seq_id * 15 and s.seq_id * 15 + 19""")

register("ffill_only", with_(SERIES, POSITIONED, FILLS) + """
select event_id, scenario_id, round(coalesce(f1, pv, nv), 6) as f1 from fills""")

# the weights are taken beside the last value's own, so no distance makes them vanish
register("ema_gap", """
with g as (select event_id, value, row_number() over (order by event_id) as rn, event_id % 7000 < 10 as has from events),
l as (select event_id, rn, max(case when has then rn end) over (order by rn) as m from g),
v as (select rn, value from g where has and value is not null),
e as (select l.event_id, sum(v.value * power(9/11.0, l.m - v.rn)) / sum(power(9/11.0, l.m - v.rn)) as e
      from l join v on v.rn <= l.m group by l.event_id)
select l.event_id, round(e.e, 6) as x_ema_10 from l left join e using (event_id)""")

register("blend_ten", """
with raw as (select vec_id, label as y, c,
   cast((vec_id*7+c*11)%13+1+case when c=label and vec_id%3=0 then 6 else 0 end as double) / 64 as a,
   cast((vec_id*5+c*3)%11+1+case when c=label and vec_id%3=1 then 6 else 0 end as double) / 64 as b
   from embeddings cross join (select unnest(range(0,10)) as c) k),
r as (select *, row_number() over (partition by vec_id order by 0.5::double * a + (1.0::double - 0.5::double) * b desc, c) as rb,
             row_number() over (partition by vec_id order by a desc, c) as ra from raw)
select vec_id, max(y) as y_true, cast(max(case when rb = 1 then c end) as int) as y_pred, cast(max(case when ra = 1 then c end) as int) as y_first
from r group by vec_id""")

register("truncate_no_mass", """
select doc_id, round(case when quality = 0 then 0.0::double else 0.25::double / 0.75 end, 6) as p1_0,
       round(case when quality = 0 then 0.0::double else 0.5::double / 0.75 end, 6) as p1_1, 0.25::double as p2_0, 0.75::double as p2_1
from labels""")

register("combo_nulls", with_(SERIES) + """,
s as (select case when event_id % 5 <> 0 then A_label end as A_label, case when event_id % 7 <> 0 then B_label end as B_label, C_label from series)
select concat(coalesce(cast(A_label as varchar), 'null'), ',', coalesce(cast(B_label as varchar), 'null'), ',',
              coalesce(cast(C_label as varchar), 'null')) as combo, count(*) as n, A_label, B_label, C_label
from s group by A_label, B_label, C_label""")

register("read_headers", with_(SERIES) + """
select case when event_id % 2 = 0 then 'even' else 'odd' end as scenario_id, Time,
       case when event_id % 2 = 0 then cast(f1 as float) end as f1, cast(f2 as float) as f2, cast(A_label as tinyint) as A_label,
       case when event_id % 2 = 1 then cast(C_label as tinyint) end as C_label from series""")

register("scenario_split_counts", with_(SERIES, SPLIT) + """,
m as (select scenario_id, 'A_label' as label, A_label as class from modes union all select scenario_id, 'B_label', B_label from modes
      union all select scenario_id, 'C_label', C_label from modes)
select label, cast(class as int) as class, split, count(*) as n from m join split using (scenario_id) where class is not null group by all""")

register("missing_in_splits", with_(SERIES, SPLIT) + """,
own as (select scenario_id, case when scenario_id % 50 = 0 then cast(scenario_id as int) else A_label end as class from series),
present as (select distinct split.split, class from own join split using (scenario_id) where class is not null),
grid as (select * from (select distinct class from present) cross join (select unnest(['train','val','test']) as split) s)
select 'A_label' as label, cast(g.class as int) as class, g.split from grid g anti join present p using (split, class)""")

register("before_after_report", with_(SERIES, PROBS, PRED) + """,
now as (select label, max(case when model = 'tree' then accuracy end) as tree, max(case when model = 'seq' then accuracy end) as seq
        from acc group by label),
b as (select *, case when label = 'C_label' then tree / 2 end as bt, case when label = 'C_label' then seq / 4 end as bs from now)
select label, round(bt, 6) as before_tree, round(tree, 6) as tree, round(tree - bt, 6) as gain_tree,
       round(bs, 6) as before_seq, round(seq, 6) as seq, round(seq - bs, 6) as gain_seq from b""")

register("blend_report", ORACLE["class_report"].replace(
    "pred as (", BLEND50 + """,
pred as (select 'blend' as model, 'C_label' as label, event_id as row_id, y as y_true, cast(c as int) as y_pred from bla where rb = 1
  union all """, 1))

register("tree_fit_binary", """
with r as (select doc_id, quality * 2 as y, row_number() over (partition by quality order by md5(concat('42', cast(doc_id as varchar))), doc_id) as rk,
                  count(*) over (partition by quality) as n from labels join documents using (doc_id)),
c as (select *, cast(floor(n * 0.7::double) as bigint) as ntr from r),
d as (select *, cast(floor((n - ntr) * 0.5::double) as bigint) as nv from c)
select case when rk <= ntr then 'train' when rk <= ntr + nv then 'val' else 'test' end as split, cast(y as int) as y_true, count(*) as n,
       3::bigint as classes, 1.0::double as mass, true as known from d group by all""")

register("tree_fit_rows", """
with r as (select vec_id, label as y, row_number() over (partition by label order by md5(concat('42', cast(vec_id as varchar))), vec_id) as rk,
                  count(*) over (partition by label) as n from embeddings),
c as (select *, cast(floor(n * 0.7::double) as bigint) as ntr from r),
d as (select *, cast(floor((n - ntr) * 0.5::double) as bigint) as nv from c)
select case when rk <= ntr then 'train' when rk <= ntr + nv then 'val' else 'test' end as split, 'label' as label,
       cast(y as int) as y_true, count(*) as n, 10::bigint as classes, 1.0::double as mass, true as known from d group by all""")

register("seq_fit_rows", ORACLE["sequences_even"].replace(
    "select p.scenario_id, t.seq_id, p.rn - 1 - t.s as step, p.event_id, round(p.f2, 6) as f2\nfrom starts t",
    "select 'C_label' as label, p.C_label as y_true, count(*) as n, 6::bigint as classes, 1.0::double as mass, true as known\nfrom starts t").replace(
    "between t.s and t.s + 19", "= t.s + 19 group by p.C_label"))

SMOTE = """c as (select label, count(*) as n from e group by label),
j as (select label, n, unnest(range(0, (select max(n) from c) - n)) as j from c where n > 1),
spec as (select label, j, ('0x' || substr(md5(concat('42:', label, ':', j)), 1, 8))::bigint % n + 1 as bp,
                ('0x' || substr(md5(concat('43:', label, ':', j)), 1, 8))::bigint % least(5, n - 1) + 1 as nr,
                ('0x' || substr(md5(concat('44:', label, ':', j)), 1, 8))::bigint::double / 4294967296.0::double as u from j),
base as (select *, row_number() over (partition by label order by vec_id) as bp from e),
d as (select a.vec_id, b.vec_id as nbr_id,
             list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::double - z[2]::double) * (z[1]::double - z[2]::double))) as d2
      from e a join e b on a.label = b.label and a.vec_id <> b.vec_id),
k as (select *, row_number() over (partition by vec_id order by d2, nbr_id) as nr from d)
select s.label, """ + ", ".join(
    f"round(cast(cast(b.embedding[{i}] + s.u * (n.embedding[{i}] - b.embedding[{i}]) as float) as double), 4) as v{i - 1}" for i in range(1, 5)) + """
from spec s join base b on b.label = s.label and b.bp = s.bp join k on k.vec_id = b.vec_id and k.nr = s.nr join e n on n.vec_id = k.nbr_id"""

register("smote_rows", "with e as (select vec_id, label, embedding from embeddings),\n" + SMOTE)
register("smote_equal_rows", """with e as (select vec_id, label, case when vec_id % 2 = 0
  then list_transform(range(0, 64), lambda i: cast(label + i as float)) else embedding end as embedding from embeddings),
""" + SMOTE)

register("tree_flat", """
select unnest(['label', 'odd']) as label, (select count(*) from embeddings) as n, 0::bigint as differing""")

register("exact_weight", with_(SERIES, PROBS) + """
, labs as (select 0 as shift, 'C_label' as label union all select 1, 'next'),
p as (select label, event_id, (y + shift) % 6 as y, c, pt, ps from probs cross join labs),
k as (select p.*, t.ps - p.ps as q, (t.pt - p.pt) - (t.ps - p.ps) as d from p join p t on t.label = p.label and t.event_id = p.event_id and t.c = p.y and p.c <> p.y),
r as (select label, event_id, greatest(0.0::double, max(case when d > 0 then -q / d when d = 0 and q < 0 then 'infinity'::double else 0.0::double end)) as lo,
             least(1.0::double, min(case when d < 0 then -q / d else 1.0::double end)) as hi from k group by all),
s as (select r.label, r.event_id, lo, hi, max(case when y > c and d > 0 and -q / d = lo then 1 else 0 end) as ol,
             max(case when y > c and d < 0 and -q / d = hi then 1 else 0 end) as oh, max(case when y > c and d = 0 and q = 0 then 1 else 0 end) as never
      from r join k on k.label = r.label and k.event_id = r.event_id group by all),
f as (select * from s where never = 0 and lo <= 1 and (lo < hi or (lo = hi and ol + oh = 0))),
e as (select label, lo as w, ol as side, 1 as h from f union all select label, hi, 1 - oh, -1 from f),
g as (select label, w, side, sum(h) as h from e group by all),
z as (select label, w, side, sum(h) over (partition by label order by w, side) as hits, coalesce(lead(w) over (partition by label order by w, side), 1.0::double) as upto from g),
b as (select *, row_number() over (partition by label order by hits desc, w, side) as rk from z)
select label, round(case when side = 0 then w else (w + upto) / 2 end, 6) as weight, round(upto, 6) as upto, cast(hits as bigint) as hits,
       round(hits::double / (select count(*) from probs where c = 0), 6) as accuracy from b where rk = 1""")

register("accuracy_at", with_(SERIES, PROBS, curve(20)) + """
, labs as (select 0 as shift, 'C_label' as label, (select weight from cv_best) as w union all select 1, 'next', 0.5::double),
p as (select label, event_id, (y + shift) % 6 as y, c, row_number() over (partition by label, event_id order by w * pt + (1.0::double - w) * ps desc, c) as r
      from probs cross join labs)
select label, round(sum(case when c = y then 1 else 0 end)::double / count(*), 6) as accuracy from p where r = 1 group by label""")

EMB_SPLIT = """emb as (select vec_id, label, row_number() over (partition by label order by md5(concat('42', cast(vec_id as varchar))), vec_id) as rk,
                       count(*) over (partition by label) as n from embeddings),
emc as (select *, cast(floor(n * 0.7::double) as bigint) as ntr from emb),
emd as (select *, cast(floor((n - ntr) * 0.5::double) as bigint) as nv from emc),
ems as (select vec_id, label, case when rk <= ntr then 'train' when rk <= ntr + nv then 'val' else 'test' end as split from emd)"""

register("snapshot_split", with_(EMB_SPLIT) + """
select label, count(*) as n, min(vec_id) as first from ems where split = 'test' group by label""")

register("sequence_snapshot", with_(SERIES, POSITIONED, STRIDED) + """
select scenario_id, seq_id, count(*) as steps, round(max(case when step = 0 then cast(f2 as float) end)::double, 6) as first,
       round(max(case when step = 19 then cast(f2 as float) end)::double, 6) as last, round(sum(coalesce(cast(f2 as float), 0)::double), 6) as total,
       max(case when step = 19 then A_label end) as A_label, max(case when step = 19 then B_label end) as B_label,
       max(case when step = 19 then C_label end) as C_label from strided group by scenario_id, seq_id""")

register("roles_round_trip", "select count(*) as rows, 'f1,f2' as features, 'A_label,B_label,C_label' as labels from events")

register("model_store", "select count(*) as rows, 0::bigint as differing, 'label' as labels from embeddings")

register("importance_rows", """select 'label' as label, 64::bigint as features, 1::bigint as first, 64::bigint as last, 1.0::double as mass,
       true as known, true as falling""")

register("cv_folds", with_(EMB_SPLIT) + """
select cast(('0x' || substr(md5(concat('42:', vec_id)), 1, 8))::bigint % 3 as int) as fold, label as class, count(*) as n
from ems where split = 'train' group by all""")

register("tree_cv_rows", with_(EMB_SPLIT) + """
select cast(unnest([3, 5]) as int) as max_depth, true as valid, (select count(*) from ems where split = 'train') as rows""")

register("capped_sequences", with_(SERIES, POSITIONED, STRIDED) + """
, ids as (select distinct scenario_id, seq_id from strided order by scenario_id, seq_id limit 25)
select scenario_id, seq_id, step, event_id, round(f2, 6) as f2 from strided join ids using (scenario_id, seq_id)""")

register("no_sequences", ORACLE["sequences_strided"] + " where false")

register("name_keys", with_(SERIES) + """
select 'run' as first, concat('run.', scenario_id, '.v2') as stem, count(*) as n from series group by scenario_id""")

register("epoch_mean", with_(SERIES) + """
select cast(floor(Time / 60) as bigint) as epoch, round(avg(v), 6) as value
from (select Time, unnest([f1, f2]) as v from series) group by 1""")

register("scoring_time_rows", with_(EMB_SPLIT) + """
select 'tree' as model, count(*) as rows, true as timed, true as formula from ems where split = 'test'""")


def moves(labels: list[str], classes: int = 6) -> str:
    """Secondary rebalancing, one CTE per (label, class): the first split without the class that has a donor with two or
    more takes the donor's first scenario of the class, which goes to the end of its new list."""
    out, k = [], 0
    for label in labels:
        for c in range(classes):
            prev, k = f"rb{k}", k + 1
            pairs = [(t, d) for t, ds in (("train", ("val", "test")), ("val", ("train", "test")), ("test", ("train", "val"))) for d in ds]
            pick = " ".join(f"when n_{t} = 0 and n_{d} > 1 then '{t} {d}'" for t, d in pairs)
            out.append(f"""cn{k} as (select count(*) filter (split = 'train') as n_train, count(*) filter (split = 'val') as n_val,
                       count(*) filter (split = 'test') as n_test from {prev} where {label} = {c}),
mv{k} as (select case {pick} end as p from cn{k}),
on{k} as (select scenario_id as moved from {prev}, mv{k} where split = split_part(p, ' ', 2) and {label} = {c} order by place limit 1),
rb{k} as materialized (select r.* replace (case when moved is null then split else split_part((select p from mv{k}), ' ', 1) end as split,
                                           case when moved is null then place else 1000000 + {k} end as place)
          from {prev} r left join on{k} on scenario_id = moved)""")
    return ",\n".join(out) + f",\nrebalanced as (select scenario_id, split from rb{k})"


register("split_rebalance", with_(SERIES, SPLIT, """rb0 as (select s.scenario_id, s.split, m.A_label, m.B_label, row_number() over (order by s.cls, s.rank) as place
          from split s join modes m using (scenario_id))""", moves(["A_label", "B_label"])) + "select * from rebalanced")


def rare(a: int, b: int, c: int) -> str:
    return f"case when scenario_id % {a} = 0 then 1 when scenario_id % {b} = 0 then 2 when scenario_id % {c} = 0 then 3 else 0 end"


register("rebalance_rare", with_(SERIES, SPLIT, f"""rb0 as (select scenario_id, split, {rare(61, 37, 23)} as R_label, {rare(29, 53, 41)} as S_label,
          row_number() over (order by cls, rank) as place from split)""", moves(["R_label", "S_label"])) + "select * from rebalanced")
