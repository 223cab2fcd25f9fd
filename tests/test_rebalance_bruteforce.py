"""X2 against a plain list-based transcription of the rule on the driver's series (scenario modes)."""

import os

import pytest

from scenaria.operators import split as splitting
from scenaria.operators import stats
from scenaria.plans import views

SPLITS = ("train", "val", "test")
DONORS = {"train": ("val", "test"), "val": ("train", "test"), "test": ("train", "val")}


def brute(lists, modes, secondary, n_classes=6):
    lists = {k: list(v) for k, v in lists.items()}
    for label in secondary:
        for c in range(n_classes):
            cnt = {s: sum(1 for sid in lists[s] if modes[sid][label] == c) for s in SPLITS}
            if sum(cnt.values()) == 0 or all(cnt.values()):
                continue
            moved = False
            for target in SPLITS:
                if cnt[target] != 0 or moved:
                    continue
                for d in DONORS[target]:
                    if cnt[d] > 1:
                        sid = next(x for x in lists[d] if modes[x][label] == c)
                        lists[d].remove(sid)
                        lists[target].append(sid)
                        moved = True
                        break
    return {sid: s for s in SPLITS for sid in lists[s]}


@pytest.mark.parametrize("sf,primary", [("/root/testdata/sf0.01", "C_label"), ("/root/testdata/sf0.001", "B_label"),
                                        ("/root/testdata/sf0.01", "A_label")])
def test_rebalance_matches_bruteforce(spark, sf, primary):
    if not os.path.isdir(sf):
        pytest.skip("driver tables absent")
    labels = ["A_label", "B_label", "C_label"]
    s = views.series(spark, sf)
    modes_df = stats.scenario_modes(s, "scenario_id", labels)
    sp = splitting.scenario_split(s, "scenario_id", primary)
    rows = sp.orderBy("cls", "rank").collect()
    lists = {k: [r.scenario_id for r in rows if r.split == k] for k in SPLITS}
    modes = {r.scenario_id: r.asDict() for r in modes_df.collect()}
    out, moves = splitting.rebalance(sp, modes_df, "scenario_id", labels, primary)
    got = {r.scenario_id: r.split for r in out.collect()}
    exp = brute(lists, modes, [l for l in labels if l != primary])
    assert got == exp
