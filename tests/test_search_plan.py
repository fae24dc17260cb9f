"""The adaptive penalty search on curves whose best place is known, and its journal."""

import math

import numpy as np
import pytest

from loyalspan.plans import search
from loyalspan.session import scratch_path

CURVES = {
    "middle": lambda x: (x - 0.37) ** 2,
    "edge": lambda x: x,
    "kink": lambda x: abs(x - 0.81) + 0.1 * math.sin(40 * x),
    "flat": lambda x: 5.0,
    "large": lambda x: 174_000 + 900 * (x - 0.02) ** 2,
}
SCHEMA = "trial int, l2 double, stop string, p double, rmse double"


def losses(spark, curve, met=None, failing=()):
    def run(penalties):
        if met is not None:
            met.extend(penalties)
        rows = [
            (i, l2, "failed" if i in failing else "converged", l2, None if i in failing else curve(l2))
            for i, l2 in enumerate(penalties)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return run


def trials_of(curve, trials, seed):
    """The search without Spark."""
    done = []
    start = np.random.default_rng(seed).uniform(0, 1, search.FIRST).tolist()
    while len(done) < trials:
        wanted = start if not done else search.propose(done, search.BATCH, seed)
        done += [search.Trial(len(done) + i, x, "converged", {}, curve(x)) for i, x in enumerate(wanted)]
    return done


@pytest.mark.parametrize("name", sorted(set(CURVES) - {"kink"}))
def test_fewer_trials_do_as_well_as_uniform_draws(name):
    curve = CURVES[name]
    for seed in (1, 7, 42):
        uniform = min(curve(x) for x in np.random.default_rng(seed).uniform(0, 1, 100))
        found = search.winner(trials_of(curve, search.TRIALS, seed))
        assert found.loss <= uniform + 1e-12


def test_a_curve_of_many_dips_is_searched_nearly_as_well():
    # With several dips, sixty trials may miss the deepest point of a hundred draws, by little.
    curve = CURVES["kink"]
    for seed in (1, 7, 42):
        uniform = min(curve(x) for x in np.random.default_rng(seed).uniform(0, 1, 100))
        assert search.winner(trials_of(curve, search.TRIALS, seed)).loss <= uniform + 0.01


def test_proposals_repeat_and_stay_inside():
    done = trials_of(CURVES["edge"], 30, 3)
    one = search.propose(done, 10, 3)
    assert one == search.propose(done, 10, 3) != search.propose(done, 10, 4)
    assert all(0 < x < 1 for x in one) and len(set(one)) == 10
    assert np.mean(one) < 0.3
    assert len(search.propose([], 4, 3)) == 4


def test_failed_trials_never_win():
    bad = [
        search.Trial(0, 0.5, "failed", {}, None),
        search.Trial(1, 0.4, "unfinished", {}, 1.0),
        search.Trial(2, 0.3, "converged", {}, math.nan),
    ]
    good = search.Trial(3, 0.2, "flat", {}, 250_000.0)
    assert search.winner([*bad, good]) is good
    with pytest.raises(search.NoTrial):
        search.winner(bad)


def test_a_killed_search_goes_on(spark):
    curve = CURVES["middle"]
    whole = search.search_penalty(losses(spark, curve), ["p"], search.Journal(spark, None, "a"), 14, 6, 4)
    path = scratch_path(spark, "journal")

    def dies(penalties):
        if len(met) >= 10:
            raise KeyboardInterrupt
        return losses(spark, curve, met)(penalties)

    met = []
    with pytest.raises(KeyboardInterrupt):
        search.search_penalty(dies, ["p"], search.Journal(spark, path, "a"), 14, 6, 4)
    assert len(met) == 10
    journal = search.Journal(spark, path, "a")
    assert [t.number for t in journal.read()] == list(range(10))
    met = []
    again = search.search_penalty(losses(spark, curve, met), ["p"], journal, 14, 6, 4)
    assert len(met) == 4 and again == whole
    met = []
    assert search.search_penalty(losses(spark, curve, met), ["p"], journal, 14, 6, 4) == whole and met == []
    # Another search does not see these trials.
    assert search.Journal(spark, path, "b").read() == []


def test_penalties_without_a_row_have_failed(spark):
    def some(penalties):
        return losses(spark, CURVES["edge"])(penalties).where("trial <> 1")

    found = search.search_penalty(some, ["p"], search.Journal(spark, None, "a"), 3, 3, 3)
    assert [t.finished for t in found] == [True, False, True]
    assert found[1].stop == "failed" and math.isnan(found[1].params["p"])


def test_fingerprints_tell_tables_apart(spark):
    one = spark.createDataFrame([(1, 2.0), (2, 3.0)], "a int, b double")
    same = spark.createDataFrame([(2, 3.0), (1, 2.0)], "a int, b double")
    other = spark.createDataFrame([(1, 2.0), (2, 4.0)], "a int, b double")
    assert search.fingerprint(one, seed=1) == search.fingerprint(same, seed=1)
    assert len({search.fingerprint(one, seed=1), search.fingerprint(one, seed=2), search.fingerprint(other, seed=1)}) == 3
