"""A penalty search that learns from earlier losses and goes on after a lost driver.

The first penalties are seeded uniform draws. Then each batch is proposed by a Parzen estimator: the
better part (``BETTER``) of the finished trials and the others give two densities on (0, 1), and of many draws
from the first those with the largest ratio are tried. A batch is fitted in the same jobs, so there
are few rounds, and each depends on the trials before it only: a search with one seed repeats itself.

Finished trials are appended to a journal, batch by batch, under the name of the search. A search that
is started again reads them and goes on where it ended.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.operators.fit import FAILED, UNFINISHED

TRIALS = 60
FIRST = 20
BATCH = 10
DRAWN = 64  # draws from the better density for each penalty that is tried
BETTER = 0.15
SEED = 42

JOURNAL_SCHEMA = (
    "search string, number int, l2 double, stop string, params map<string,double>, loss double"
)


@dataclass(frozen=True)
class Trial:
    number: int
    l2: float
    stop: str
    params: dict[str, float]
    loss: float | None

    @property
    def finished(self) -> bool:
        """Whether the trial may win: its fit came to an end and has a loss."""
        return self.stop not in (FAILED, UNFINISHED) and self.loss is not None and math.isfinite(self.loss)


class NoTrial(RuntimeError):
    """No trial of a search has come to an end."""


def winner(trials: Sequence[Trial]) -> Trial:
    """The finished trial with the smallest loss, the first on a tie."""
    finished = [trial for trial in trials if trial.finished]
    if not finished:
        raise NoTrial("no trial of the search has come to an end")
    return min(finished, key=lambda t: (t.loss, t.number))


def _density(at: np.ndarray, centres: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Of normal bumps cut off at 0 and 1, and a flat one that keeps every place possible."""


    def below(x):
        return 0.5 * (1 + np.vectorize(math.erf)(x / math.sqrt(2)))

    inside = below((1 - centres) / widths) - below(-centres / widths)
    bumps = np.exp(-0.5 * ((at[:, None] - centres) / widths) ** 2) / (widths * math.sqrt(2 * math.pi) * inside)
    return (bumps.sum(axis=1) + 1.0) / (len(centres) + 1)


def _widths(centres: np.ndarray) -> np.ndarray:
    """The larger distance to a neighbour (or to the end of the range), within limits."""
    order = np.argsort(centres)
    padded = np.concatenate([[0.0], centres[order], [1.0]])
    gaps = np.maximum(np.diff(padded)[:-1], np.diff(padded)[1:])
    widths = np.empty_like(centres)
    widths[order] = np.clip(gaps, 1.0 / (40 * (len(centres) + 1)), 1.0)
    return widths


def propose(trials: Sequence[Trial], count: int, seed: int = SEED) -> list[float]:
    """The next ``count`` penalties, given all trials so far."""
    draw = np.random.default_rng([seed, len(trials)])
    finished = sorted((t for t in trials if t.finished), key=lambda t: (t.loss, t.number))
    cut = max(1, math.ceil(BETTER * len(finished)))
    better = np.array([t.l2 for t in finished[:cut]])
    others = np.array([t.l2 for t in trials if t not in finished[:cut]])
    if not len(better) or not len(others):
        return [float(u) for u in draw.uniform(0.0, 1.0, count)]
    widths = _widths(better)
    chosen: list[float] = []
    taken = others
    while len(chosen) < count:
        picks = draw.integers(0, len(better) + 1, DRAWN)
        flat = draw.uniform(0.0, 1.0, DRAWN)
        bump = np.minimum(picks, len(better) - 1)
        near = np.abs(better[bump] + widths[bump] * draw.standard_normal(DRAWN))
        near = 1 - np.abs(1 - near)  # thrown back from both ends
        places = np.where((picks == len(better)) | (near <= 0) | (near >= 1), flat, near)
        ratio = _density(places, better, widths) / _density(places, taken, _widths(taken))
        chosen.append(float(places[np.argmax(ratio)]))
        # What is tried in this batch counts as met, so that the batch spreads.
        taken = np.append(taken, chosen[-1])
    return chosen


class Journal:
    """The finished trials of searches, as a table under ``path``; none without a path."""

    def __init__(self, spark: SparkSession, path: str | None, search: str):
        self.spark, self.path, self.search = spark, path, search
        if path:
            spark.createDataFrame([], JOURNAL_SCHEMA).write.mode("ignore").parquet(path)

    def read(self) -> list[Trial]:
        """The trials of this search by number; of a batch that was written twice, once."""
        if not self.path:
            return []
        rows = self.spark.read.schema(JOURNAL_SCHEMA).parquet(self.path).where(F.col("search") == self.search)
        found = {r.number: Trial(r.number, r.l2, r.stop, dict(r.params), r.loss) for r in rows.collect()}
        return [found[number] for number in sorted(found)]

    def append(self, trials: Sequence[Trial]) -> None:
        if self.path:
            rows = [(self.search, *asdict(t).values()) for t in trials]
            self.spark.createDataFrame(rows, JOURNAL_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def fingerprint(rows: DataFrame, **settings) -> str:
    """Names a search: the rows it is fitted on, whatever their order, and its settings."""
    mixed = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))
    count, total = rows.agg(F.count("*"), mixed).first()
    return f"{count}:{total}:{json.dumps(settings, sort_keys=True)}"


def search_penalty(
    losses: Callable[[Sequence[float]], DataFrame],
    names: Sequence[str],
    journal: Journal,
    trials: int = TRIALS,
    first: int = FIRST,
    batch: int = BATCH,
    seed: int = SEED,
) -> list[Trial]:
    """All trials of a search, at most ``trials``; see :func:`winner`.

    ``losses`` fits one model per penalty and returns (trial, l2, stop, ``names``, rmse), a row each; a
    penalty without a row has failed. Trials that the journal holds are not fitted again.
    """
    done = journal.read()
    start = [float(u) for u in np.random.default_rng(seed).uniform(0.0, 1.0, min(first, trials))]
    while len(done) < trials:
        if len(done) < len(start):
            wanted = start[len(done) :]
        else:
            wanted = propose(done, min(batch, trials - len(done)), seed)
        rows = {row["trial"]: row for row in losses(wanted).collect()}
        new = []
        for i, l2 in enumerate(wanted):
            row = rows.get(i)
            params = {name: math.nan if row is None else row[name] for name in names}
            stop, loss = (FAILED, None) if row is None else (row["stop"], row["rmse"])
            new.append(Trial(len(done) + i, l2, stop, params, loss))
        journal.append(new)
        done += new
    return done
