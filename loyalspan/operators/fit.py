"""Maximum-likelihood fitting as a short series of Spark aggregates.

The optimiser asks for the mean log-likelihood at a handful of parameter points; one job answers
for all points at once. Tasks work out a batch of rows at every point as arrays and send on one sum a
point, and only one number per point returns to the driver. Several penalties are
fitted side by side in the same jobs; of many, a few are fitted first and the rest start between
their solutions.

A search that heads for the limit of a model (nobody leaves, all spend alike) fits the limit as a
model of its own and stays there if the likelihood does not rise on leaving it; the parameters gone to
the limit are then exact. Otherwise it goes on where it was.

Every fit says how it ended. Only one whose expected gain vanished inside the bounds has converged; one
at the limit is the optimum there, and a flat end means that a ridge of parameters fits alike.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspan.functions import gamma_gamma, mbg, nbd, pareto
from loyalspan.functions.batches import Rows
from loyalspan.session import materialise, ship, spread

STEP = 1e-3  # finite-difference step on the log scale
LOWEST, HIGHEST = -12.0, 30.0  # bounds of the log-parameters; reaching one is reported
ANCHORS = 10  # of more penalties than twice this, so many are fitted first
CONVERGED, AT_LIMIT, AT_BOUND, FLAT = "converged", "at limit", "at bound", "flat"
UNFINISHED, FAILED = "unfinished", "failed"
NEAR_ZERO, NEAR_INFINITY = math.exp(-8), 1e3  # beyond these a limit is tried


@dataclass(frozen=True)
class Likelihood:
    """How a model looks to the optimiser.

    ``by_row`` works out a batch of rows with ``columns``, ``constant`` is the part of the
    log-likelihood that is the same for every row, and ``in_days`` names the time-scaled
    parameters.
    """

    names: tuple[str, ...]
    columns: tuple[str, ...]
    by_row: Callable[[Mapping[str, float], Rows], np.ndarray]
    constant: Callable[[Mapping[str, float]], float]
    starts: tuple[tuple[float, ...], ...]
    in_days: tuple[str, ...] = ()
    limit: Limit | None = None


@dataclass(frozen=True)
class Limit:
    """What a likelihood becomes where the parameters ``gone`` have left for their limit.

    ``near`` tells from parameters and penalty that a search heads there, ``enter`` gives the point of
    the limit's ``model`` closest to them, and ``leave`` the parameters that stand for a point of the
    limit. The mean of ``slope`` is what the log-likelihood gains on leaving; it may use parameters of
    the search that the limit has no need of.
    """

    gone: tuple[str, ...]
    model: Likelihood
    near: Callable[[Mapping[str, float], float], bool]
    enter: Callable[[Mapping[str, float]], tuple[float, ...]]
    leave: Callable[[Mapping[str, float]], dict[str, float]]
    slope: Likelihood


def _slope(
    names: tuple[str, ...], columns: tuple[str, ...], by_row: Callable[[Mapping[str, float], Rows], np.ndarray]
) -> Likelihood:
    return Likelihood(names, columns, by_row, constant=lambda params: 0.0, starts=())


def _nobody_leaves(name: str, against: str, slope: Likelihood) -> Limit:
    """The limit where ``name`` vanishes, alone or in proportion to ``against``."""
    return Limit(
        gone=(name,),
        model=Likelihood(nbd.NAMES, nbd.COLUMNS, nbd.row_log_likelihood, nbd.constant_log_likelihood, starts=()),
        near=lambda params, l2: params[name] < NEAR_ZERO * max(1.0, params[against]),
        enter=lambda params: (params["r"], params["alpha"]),
        leave=lambda point: {**point, name: 0.0},
        slope=slope,
    )


ALL_ALIKE = Limit(
    gone=("q", "v"),
    model=_slope(gamma_gamma.ALIKE_NAMES, gamma_gamma.COLUMNS, gamma_gamma.alike_log_likelihood),
    # A penalty keeps q and v finite.
    near=lambda params, l2: l2 == 0 and params["q"] > NEAR_INFINITY,
    enter=lambda params: (params["p"], params["v"] / params["q"]),
    leave=lambda point: {"p": point["p"], "q": math.inf, "v": point["mu"]},
    slope=_slope(gamma_gamma.ALIKE_NAMES, gamma_gamma.COLUMNS, gamma_gamma.unlikeness_slope),
)
MBG = Likelihood(
    mbg.NAMES,
    mbg.COLUMNS,
    mbg.row_log_likelihood,
    mbg.constant_log_likelihood,
    starts=((0.3, 1.0, 3.0), (0.1, 0.6, 3.0), (0.1, 0.5, 1.5), (0.5, 2.0, 6.0)),
    in_days=("alpha",),
    limit=_nobody_leaves("a", "b", _slope(("r", "alpha", "b"), mbg.COLUMNS, mbg.leaving_slope)),
)
PARETO = Likelihood(
    pareto.NAMES,
    pareto.COLUMNS,
    pareto.row_log_likelihood,
    pareto.constant_log_likelihood,
    starts=((0.5, 2.0), (0.1, 0.6, 2.0), (0.2, 1.0), (1.0, 6.0)),
    in_days=("alpha", "beta"),
    limit=_nobody_leaves("s", "beta", _slope(("r", "alpha", "beta"), pareto.COLUMNS, pareto.leaving_slope)),
)
GAMMA_GAMMA = Likelihood(
    gamma_gamma.NAMES,
    gamma_gamma.COLUMNS,
    gamma_gamma.row_log_likelihood,
    gamma_gamma.constant_log_likelihood,
    starts=((0.1, 1.0, 3.0, 10.0), (0.1, 1.0, 3.0, 10.0), (0.01, 1.0, 100.0, 1e4, 1e6)),
    limit=ALL_ALIKE,
)


@dataclass(frozen=True)
class Fit:
    params: dict[str, float]
    l2: float
    log_likelihood: float
    iterations: int
    stop: str  # one of the endings above
    at_bound: tuple[str, ...] = ()
    gradient: float = math.nan  # largest slope of the objective by a log-parameter, bounds apart

    @property
    def converged(self) -> bool:
        return self.stop == CONVERGED


def _sums(model: Likelihood, points: Sequence[Mapping[str, float]]):
    """The weighted sums of a task: (id, total, weight) for every point that has any row."""
    columns, by_row = model.columns, model.by_row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(len(points)), np.zeros(len(points))
        met = np.zeros(len(points), dtype=bool)
        for batch in batches:
            batch = batch.drop_null()
            if not batch.num_rows:
                continue
            rows = Rows({name: batch.column(name).to_numpy() for name in columns})
            weights = batch.column("weight").to_numpy()
            with np.errstate(all="ignore"):
                for i, params in enumerate(points):
                    rows.start()
                    values = by_row(params, rows)
                    known = ~rows.unknown
                    met[i] |= known.any()
                    total[i] += np.sum((weights * values)[known])
                    weight[i] += np.sum(weights[known])
        ids = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(total[ids]), pa.array(weight[ids])], ["id", "total", "weight"]
        )

    return run


def mean_log_likelihood(
    rows: DataFrame, model: Likelihood, points: Sequence[Sequence[float]]
) -> np.ndarray:
    """Weighted mean log-likelihood of ``rows`` at each point, from one job.

    Rows without a likelihood (a null among their columns) count neither way.
    """
    ship(rows.sparkSession)
    named = [dict(zip(model.names, map(float, point))) for point in points]
    columns = [F.col(name).cast("double").alias(name) for name in (*model.columns, "weight")]
    sums = (
        rows.select(*columns)
        .mapInArrow(_sums(model, named), "id int, total double, weight double")
        .groupBy("id")
        .agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
        .collect()  # one row per point
    )
    values = np.full(len(points), -np.inf)
    for row in sums:
        total = row["total"]
        if math.isfinite(total):
            values[row["id"]] = total / row["weight"] + model.constant(named[row["id"]])
    return values


def _stencil(centre: np.ndarray) -> list[np.ndarray]:
    """The centre, one step each way per coordinate, and one joint step per pair."""
    unit = np.eye(len(centre)) * STEP
    points = [centre]
    points += [centre + u for u in unit] + [centre - u for u in unit]
    points += [centre + unit[i] + unit[j] for i, j in itertools.combinations(range(len(unit)), 2)]
    return points


def _derivatives(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian from the values on a stencil."""
    here, up, down = values[0], values[1 : 1 + size], values[1 + size : 1 + 2 * size]
    gradient = (up - down) / (2 * STEP)
    hessian = np.diag((up - 2 * here + down) / STEP**2)
    joint = values[1 + 2 * size :]
    for value, (i, j) in zip(joint, itertools.combinations(range(size), 2)):
        # (f(+i,+j) - f(+i) - f(+j) + f) with the third-order part of the single steps removed
        mixed = (value - up[i] - up[j] + here) / STEP**2
        hessian[i, j] = hessian[j, i] = mixed
    return gradient, hessian


@dataclass
class _Descent:
    """One penalised fit: a damped Newton search on the logarithms of the parameters."""

    l2: float
    trial: np.ndarray
    best: np.ndarray | None = None
    objective: float = math.inf
    damping: float = 1e-3
    gradient: np.ndarray | None = field(default=None, repr=False)
    hessian: np.ndarray | None = field(default=None, repr=False)
    iterations: int = 0
    quiet: int = 0  # accepted trials in a row with hardly any gain
    stop: str = ""
    tried: bool = False  # whether the limit of the model has been tried

    @property
    def done(self) -> bool:
        return bool(self.stop)

    def at_bounds(self) -> np.ndarray:
        return (self.best <= LOWEST) | (self.best >= HIGHEST)

    def penalty(self, log_params: np.ndarray) -> float:
        return self.l2 * float(np.sum(np.exp(2 * log_params)))

    def update(self, values: np.ndarray, tolerance: float) -> None:
        """Take the log-likelihoods on the trial's stencil and choose the next trial."""
        self.iterations += 1
        losses = np.array([self.penalty(p) - v for p, v in zip(_stencil(self.trial), values)])
        if np.all(np.isfinite(losses)) and losses[0] < self.objective:
            small = self.objective - float(losses[0]) < 100 * tolerance
            self.quiet = self.quiet + 1 if small else 0
            self.best, self.objective = self.trial, float(losses[0])
            self.gradient, self.hessian = _derivatives(losses, len(self.trial))
            self.damping = max(self.damping / 5, 1e-8)
        elif self.best is None:
            self.stop = FAILED
            return
        else:
            self.damping *= 10
        # Coordinates pressed against a bound stay there; the rest take a Newton step.
        free = ~(
            ((self.best <= LOWEST) & (self.gradient > 0))
            | ((self.best >= HIGHEST) & (self.gradient < 0))
        )
        step = np.zeros_like(self.best)
        if free.any():
            roots, axes = np.linalg.eigh(self.hessian[np.ix_(free, free)])
            curvature = np.abs(roots) + self.damping * max(np.abs(roots).max(), 1e-6)
            step[free] = -axes @ ((axes.T @ self.gradient[free]) / np.maximum(curvature, 1e-9))
            step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
            # Stop at the first bound, which keeps the direction downhill.
            room = np.where(step > 0, HIGHEST - self.best, LOWEST - self.best)
            moving = free & (step != 0)
            step *= min(1.0, (room[moving] / step[moving]).min(initial=1.0))
        self.trial = np.clip(self.best + step, LOWEST, HIGHEST)
        expected = float(self.gradient @ (self.best - self.trial))
        if expected < tolerance:
            self.stop = AT_BOUND if self.at_bounds().any() else CONVERGED
        elif self.quiet == 3:
            self.stop = FLAT

    def params(self, names: Sequence[str]) -> dict[str, float]:
        return dict(zip(names, map(float, np.exp(self.best))))

    def result(self, names: Sequence[str]) -> Fit:
        if self.best is None:
            return Fit(dict.fromkeys(names, math.nan), self.l2, math.nan, self.iterations, FAILED)
        bounds = self.at_bounds()
        return Fit(
            params=self.params(names),
            l2=self.l2,
            log_likelihood=self.penalty(self.best) - self.objective,
            iterations=self.iterations,
            stop=self.stop or UNFINISHED,
            at_bound=tuple(name for name, bound in zip(names, bounds) if bound),
            gradient=float(np.abs(self.gradient[~bounds]).max(initial=0.0)),
        )


def fit(
    rows: DataFrame,
    model: Likelihood,
    penalties: Sequence[float] = (0.0,),
    max_iterations: int = 60,
    tolerance: float = 1e-9,
) -> list[Fit]:
    """Minimise ``-mean log-likelihood + l2 * sum(params^2)`` for every penalty.

    ``rows`` has the model's columns and ``weight``; it is read once per iteration, so it should
    come from ``ready``. A fit that fails has NaN parameters.
    """
    starts = [np.log(start) for start in itertools.product(*model.starts)]
    values = mean_log_likelihood(rows, model, [np.exp(s) for s in starts])
    if not np.isfinite(values).any():
        raise ValueError("no usable rows to fit on")
    descents = []
    for l2 in penalties:
        blank = _Descent(l2, starts[0])
        losses = [blank.penalty(s) - v for s, v in zip(starts, values)]
        descents.append(_Descent(l2, starts[int(np.argmin(losses))]))

    ordered = sorted(descents, key=lambda d: d.l2)
    if len(ordered) > 2 * ANCHORS:
        picked = {round(i) for i in np.linspace(0, len(ordered) - 1, ANCHORS)}
        anchors = [ordered[i] for i in sorted(picked)]
        _descend(rows, model, anchors, max_iterations, tolerance)
        known = [d for d in anchors if d.best is not None]
        for descent in ordered:
            if not descent.iterations and known:
                at = [d.l2 for d in known]
                paths = zip(*(d.best for d in known))
                descent.trial = np.array([np.interp(descent.l2, at, path) for path in paths])
    _descend(rows, model, descents, max_iterations, tolerance)
    at_limit = _try_limit(rows, model, descents, max_iterations, tolerance)
    _descend(rows, model, descents, max_iterations, tolerance)
    return [at_limit.get(i) or d.result(model.names) for i, d in enumerate(descents)]


def _try_limit(
    rows: DataFrame, model: Likelihood, descents: Sequence[_Descent], max_iterations: int, tolerance: float
) -> dict[int, Fit]:
    """The fits, by number, whose optimum is at the limit of the model; the others near it go on."""
    limit = model.limit
    heading = {
        i: d
        for i, d in enumerate(descents)
        if limit and d.best is not None and limit.near(d.params(model.names), d.l2)
    }
    if not heading:
        return {}
    there = {
        i: _Descent(d.l2, np.log(limit.enter(d.params(model.names)))) for i, d in heading.items()
    }
    _descend(rows, limit.model, list(there.values()), max_iterations, tolerance)
    there = {i: d for i, d in there.items() if d.best is not None and d.stop in (CONVERGED, FLAT)}
    points = {i: {**heading[i].params(model.names), **d.params(limit.model.names)} for i, d in there.items()}
    slopes = {}
    if points:
        at = [[point[name] for name in limit.slope.names] for point in points.values()]
        slopes = dict(zip(points, mean_log_likelihood(rows, limit.slope, at)))
    found = {}
    for i, descent in heading.items():
        # Not finite: the slope is too steep for a number.
        if i in slopes and math.isfinite(slopes[i]) and slopes[i] <= 0:
            end = there[i].result(limit.model.names)
            found[i] = replace(
                end,
                params={name: {**points[i], **limit.leave(end.params)}[name] for name in model.names},
                iterations=descent.iterations + end.iterations,
                stop=AT_LIMIT if end.converged else end.stop,
                at_bound=limit.gone,
            )
        else:
            descent.tried = True
            if descent.stop == AT_BOUND and not descent.at_bounds().any():
                descent.stop = ""
    return found


def _descend(
    rows: DataFrame, model: Likelihood, descents: Sequence[_Descent], max_iterations: int, tolerance: float
) -> None:
    """Let all descents that are not done take steps, in the same jobs."""
    for _ in range(max_iterations):
        active = [d for d in descents if not d.done]
        if not active:
            break
        stencils = [_stencil(d.trial) for d in active]
        width = len(stencils[0])
        values = mean_log_likelihood(rows, model, [np.exp(p) for s in stencils for p in s])
        for i, descent in enumerate(active):
            descent.update(values[i * width : (i + 1) * width], tolerance)
            heads_off = model.limit and not (descent.tried or descent.done)
            if heads_off and model.limit.near(descent.params(model.names), descent.l2):
                descent.stop = AT_BOUND


def fit_purchases(
    rows: DataFrame, model: Likelihood, penalties: Sequence[float] = (0.0,), **options
) -> list[Fit]:
    """Fit a purchase model to rows of (x, t_x, T, weight), times in days.

    Times are scaled so that the longest tenure is 10 before the penalty is applied, and the
    day-based parameters are scaled back.
    """
    longest = rows.agg(F.max("T").alias("longest")).first()["longest"]
    if not longest:
        raise ValueError("no usable rows to fit on")
    scale = 10.0 / float(longest)
    scaled = rows.select(
        "x", (F.col("t_x") * scale).alias("t_x"), (F.col("T") * scale).alias("T"), "weight"
    )
    fits = fit(scaled, model, penalties, **options)
    return [
        replace(f, params={k: v / scale if k in model.in_days else v for k, v in f.params.items()})
        for f in fits
    ]


def ready(rows: DataFrame) -> DataFrame:
    """Rows written once and spread evenly, for the passes of a fit.

    The rows are few and small after grouping but each is met by many parameter points, so they
    must not be coalesced into a handful of tasks.
    """
    return materialise(spread(rows))


def purchase_rows(
    df: DataFrame, x="frequency_cal", t_x="recency_cal", T="T_cal"
) -> DataFrame:
    """Customers with the same purchase history counted together: (x, t_x, T, weight)."""
    return (
        df.groupBy(
            F.col(x).cast("double").alias("x"),
            F.col(t_x).cast("double").alias("t_x"),
            F.col(T).cast("double").alias("T"),
        )
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def spend_rows(df: DataFrame, x="frequency_cal", m="monetary_value_cal") -> DataFrame:
    """Repeat buyers with a positive average, equal ones counted together: (x, m, weight)."""
    buyers = df.where((F.col(x) > 0) & (F.col(m) > 0))
    return buyers.groupBy(F.col(x).cast("double").alias("x"), F.col(m).cast("double").alias("m")).agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
