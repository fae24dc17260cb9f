"""Pareto/NBD purchase model (Schmittlein, Morrison and Colombo 1987).

A customer buys at a gamma-distributed rate (r, alpha) until an exponentially distributed
lifetime with a gamma-distributed rate (s, beta) ends. The one awkward part is the chance of
having left between the last purchase and T,

    s * integral over (t_x, T) of (alpha+u)^-(r+x) (beta+u)^-(s+1) du.

With m = min(alpha, beta) and q = ((m+u)/(m+t_x))^-(r+s+x) the integrand becomes a bounded,
monotone function of q, which Gauss-Legendre handles after one more power substitution.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np

from loyalspan.functions.batches import Rows
from loyalspan.functions.sqltext import Number, legendre_rule, let, sql

NAMES = ("r", "alpha", "s", "beta")
COLUMNS = ("x", "t_x", "T")

_RULE = legendre_rule(20)
_POWER = 8  # flattens the root singularity at q = 0

Params = Mapping[str, Number]


def _unpack(params: Params) -> tuple[str, ...]:
    return tuple(sql(params[name]) for name in NAMES)


def leaving_terms(params: Params, x: str, t_x: str, T: str) -> dict[str, str]:
    """What ``leaving_odds`` needs of a row: the integral's start, shape and scale."""
    r, alpha, s, beta = _unpack(params)
    low, high = f"least({alpha}, {beta})", f"greatest({alpha}, {beta})"
    k = f"({r} + {x} + {s})"
    start = f"exp(-{k}/{_POWER}D*(ln({low} + {T}) - ln({low} + {t_x})))"
    height = (
        f"exp(({r} + {x})*ln({alpha} + {T}) + {s}*ln({beta} + {T}) - {k}*ln({low} + {t_x}))"
    )
    return {
        "start": start,
        "gap": f"({high} - {low})/({low} + {t_x})",
        "power": f"if({beta} >= {alpha}, {s} + 1, {r} + {x})",
        "root": f"{_POWER}D/{k}",
        "scale": f"{s}/{k} * {height} * {_POWER}*(1 - {start})",
    }


def leaving_odds(at: str = "") -> str:
    """Odds of having left, from the columns of ``leaving_terms`` or from fields of ``at``."""

    def term(u: float, w: float) -> str:
        node = f"({at}start + (1 - {at}start)*{sql(u)})"
        bend = f"ln(1 + {at}gap*pow({node}, {at}root))"
        return f"{sql(w)}*pow({node}, {_POWER - 1}D)*exp(-{at}power*{bend})"

    return f"({at}scale * ({' + '.join(term(u, w) for u, w in _RULE)}))"


def _row_odds(params: Params, x: str, t_x: str, T: str) -> str:
    terms = leaving_terms(params, x, t_x, T)
    fields = ", ".join(f"'{name}', {text}" for name, text in terms.items())
    return let("v", f"named_struct({fields})", leaving_odds("v."))


def probability_alive(params: Params, x="frequency", t_x="recency", T="T") -> str:
    return f"(1 / (1 + {_row_odds(params, x, t_x, T)}))"


def expected_purchases(params: Params, t: Number, x="frequency", t_x="recency", T="T") -> str:
    """Expected purchases in the next ``t`` days; ``t`` may be a column."""
    r, alpha, s, beta = _unpack(params)
    span = f"(ln({beta} + {T} + {sql(t)}) - ln({beta} + {T}))"
    still_there = f"if(abs({s} - 1) < 1e-12D, {span}, -expm1(-({s} - 1)*{span})/({s} - 1))"
    alive = probability_alive(params, x, t_x, T)
    return f"(({r} + {x})*({beta} + {T})/({alpha} + {T}) * {still_there} * {alive})"


def _batch_odds(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """``leaving_odds`` of a batch."""
    r, alpha, s, beta = (params[name] for name in NAMES)
    low, high = min(alpha, beta), max(alpha, beta)
    x, t_x = rows.columns["x"], rows.columns["t_x"]
    k = r + x + s
    ln_first = rows.ln("t_x", lambda t_x: low + t_x)
    start = np.exp(-k / _POWER * (rows.ln("T", lambda T: low + T) - ln_first))
    height = np.exp(
        (r + x) * rows.ln("T", lambda T: alpha + T) + s * rows.ln("T", lambda T: beta + T) - k * ln_first
    )
    gap = (high - low) / (low + t_x)
    power = s + 1 if beta >= alpha else r + x
    root = _POWER / k
    total = np.zeros_like(start)
    for u, w in _RULE:
        node = start + (1 - start) * u
        bend = np.log(1 + gap * np.exp(root * np.log(node)))
        square = node * node
        total += w * (square * square * square * node) * np.exp(-power * bend)
    return s / k * height * _POWER * (1 - start) * total


def row_log_likelihood(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The part that depends on the row: its x, t_x and T."""
    r, alpha, s, beta = (params[name] for name in NAMES)
    x = rows.columns["x"]
    return (
        rows.ln_gamma("x", lambda x: r + x)
        - (r + x) * rows.ln("T", lambda T: alpha + T)
        - s * rows.ln("T", lambda T: beta + T)
        + rows.log1p_of(_batch_odds(params, rows))
    )


def constant_log_likelihood(params: Mapping[str, float]) -> float:
    """The part that is the same for every row."""
    r, alpha, s, beta = (params[name] for name in NAMES)
    return r * math.log(alpha) + s * math.log(beta) - math.lgamma(r)


def leaving_slope(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The slope of a row's log-likelihood by s at s = 0, given beta."""
    tiny = 1e-9  # the odds of having left are s times a function that is smooth at 0
    beta = params["beta"]
    odds = _batch_odds({**params, "s": tiny}, rows)
    return odds / tiny - rows.ln("T", lambda T: (beta + T) / beta)
