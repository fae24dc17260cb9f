"""MBG/NBD purchase model (Batislam, Denizel and Filiztekin 2007).

A customer buys at a gamma-distributed rate and may leave after any purchase, the first
included, with a beta-distributed chance p. Parameters: r, alpha (rate), a, b (leaving).

Given that a customer with x repeat purchases is still there at T, p follows
Beta(a, b + x + 1) and the rate Gamma(r + x, alpha + T), so the purchases expected in the next
t days are the mean over p of ``(1 - (1 + p t/(alpha+T))^-(r+x)) / p``. That integral is taken
directly: unlike the usual hypergeometric form it has no singular point at a = 1 and needs no
longer series for young customers. Its value without leaving, ``(r+x) t/(alpha+T)``, is taken out
first; the rest is smooth at p = 0, so the quadrature holds for any a. At a = 0 nobody leaves, whatever
b, and that value alone remains.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np

from loyalspan.functions.batches import Rows
from loyalspan.functions.sqltext import Number, let, ln_gamma, sql, struct_array, unit_interval_rule

NAMES = ("r", "alpha", "a", "b")
COLUMNS = ("x", "t_x", "T")
DAYS_PER_MONTH = 30
MONTHS_A_ROW = 6  # keeps the generated method small enough to be compiled, whatever the horizon

_RULE = unit_interval_rule()

Params = Mapping[str, Number]


def _unpack(params: Params) -> tuple[str, ...]:
    return tuple(sql(params[name]) for name in NAMES)


def _ln_leaving_odds(params: Params, x: str, t_x: str, T: str) -> str:
    """Log odds of having left: ln(a/(b+x) ((alpha+T)/(alpha+t_x))^(r+x))."""
    r, alpha, a, b = _unpack(params)
    ln_a = f"if({a} = 0D, double('-Infinity'), ln({a}))"
    return f"({ln_a} - ln({b} + {x}) + ({r} + {x})*(ln({alpha} + {T}) - ln({alpha} + {t_x})))"


def probability_alive(params: Params, x="frequency", t_x="recency", T="T") -> str:
    return f"(1 / (1 + exp({_ln_leaving_odds(params, x, t_x, T)})))"


def node_terms(params: Params, x: str = "x", T: str = "T") -> dict[str, str]:
    """Columns of one quadrature node (p, lp, lq, dw) of one customer, for ``node_shortfall``.

    v is the posterior density of p over p; a node's purchases are ``1 - (1 + y t)^k``.
    """
    r, alpha, a, b = _unpack(params)
    return {
        "v": f"if({a} = 0D, 0D, dw*exp({a}*lp + ({b} + 1 + {x})*lq - {_ln_beta(params, x)})/p)",
        "k": f"-({r} + {x})",
        "y": f"p/({alpha} + {T})",
    }


def node_shortfall(t: Number) -> str:
    """A node's purchases, less what they were without leaving."""
    return f"(k*y*{sql(t)} - expm1(k*log1p(y*{sql(t)})))"


def stayer_purchases(params: Params, t: Number, x: str = "x", T: str = "T") -> str:
    """What a customer who can not leave would buy in ``t`` days."""
    r, alpha, _, _ = _unpack(params)
    return f"(({r} + {x})*{sql(t)}/({alpha} + {T}))"


def discount_weights(months: int, rate: float) -> list[float]:
    """How much the purchases up to each month count, see ``discounted_if_alive``."""
    keep = 1 / (1 + rate)
    return [keep**i * rate * keep for i in range(1, months)] + [keep**months]


def month_blocks(plans: Mapping[str, tuple[int, float]]) -> str:
    """Months as constant rows of ``MONTHS_A_ROW``: the days before them and, per plan, their weights.

    A plan is (months, monthly rate); months after its end weigh nothing.
    """
    weights = {name: discount_weights(months, rate) for name, (months, rate) in plans.items()}
    longest = max(len(each) for each in weights.values())
    return struct_array(
        {
            "days_before": first * DAYS_PER_MONTH,
            **{
                weight_name(name, j): each[first + j] if first + j < len(each) else 0.0
                for name, each in weights.items()
                for j in range(MONTHS_A_ROW)
            },
        }
        for first in range(0, longest, MONTHS_A_ROW)
    )


def weight_name(plan: str, j: int) -> str:
    return f"{plan}_weight_{j}"


def node_discounted(plan: str) -> str:
    """The discounted sum of ``node_shortfall`` over the months of one row of ``month_blocks``."""
    return " + ".join(
        f"{weight_name(plan, j)}*{node_shortfall(f'(days_before + {DAYS_PER_MONTH * (j + 1)}D)')}"
        for j in range(MONTHS_A_ROW)
    )


def discounted_days(months: int, rate: float) -> float:
    """Days that ``stayer_purchases`` takes for the discounted sum over months."""
    weights = enumerate(discount_weights(months, rate), start=1)
    return sum(weight * DAYS_PER_MONTH * i for i, weight in weights)


def _ln_beta(params: Params, x: str) -> str:
    """Log of the beta function of the posterior of p, Beta(a, b + 1 + x)."""
    _, _, a, b = _unpack(params)
    c = f"({b} + 1 + {x})"
    return f"({ln_gamma(a)} + {ln_gamma(c)} - {ln_gamma(f'{a} + {c}')})"


def posterior_nodes(params: Params, x: str) -> str:
    """Nodes of the posterior of p: p, and v, its density over p."""
    _, _, a, b = _unpack(params)
    density = f"if({a} = 0D, 0D, n.dw*exp({a}*n.lp + ({b} + 1 + {x})*n.lq - ln_beta)/n.p)"
    nodes = f"transform({_RULE}, n -> named_struct('p', n.p, 'v', {density}))"
    return let("ln_beta", _ln_beta(params, x), nodes)


def _mean_over(params: Params, x: str, T: str, t: str) -> str:
    """The mean of ``(1 - (1 + p t/(alpha+T))^-(r+x)) / p`` over ``nodes``."""
    r, alpha, _, _ = _unpack(params)
    z = f"n.p*({t})/({alpha} + {T})"
    k = f"({r} + {x})"
    shortfall = f"aggregate(nodes, 0D, (s, n) -> s - n.v*({k}*{z} + expm1(-{k}*log1p({z}))))"
    return f"({k}*({t})/({alpha} + {T}) + {shortfall})"


def purchases_over_nodes(params: Params, t: Number, x="frequency", T="T") -> str:
    """``purchases_if_alive`` where ``nodes`` is already there."""
    return _mean_over(params, x, T, sql(t))


def purchases_if_alive(params: Params, t: Number, x="frequency", T="T") -> str:
    """Expected purchases in the next ``t`` days of a customer known to be alive."""
    return let("nodes", posterior_nodes(params, x), purchases_over_nodes(params, t, x, T))


def expected_purchases(params: Params, t: Number, x="frequency", t_x="recency", T="T") -> str:
    """Expected purchases in the next ``t`` days; ``t`` may be a column."""
    return f"({probability_alive(params, x, t_x, T)} * {purchases_if_alive(params, t, x, T)})"


def discounted_if_alive(params: Params, months: Number, rate: Number, x="frequency", T="T") -> str:
    """Discounted purchases over ``months`` months of 30 days, for a customer known to be alive.

    The published sum of (E_i - E_(i-1)) / (1+d)^i is taken by parts, so that every term is
    positive: E_i enters with d/(1+d)^(i+1), the last month with 1/(1+d)^months.
    """
    n = f"int({sql(months)})"
    d = sql(rate)
    factor = f"exp(-i*log1p({d})) * if(i = {n}, 1D, {d}/(1 + {d}))"
    total = (
        f"aggregate(sequence(1, {n}), 0D, (total, i) -> "
        f"total + {factor} * {_mean_over(params, x, T, f'{DAYS_PER_MONTH}D*i')})"
    )
    return f"if({n} < 1, 0D, {let('nodes', posterior_nodes(params, x), total)})"


def row_log_likelihood(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The part that depends on the row: its x, t_x and T."""
    r, alpha, a, b = (params[name] for name in NAMES)
    x = rows.columns["x"]
    ln_T = rows.ln("T", lambda T: alpha + T)
    ln_odds = (
        (math.log(a) if a else -math.inf)
        - rows.ln("x", lambda x: b + x)
        + (r + x) * (ln_T - rows.ln("t_x", lambda t_x: alpha + t_x))
    )
    return (
        rows.ln_gamma("x", lambda x: r + x)
        + rows.ln_gamma("x", lambda x: b + x + 1)
        - rows.ln_gamma("x", lambda x: a + b + x + 1)
        - (r + x) * ln_T
        + np.maximum(ln_odds, 0.0)
        + np.log1p(np.exp(-np.abs(ln_odds)))
    )


def constant_log_likelihood(params: Mapping[str, float]) -> float:
    """The part that is the same for every row."""
    r, alpha, a, b = (params[name] for name in NAMES)
    return r * math.log(alpha) - math.lgamma(r) - math.lgamma(b) + math.lgamma(a + b)


def leaving_slope(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The slope of a row's log-likelihood by a at a = 0, given b; x is a whole number."""
    r, alpha, b = (params[name] for name in ("r", "alpha", "b"))
    x = rows.columns["x"]
    left = (r + x) * (rows.ln("T", lambda T: alpha + T) - rows.ln("t_x", lambda t_x: alpha + t_x))

    def stayed(x: np.ndarray) -> np.ndarray:
        return np.array([np.sum(1 / (b + np.arange(int(each) + 1))) for each in x])

    return np.exp(left) / (b + x) - rows.each("x", stayed)
