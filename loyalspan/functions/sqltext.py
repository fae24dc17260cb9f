"""Helpers to write model formulas as SQL text.

The models are kept as SQL text because the same formula is used three ways: as a column of a
DataFrame (``F.expr``), as the body of a registered SQL function, and with model parameters
taken either from literals or from columns of the row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

import numpy as np

Number = float | int | str


def sql(value: Number) -> str:
    """A double literal for a number; text (a column name or expression) as it is."""
    if isinstance(value, str):
        return value
    if math.isinf(value):
        return f"double('{'-' * (value < 0)}Infinity')"
    literal = repr(float(value)) + "D"
    return f"({literal})" if value < 0 else literal


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` inside ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def struct_array(rows: Iterable[Mapping[str, float]]) -> str:
    """A constant array of structs; Catalyst folds it to one literal."""
    return "array({})".format(
        ", ".join(
            "named_struct({})".format(", ".join(f"'{k}', {sql(float(v))}" for k, v in row.items()))
            for row in rows
        )
    )


def ln_gamma(z: str) -> str:
    """Log-gamma for z > 0: Stirling's series after moving the argument up by eight."""
    product = " * ".join([f"({z})"] + [f"(({z}) + {k})" for k in range(1, 8)])
    y = f"(({z}) + 8)"
    tail = f"(1/12D - (1/360D - (1/1260D - 1/1680D/({y}*{y}))/({y}*{y}))/({y}*{y}))/{y}"
    return f"(({y} - 0.5D)*ln({y}) - {y} + 0.5D*ln(2D*pi()) + {tail} - ln({product}))"


def unit_interval_rule(points: int = 72, left: float = 6.0, right: float = 3.8, pitch: float = 1.5) -> str:
    """A double-exponential rule for integrals of ``p^(a-1) (1-p)^(c-1) f(p)`` over (0, 1).

    Each node holds p, ln p, ln(1-p) and its weight without the beta density. The left end is
    cut at ln p = -302, so the integrand has to vanish there like a power of p that is not tiny.
    """
    s, step = np.linspace(-left, right, points, retstep=True)
    w = pitch * np.sinh(s)
    ln_p, ln_q = -np.logaddexp(0, -w), -np.logaddexp(0, w)
    return struct_array(
        {"p": float(np.exp(lp)), "lp": lp, "lq": lq, "dw": dw}
        for lp, lq, dw in zip(ln_p, ln_q, pitch * np.cosh(s) * step)
    )


def legendre_rule(points: int) -> list[tuple[float, float]]:
    """Gauss-Legendre nodes and weights on (0, 1)."""
    u, w = np.polynomial.legendre.leggauss(points)
    return [((x + 1) / 2, y / 2) for x, y in zip(u.tolist(), w.tolist())]
