"""Gamma-Gamma spend model (Fader and Hardie 2013). Parameters: p, q, v.

Customers differ in scale by an inverse gamma distribution (q, v). Where they are all alike q and v
leave for infinity together; that limit is a model of its own with parameters p and mu = v/q. Its
purchases are Gamma(p) times mu, and it is stored as (p, infinity, mu).
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np

from loyalspan.functions.batches import Rows
from loyalspan.functions.sqltext import Number, sql

NAMES = ("p", "q", "v")
ALIKE_NAMES = ("p", "mu")
COLUMNS = ("x", "m")

Params = Mapping[str, Number]


def expected_spend(params: Params, x="frequency", m="monetary_value") -> str:
    """Expected spend per purchase of a customer with ``x`` repeat purchases averaging ``m``."""
    p, q, v = (sql(params[name]) for name in NAMES)
    own = f"({p}*({v} + {x}*{m}) / nullif({p}*{x} + {q} - 1, 0D))"
    alike = f"({p}*({v} + 0D*{x}*{m}))"  # the same for all who have a history
    if isinstance(params["q"], str):
        return f"if({q} = double('Infinity'), {alike}, {own})"
    return alike if math.isinf(params["q"]) else own


def row_log_likelihood(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The part of the log-likelihood that depends on the row; needs x > 0 and m > 0."""
    p, q, v = (params[name] for name in NAMES)
    x, m = rows.columns["x"], rows.columns["m"]
    return (
        rows.ln_gamma("x", lambda x: p * x + q)
        - rows.ln_gamma("x", lambda x: p * x)
        + (p * x - 1) * rows.ln("m", lambda m: m)
        + p * x * rows.ln("x", lambda x: x)
        - (p * x + q) * rows.ln_of(x * m + v)
    )


def constant_log_likelihood(params: Mapping[str, float]) -> float:
    """The part that is the same for every row."""
    return params["q"] * math.log(params["v"]) - math.lgamma(params["q"])


def alike_log_likelihood(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """``row_log_likelihood`` of the limit, its constant included."""
    p, mu = (params[name] for name in ALIKE_NAMES)
    x, m = rows.columns["x"], rows.columns["m"]
    return (
        p * x * rows.ln("x", lambda x: x / mu)
        - rows.ln_gamma("x", lambda x: p * x)
        + (p * x - 1) * rows.ln("m", lambda m: m)
        - x * m / mu
    )


def unlikeness_slope(params: Mapping[str, float], rows: Rows) -> np.ndarray:
    """The slope of a row's log-likelihood by 1/q at q = infinity, v/q held: is the spread too wide?"""
    p, mu = (params[name] for name in ALIKE_NAMES)
    x, m = rows.columns["x"], rows.columns["m"]
    return ((x * m / mu - p * x) ** 2 - p * x) / 2
