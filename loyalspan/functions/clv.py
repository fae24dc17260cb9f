"""Customer lifetime value: discounted expected purchases times expected spend."""

from __future__ import annotations

from loyalspan.functions import gamma_gamma, mbg
from loyalspan.functions.sqltext import Number, let

SCORE_HORIZONS = (30, 365, 730)  # days


def lifetime_value(
    purchase_model: mbg.Params,
    spend_model: gamma_gamma.Params,
    months: Number,
    rate: Number,
    x="frequency",
    t_x="recency",
    T="T",
    m="monetary_value",
) -> str:
    alive = mbg.probability_alive(purchase_model, x, t_x, T)
    purchases = mbg.discounted_if_alive(purchase_model, months, rate, x, T)
    return f"({gamma_gamma.expected_spend(spend_model, x, m)} * {alive} * {purchases})"


def purchase_scores(purchase_model: mbg.Params, x="frequency", t_x="recency", T="T") -> str:
    """``[alive, purchases in 30, 365, 730 days]`` as an array of floats."""
    horizons = [mbg.purchases_over_nodes(purchase_model, t, x, T) for t in SCORE_HORIZONS]
    values = ", ".join(["alive"] + [f"alive*{h}" for h in horizons])
    body = let("nodes", mbg.posterior_nodes(purchase_model, x), f"cast(array({values}) as array<float>)")
    return let("alive", mbg.probability_alive(purchase_model, x, t_x, T), body)
