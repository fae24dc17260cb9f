"""The scoring functions under SQL names, as temporary SQL functions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from loyalspan.functions import gamma_gamma, mbg
from loyalspan.functions.clv import lifetime_value, purchase_scores

CLV = "clv"
PROBABILITY_ALIVE = "probability_alive"


def register_functions(
    spark: SparkSession,
    purchase_model: mbg.Params,
    spend_model: gamma_gamma.Params,
    replace: bool = False,
) -> list[str]:
    """Register ``clv`` and ``probability_alive`` if they are missing; return the names added."""
    value = lifetime_value(purchase_model, spend_model, "months", "rate")
    scores = purchase_scores(purchase_model)
    history = "frequency DOUBLE, recency DOUBLE, T DOUBLE"
    statements = {
        CLV: f"{CLV}({history}, monetary_value DOUBLE, months INT, rate DOUBLE) "
        f"RETURNS DOUBLE RETURN {value}",
        PROBABILITY_ALIVE: f"{PROBABILITY_ALIVE}({history}) "
        f"RETURNS ARRAY<FLOAT> RETURN {scores}",
    }
    added = []
    for name, statement in statements.items():
        if replace or not spark.catalog.functionExists(name):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {statement}")
            added.append(name)
    return added
