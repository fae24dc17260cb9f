"""Purchase expectations for whole tables.

Given that a customer is alive, what an MBG/NBD model expects depends on frequency and tenure
only. It is worked out once per distinct pair, a number bounded by the calendar rather than by
the customers, and joined back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspan.functions import mbg
from loyalspan.functions.sqltext import Number, unit_interval_rule
from loyalspan.session import spread


def purchase_outlook(
    pairs: DataFrame,
    model: mbg.Params,
    horizons: Mapping[str, Number],
    discounted: Mapping[str, tuple[int, float]] | None = None,
) -> DataFrame:
    """Expected purchases if alive, for each distinct row of (x, T, ...).

    ``horizons`` maps an output to days ahead (a number or one of the columns of ``pairs``),
    ``discounted`` maps an output to (months, monthly rate).

    Each pair meets the constant lists of quadrature nodes and of months, a few months a row, and the
    sums are a plain aggregate; the rows are already partitioned by the pair, so only the pairs are
    shuffled. The generated code does not grow with the number of months.
    """
    plans = {name: plan for name, plan in (discounted or {}).items() if plan[0] > 0}
    keys = pairs.columns
    at_node = {name: mbg.node_shortfall(days) for name, days in horizons.items()}
    without_leaving = {name: mbg.stayer_purchases(model, days) for name, days in horizons.items()}
    for name, (months, rate) in (discounted or {}).items():
        at_node[name] = mbg.node_discounted(name) if name in plans else "0D"
        days = mbg.discounted_days(months, rate) if name in plans else 0
        without_leaving[name] = mbg.stayer_purchases(model, days)
    terms = mbg.node_terms(model)
    nodes = (
        spread(pairs.distinct(), *keys)
        .select(*keys, F.inline(F.expr(unit_interval_rule())))
        .select(*keys, "p", *[F.expr(text).alias(name) for name, text in terms.items()])
    )
    if plans:
        nodes = nodes.select("*", F.inline(F.expr(mbg.month_blocks(plans))))
        for name in horizons:
            at_node[name] = f"if(days_before = 0D, {at_node[name]}, 0D)"
    nodes = nodes.select(*keys, "v", *[F.expr(text).alias(name) for name, text in at_node.items()])
    sums = nodes.groupBy(*keys).agg(*[F.sum(F.col("v") * F.col(name)).alias(name) for name in at_node])
    return sums.select(
        *keys, *[(F.expr(text) + F.col(name)).alias(name) for name, text in without_leaving.items()]
    )


def with_purchases(
    customers: DataFrame,
    model: mbg.Params,
    horizons: Mapping[str, Number],
    discounted: Mapping[str, tuple[int, float]] | None = None,
    x: str = "frequency",
    t_x: str = "recency",
    T: str = "T",
) -> DataFrame:
    """``customers`` with ``alive`` and the expected purchases of each output.

    Customers without a history keep their row, with null results.
    """
    by_column = [t for t in horizons.values() if isinstance(t, str)]
    keys = ["x", "T", *by_column]
    history = customers.select(
        F.struct(*customers.columns).alias("customer"),
        F.col(x).cast("double").alias("x"),
        F.col(t_x).cast("double").alias("t_x"),
        F.col(T).cast("double").alias("T"),
        *by_column,
    )
    outlook = purchase_outlook(history.select(*keys), model, horizons, discounted)
    alive = F.expr(mbg.probability_alive(model, "x", "t_x", "T"))
    outputs = [*horizons, *(discounted or {})]
    return (
        history.withColumn("alive", alive)
        .join(outlook, keys, "left")
        .select("customer.*", "alive", *[(F.col("alive") * F.col(o)).alias(o) for o in outputs])
    )
