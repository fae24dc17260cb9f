"""Purchase histories as a mergeable state, so that a month's snapshots read one month.

What a customer has bought so far is kept in one row: the first purchase day and its amount; the days
before the cut in sums (``days``, ``total``, ``last_at``); and the days since the cut (``open``), at most
as many as the holdout is long. A new batch of customer-days is merged into it: open days that the
moving cut has passed join the sums. Both snapshots are then plain projections of the state.

Batches follow each other in time. A state is tied to its cut, so it serves one holdout length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalspan.functions.scalars import month_start

OPEN_DAY = "struct<day: date, amount: {amount}>"


def batch_history(daily: DataFrame, cut: str) -> DataFrame:
    """The state of the customer-days ``daily`` alone, for a cut day.

    Sums are formed before the shuffle; of each customer only the days since the cut are listed.
    """
    before = F.col("day") < F.lit(cut).cast("date")
    return daily.groupBy("customer_id").agg(
        F.min("day").alias("first_at"),
        F.min_by("amount", "day").alias("first_amount"),
        F.max(F.when(before, F.col("day"))).alias("last_at"),
        F.count(F.when(before, F.lit(1))).alias("days"),
        F.sum(F.when(before, F.col("amount"))).alias("total"),
        F.collect_list(F.when(~before, F.struct("day", "amount"))).alias("open"),
    )


def _sum(days: Column, start: Column) -> Column:
    return F.aggregate(days, start, lambda total, d: total + d["amount"])


def merge_history(state: DataFrame, batch: DataFrame, cut: str) -> DataFrame:
    """``state`` after the later ``batch`` (see :func:`batch_history`), both by ``customer_id``.

    Customers of one side only are kept; open days before ``cut`` go into the sums. Where the state is
    bucketed by customer, only the batch is shuffled.
    """
    old, new = state.alias("old"), batch.hint("merge").alias("new")
    both = old.join(new, F.col("old.customer_id") == F.col("new.customer_id"), "full_outer")
    day = F.lit(cut).cast("date")
    kind = state.schema["open"].dataType.simpleString()
    amount = state.schema["total"].dataType
    listed = F.coalesce(F.col("old.open"), F.array().cast(kind))
    passed = F.filter(listed, lambda d: d["day"] < day)
    last_passed = F.array_max(F.transform(passed, lambda d: d["day"]))
    zero = F.lit(0).cast(amount)
    added = F.coalesce(F.col("old.total"), zero) + F.coalesce(F.col("new.total"), zero)
    return both.select(
        F.coalesce("old.customer_id", "new.customer_id").alias("customer_id"),
        F.coalesce("old.first_at", "new.first_at").alias("first_at"),
        F.when(F.col("old.customer_id").isNotNull(), F.col("old.first_amount"))
        .otherwise(F.col("new.first_amount"))
        .alias("first_amount"),
        F.greatest("old.last_at", last_passed, "new.last_at").alias("last_at"),
        (F.coalesce("old.days", F.lit(0)) + F.size(passed) + F.coalesce("new.days", F.lit(0)))
        .cast("long")
        .alias("days"),
        (added + _sum(passed, zero)).cast(amount).alias("total"),
        F.concat(
            F.filter(listed, lambda d: d["day"] >= day),
            F.coalesce(F.col("new.open"), F.array().cast(kind)),
        ).alias("open"),
    )


def _currency(value: Column, scale: int) -> Column:
    return value.cast("double") / 10.0**scale if scale else value.cast("double")


def _average_repeat(total: Column, days: Column, scale: int) -> Column:
    repeats = F.nullif(days - 1, F.lit(0))
    return F.coalesce(_currency(total - F.col("first_amount"), scale) / repeats, F.lit(0.0))


def training_rows(state: DataFrame, cut: str, period: str, duration: int, scale: int = 0) -> DataFrame:
    """The training snapshot of a state; customers who first bought since the cut are left out."""
    zero = F.lit(0).cast(state.schema["total"].dataType)
    held = F.size("open")
    spent = _currency(_sum(F.col("open"), zero), scale)
    return state.where("days > 0").select(
        month_start(F.lit(period).cast("date")).alias("snapshot_dt"),
        F.col("customer_id").cast("string").alias("CustomerID"),
        (F.col("days") - 1).cast("float").alias("frequency_cal"),
        F.datediff("last_at", "first_at").cast("float").alias("recency_cal"),
        F.datediff(F.lit(cut).cast("date"), "first_at").cast("float").alias("T_cal"),
        _average_repeat(F.col("total"), F.col("days"), scale).alias("monetary_value_cal"),
        held.cast("double").alias("frequency_holdout"),
        F.coalesce(spent / F.nullif(held, F.lit(0)), F.lit(0.0)).alias("monetary_value_holdout"),
        F.lit(duration).cast("float").alias("duration_holdout"),
    )


def full_rows(state: DataFrame, current: str, period: str, scale: int = 0) -> DataFrame:
    """The full snapshot of a state."""
    zero = F.lit(0).cast(state.schema["total"].dataType)
    total = _sum(F.col("open"), F.coalesce("total", zero))
    days = F.col("days") + F.size("open")
    last = F.greatest("last_at", F.array_max(F.transform("open", lambda d: d["day"])))
    return state.select(
        month_start(F.lit(period).cast("date")).alias("snapshot_dt"),
        F.col("customer_id").cast("string").alias("CustomerID"),
        (days - 1).cast("float").alias("frequency"),
        F.datediff(last, "first_at").cast("float").alias("recency"),
        F.datediff(F.lit(current).cast("date"), "first_at").cast("float").alias("T"),
        _average_repeat(total, days, scale).alias("monetary_value"),
    )
