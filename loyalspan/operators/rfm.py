"""Purchase histories rolled up to recency, frequency, tenure and spend per customer.

The roll-up to customer-days runs first and combines on the map side, so a customer with a very
large share of all transactions reaches the shuffle as at most one row per day and input task.
Everything after it is one conditional aggregate per customer: first day, calibration counts
and holdout counts come from the same pass, with no join between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from loyalspan.functions.scalars import month_start, period_end, purchase_day


# Decimals of up to this many digits pass through a double unharmed.
EXACT_DIGITS = 15
_SCALE = "scale"


def in_period(transactions: DataFrame, start: str, period: str, ts: str = "sale_dt") -> DataFrame:
    """Transactions on days from ``start`` to the end of ``period``'s month, both included."""
    last = period_end(F.lit(period).cast("date"))
    return transactions.where(purchase_day(ts).between(F.lit(start).cast("date"), last))


def daily_spend(
    transactions: DataFrame,
    customer: str = "customer_id",
    ts: str = "sale_dt",
    amount: str = "amount",
) -> DataFrame:
    """One row per customer and purchase day, with what was spent.

    Decimal amounts are summed exactly. Those of ordinary size are summed as whole minor units
    (cents), which keeps every shuffled sum to eight bytes; the number of decimals travels with
    the column, and ``spent`` turns such sums into currency.
    """
    declared = transactions.schema[amount].dataType
    value, metadata = F.col(amount), {}
    if isinstance(declared, DecimalType) and declared.precision <= EXACT_DIGITS:
        metadata = {_SCALE: declared.scale}
        value = F.round(value.cast("double") * 10**declared.scale).cast("bigint")
    return (
        transactions.where(F.col(customer).isNotNull())
        .groupBy(F.col(customer).alias("customer_id"), purchase_day(ts).alias("day"))
        .agg(F.sum(value).alias("amount", metadata=metadata))
    )


def amount_scale(daily: DataFrame) -> int:
    """The decimals of ``daily.amount`` where it counts minor units, else 0."""
    return daily.schema["amount"].metadata.get(_SCALE, 0)


def spent(daily: DataFrame, total: Column | None = None) -> Column:
    """Sums of ``daily.amount`` (the column itself by default) in currency, as a double."""
    total = F.col("amount") if total is None else total
    scale = amount_scale(daily)
    return total.cast("double") / 10.0**scale if scale else total.cast("double")


def current_day(transactions: DataFrame, ts: str = "sale_dt") -> DataFrame:
    """The latest purchase day of anyone: one row, ``current_dt``."""
    return transactions.agg(F.max(purchase_day(ts)).alias("current_dt"))


def first_purchase(transactions: DataFrame, customer: str = "customer_id", ts: str = "sale_dt") -> DataFrame:
    return transactions.groupBy(F.col(customer).alias("customer_id")).agg(
        F.min(purchase_day(ts)).alias("first_at")
    )


def attach_current_day(daily: DataFrame, current: DataFrame) -> DataFrame:
    """Every customer-day with the common ``current_dt``, read as a scalar subquery."""
    return daily.withColumn("current_dt", current.scalar())


def attach_first_purchase(daily: DataFrame, first: DataFrame) -> DataFrame:
    """Every customer-day with the customer's first purchase day."""
    return daily.join(first, "customer_id")


def repeat_spend(daily: DataFrame) -> DataFrame:
    """Per customer, total spend without the first purchase day."""
    spend = F.sum("amount") - F.min_by("amount", "day")
    return daily.groupBy("customer_id").agg(spent(daily, spend).alias("repeat_spend"))


def _cut(current: DataFrame, duration: int) -> Column:
    return F.date_sub(current.scalar(), duration)


def _average_repeat_spend(daily: DataFrame) -> Column:
    """Spend per repeat day; 0 for customers with one purchase day."""
    repeats = F.nullif(F.col("days") - 1, F.lit(0))
    repeat_total = spent(daily, F.col("total") - F.col("first_amount"))
    return F.coalesce(repeat_total / repeats, F.lit(0.0))


def rfm_calibration(daily: DataFrame, current: DataFrame, duration: int) -> DataFrame:
    """Recency, frequency, tenure and average repeat spend before the holdout."""
    before = daily.withColumn("cut", _cut(current, duration)).where("day < cut")
    return (
        before.groupBy("customer_id", "cut")
        .agg(
            F.min("day").alias("first_at"),
            F.max("day").alias("last_at"),
            F.count("day").alias("days"),
            F.sum("amount").alias("total"),
            F.min_by("amount", "day").alias("first_amount"),
        )
        .select(
            "customer_id",
            (F.col("days") - 1).cast("float").alias("frequency"),
            F.datediff("last_at", "first_at").cast("float").alias("recency"),
            F.datediff("cut", "first_at").cast("float").alias("T"),
            _average_repeat_spend(daily).alias("monetary_value"),
        )
    )


def rfm_holdout(daily: DataFrame, current: DataFrame, duration: int) -> DataFrame:
    """Purchase days and average daily spend in the holdout, cut day included."""
    return (
        daily.withColumn("cut", _cut(current, duration))
        .where("day >= cut")
        .groupBy("customer_id")
        .agg(F.count("day").alias("days"), F.sum("amount").alias("total"))
        .select(
            "customer_id",
            F.col("days").cast("float").alias("frequency_holdout"),
            (spent(daily, F.col("total")) / F.col("days")).alias("monetary_value_holdout"),
        )
    )


def calibration_with_holdout(calibration: DataFrame, holdout: DataFrame) -> DataFrame:
    """Every calibration customer with the holdout actuals, zero where there are none."""
    zero = F.lit(0.0)
    return calibration.join(holdout, "customer_id", "left").select(
        *calibration.columns,
        F.coalesce(F.col("frequency_holdout").cast("double"), zero).alias("frequency_holdout"),
        F.coalesce("monetary_value_holdout", zero).alias("monetary_value_holdout"),
    )


def training_snapshot(daily: DataFrame, current: DataFrame, period: str, duration: int) -> DataFrame:
    """Calibration features and holdout actuals per customer, in one pass over customer-days.

    Customers whose first purchase falls in the holdout are left out.
    """
    dated = daily.withColumn("cut", _cut(current, duration))
    calibration = F.col("day") < F.col("cut")
    return (
        dated.groupBy("customer_id")
        .agg(
            F.max("cut").alias("cut"),
            F.min("day").alias("first_at"),
            F.max(F.when(calibration, F.col("day"))).alias("last_at"),
            F.count(F.when(calibration, F.lit(1))).alias("days"),
            F.sum(F.when(calibration, F.col("amount"))).alias("total"),
            F.min_by("amount", "day").alias("first_amount"),
            F.count(F.when(~calibration, F.lit(1))).alias("holdout_days"),
            F.sum(F.when(~calibration, F.col("amount"))).alias("holdout_total"),
        )
        .where("days > 0")
        .select(
            month_start(F.lit(period).cast("date")).alias("snapshot_dt"),
            F.col("customer_id").cast("string").alias("CustomerID"),
            (F.col("days") - 1).cast("float").alias("frequency_cal"),
            F.datediff("last_at", "first_at").cast("float").alias("recency_cal"),
            F.datediff("cut", "first_at").cast("float").alias("T_cal"),
            _average_repeat_spend(daily).alias("monetary_value_cal"),
            F.col("holdout_days").cast("double").alias("frequency_holdout"),
            F.coalesce(
                spent(daily, F.col("holdout_total")) / F.nullif("holdout_days", F.lit(0)),
                F.lit(0.0),
            ).alias("monetary_value_holdout"),
            F.lit(duration).cast("float").alias("duration_holdout"),
        )
    )


def full_snapshot(daily: DataFrame, current: DataFrame, period: str) -> DataFrame:
    """Recency, frequency, tenure and spend over the whole history."""
    return (
        daily.groupBy("customer_id")
        .agg(
            F.min("day").alias("first_at"),
            F.max("day").alias("last_at"),
            F.count("day").alias("days"),
            F.sum("amount").alias("total"),
            F.min_by("amount", "day").alias("first_amount"),
        )
        .select(
            month_start(F.lit(period).cast("date")).alias("snapshot_dt"),
            F.col("customer_id").cast("string").alias("CustomerID"),
            (F.col("days") - 1).cast("float").alias("frequency"),
            F.datediff("last_at", "first_at").cast("float").alias("recency"),
            F.datediff(current.scalar(), F.col("first_at")).cast("float").alias("T"),
            _average_repeat_spend(daily).alias("monetary_value"),
        )
    )
