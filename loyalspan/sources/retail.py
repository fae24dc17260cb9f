"""Order tables (orders, customer, nation, region) read as retail transactions.

Customer ids keep the type of the order key until a snapshot is written, so the join, the daily
roll-up and the per-customer aggregate can share one partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.operators.rfm import current_day, daily_spend, in_period
from loyalspan.sources.transactions import CleaningRules, clean_transactions

RULES = CleaningRules(region="AMERICA", currencies=("F", "O"), deleted_code="5-LOW")

_ORDER_RULES = ("customer_id", "amount", "currency", "visit_ind", "change_code")
_CUSTOMER_RULES = ("region", "consumer_id", "valid_ind", "consumer_valid_flag", "trade_flag")


# Declared, so that opening a table needs no job to look at its files.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the order tables; tables without a declared schema are looked up."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(15,2)")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the transaction columns they carry themselves."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("sale_dt"),
        F.col("o_orderkey").alias("txn_id"),
        _money("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("currency"),
        F.when(F.col("o_totalprice") > 0, 1).otherwise(0).alias("visit_ind"),
        F.col("o_orderpriority").alias("change_code"),
    )


def customer_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with region and validity; nation and region are fixed lists."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    valid = F.col("c_acctbal") > 0
    return (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("consumer_id"),
            F.col("n_nationkey").alias("brand_id"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("channel"),
            valid.cast("int").alias("valid_ind"),
            F.when(valid, "Y").otherwise("N").alias("consumer_valid_flag"),
            F.when(valid, "N").otherwise("Y").alias("trade_flag"),
        )
    )


def transaction_header(spark: SparkSession, folder: str) -> DataFrame:
    """The raw header table: every order with its customer's profile."""
    orders, customers = order_lines(spark, folder), customer_profiles(spark, folder)
    return orders.join(customers, F.col("customer_id") == F.col("consumer_id"))


def clean_orders(spark: SparkSession, folder: str, rules: CleaningRules = RULES) -> DataFrame:
    return clean_transactions(transaction_header(spark, folder), rules)


def all_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with a positive amount, whatever its customer."""
    return order_lines(spark, folder).where(F.col("amount") > 0)


def valid_history(
    spark: SparkSession, folder: str, start: str, period: str, rules: CleaningRules = RULES
) -> tuple[DataFrame, DataFrame]:
    """Customer-days and latest day of the valid transactions of a period.

    Equal to rolling up ``clean_orders``, but orders are combined per customer and day before
    they meet the customer table, so one customer with a large share of all orders does not end
    up in one join task.
    """
    orders = in_period(rules.where(order_lines(spark, folder), _ORDER_RULES), start, period)
    valid = rules.where(customer_profiles(spark, folder), _CUSTOMER_RULES).select(
        F.col("consumer_id").alias("customer_id")
    )
    daily = daily_spend(orders).join(valid, "customer_id", "left_semi")
    last_days = orders.groupBy("customer_id").agg(F.max("sale_dt").alias("sale_dt"))
    return daily, current_day(last_days.join(valid, "customer_id", "left_semi"))


def full_history(
    spark: SparkSession, folder: str, start: str, period: str
) -> tuple[DataFrame, DataFrame]:
    """Customer-days and latest day over all orders of a period."""
    orders = in_period(all_orders(spark, folder), start, period)
    return daily_spend(orders), current_day(orders)
