"""Data preparation: from transactions to the month's training and full snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from loyalspan.operators.rfm import (
    current_day,
    daily_spend,
    full_snapshot,
    in_period,
    training_snapshot,
)
from loyalspan.session import materialise
from loyalspan.sources.histories import HistoryStore
from loyalspan.sources.snapshots import (
    FULL_SCHEMA,
    TRAINING_SCHEMA,
    create_snapshot_table,
    replace_snapshot,
)
from loyalspan.sources.transactions import CleaningRules, clean_transactions


@dataclass(frozen=True)
class Prepared:
    training_rows: int
    full_rows: int


def prepare(
    raw: DataFrame,
    rules: CleaningRules,
    period: str,
    duration: int,
    training_path: str,
    full_path: str,
    start: str,
) -> Prepared:
    """Clean the transactions since ``start`` and replace the month in both snapshot tables.

    The customer-days are written once and feed both snapshots and the latest day, so the
    transactions are scanned a single time.
    """
    spark = raw.sparkSession
    transactions = in_period(clean_transactions(raw, rules), start, period)
    daily = materialise(daily_spend(transactions))
    current = current_day(daily, ts="day")
    create_snapshot_table(spark, training_path, TRAINING_SCHEMA)
    create_snapshot_table(spark, full_path, FULL_SCHEMA)
    training = training_snapshot(daily, current, period, duration)
    full = full_snapshot(daily, current, period)
    return Prepared(
        training_rows=replace_snapshot(training, training_path, TRAINING_SCHEMA, period),
        full_rows=replace_snapshot(full, full_path, FULL_SCHEMA, period),
    )


def prepare_month(
    raw: DataFrame,
    rules: CleaningRules,
    period: str,
    duration: int,
    history_path: str,
    training_path: str,
    full_path: str,
    start: str,
) -> Prepared:
    """As :func:`prepare`, but from the state of the month before and the transactions since then.

    Without an earlier state all transactions since ``start`` are read. Transactions that arrive late,
    for days an earlier month has covered, are not seen: prepare that month and those after it again.
    """
    spark = raw.sparkSession
    store = HistoryStore(spark, history_path, duration)
    transactions = in_period(clean_transactions(raw, rules), store.since(period, start), period)
    mark = store.advance(daily_spend(transactions), period)
    create_snapshot_table(spark, training_path, TRAINING_SCHEMA)
    create_snapshot_table(spark, full_path, FULL_SCHEMA)
    return Prepared(
        training_rows=replace_snapshot(store.training(mark), training_path, TRAINING_SCHEMA, period),
        full_rows=replace_snapshot(store.full(mark), full_path, FULL_SCHEMA, period),
    )
