"""Monthly states of purchase histories against the roll-up of the whole history."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loyalspan.operators import history, rfm
from loyalspan.session import scratch_path
from loyalspan.sources.histories import HistoryStore

MONTHS = ("2020-01-01", "2020-02-01", "2020-03-01", "2020-04-01")
DURATION = 40
SCHEMA = "customer_id string, sale_dt date, amount decimal(12,2)"


def bought(spark, seed=3, customers=60, last=date(2020, 4, 25)):
    draw = random.Random(seed)
    first = date(2020, 1, 3)
    span = (last - first).days
    rows = []
    for i in range(customers):
        days = draw.sample(range(span + 1), draw.choice([1, 1, 2, 5, 30]))
        for day in days:
            rows += [(f"c{i}", first + timedelta(day), draw.randint(1, 9999) / 100) for _ in range(draw.choice([1, 1, 2]))]
    rows += [("always", first + timedelta(d), 1.25) for d in range(span + 1)]
    rows.append((None, first, 5.0))
    return spark.createDataFrame([(c, d, f"{a:.2f}") for c, d, a in rows], "customer_id string, sale_dt date, amount string").select(
        "customer_id", "sale_dt", F.col("amount").cast("decimal(12,2)").alias("amount")
    )


def advanced(store, rows, months):
    for period in months:
        batch = rfm.in_period(rows, store.since(period, "2020-01-01"), period)
        mark = store.advance(rfm.daily_spend(batch), period)
    return mark


def same(ours, theirs):
    columns = theirs.columns
    assert ours.dtypes == theirs.dtypes
    assert sorted(map(tuple, ours.select(*columns).collect())) == sorted(map(tuple, theirs.collect()))


def whole(rows, period):
    rows = rfm.in_period(rows, "2020-01-01", period)
    daily, current = rfm.daily_spend(rows), rfm.current_day(rows)
    return rfm.training_snapshot(daily, current, period, DURATION), rfm.full_snapshot(daily, current, period)


@pytest.mark.parametrize("months", [MONTHS[3:], MONTHS[1:]])
def test_merges_equal_the_whole_history(spark, months):
    rows = bought(spark)
    store = HistoryStore(spark, scratch_path(spark, "history"), DURATION, buckets=3)
    mark = advanced(store, rows, months)
    training, full = whole(rows, MONTHS[3])
    same(store.training(mark), training)
    same(store.full(mark), full)


def test_a_month_without_purchases(spark):
    rows = bought(spark, last=date(2020, 2, 20))
    store = HistoryStore(spark, scratch_path(spark, "history"), DURATION)
    mark = advanced(store, rows, MONTHS[1::2])
    training, full = whole(rows, MONTHS[3])
    same(store.training(mark), training)
    same(store.full(mark), full)


def test_nothing_at_all(spark):
    store = HistoryStore(spark, scratch_path(spark, "history"), DURATION)
    mark = advanced(store, spark.createDataFrame([], SCHEMA), MONTHS[:2])
    assert store.training(mark).collect() == store.full(mark).collect() == []


def test_a_month_is_prepared_again(spark):
    rows = bought(spark)
    store = HistoryStore(spark, scratch_path(spark, "history"), DURATION)
    advanced(store, rows.where("customer_id <> 'c1'"), MONTHS[:2])
    again = advanced(store, rows, MONTHS[:2])
    assert again.turn == 2 and store.before(MONTHS[2]) == again
    same(store.full(again), whole(rows, MONTHS[1])[1])


def test_another_session_setting_keeps_the_buckets(spark):
    rows = bought(spark)
    path = scratch_path(spark, "history")
    advanced(HistoryStore(spark, path, DURATION, buckets=3), rows, MONTHS[:2])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        store = HistoryStore(spark, path, DURATION)
        mark = advanced(store, rows, MONTHS[2:])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert mark.buckets == 3
    same(store.full(mark), whole(rows, MONTHS[3])[1])


def test_only_the_batch_is_shuffled(spark):
    rows = bought(spark)
    store = HistoryStore(spark, scratch_path(spark, "history"), DURATION)
    mark = advanced(store, rows, MONTHS[:2])
    batch = rfm.daily_spend(rfm.in_period(rows, store.since(MONTHS[2], "2020-01-01"), MONTHS[2]))
    table = store.attach(mark)
    merged = store.merged(mark, batch, "2020-02-20", table)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    old, new = plan.split("SortMergeJoin")[1].split("FileScan")[:2][0], plan
    assert "Exchange" not in old  # the state comes first and is read in its buckets
    assert "SelectedBucketsCount" in new or "Bucketed: true" in new
    spark.sql(f"DROP TABLE {table}")


def test_wrong_batches_are_refused(spark):
    rows = bought(spark)
    path = scratch_path(spark, "history")
    store = HistoryStore(spark, path, DURATION)
    advanced(store, rows, MONTHS[:2])
    with pytest.raises(ValueError, match="not of the batch"):
        store.advance(rfm.daily_spend(rows), MONTHS[2])
    with pytest.raises(ValueError, match="scale"):
        march = rfm.in_period(rows, "2020-03-01", MONTHS[2])
        store.advance(rfm.daily_spend(march.withColumn("amount", F.col("amount").cast("double"))), MONTHS[2])
    with pytest.raises(ValueError, match="open days"):
        HistoryStore(spark, path, DURATION + 1).before(MONTHS[2])
    assert [m.period for m in store.marks()] == list(MONTHS[:2])


def test_state_columns(spark):
    days = spark.createDataFrame(
        [("a", date(2020, 1, 1), 3), ("a", date(2020, 1, 9), 4), ("b", date(2020, 1, 9), 5)],
        "customer_id string, day date, amount long",
    )
    state = history.batch_history(days, "2020-01-05").orderBy("customer_id").collect()
    assert (state[0].first_at, state[0].first_amount, state[0].days, state[0].total) == (date(2020, 1, 1), 3, 1, 3)
    assert [tuple(d) for d in state[0].open] == [(date(2020, 1, 9), 4)]
    assert (state[1].days, state[1].total, state[1].last_at) == (0, None, None)
