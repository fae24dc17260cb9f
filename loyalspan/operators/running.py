"""Running totals, order statistics and n-tiles over a whole table.

A window without PARTITION BY sends every row to one task. Here the rows are range-partitioned
on the full sort key (ties included, so equal scores spread out), written once so that slice
numbers stay fixed, and each slice continues from the totals of the slices before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from loyalspan.session import materialise


def _sliced(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """The rows in even ranges of the order, each with the number of its range."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *order_by)
    return materialise(ranged.withColumn("_slice", F.spark_partition_id()))


def _within(order_by: Sequence[Column]) -> WindowSpec:
    ordered = Window.partitionBy("_slice").orderBy(*order_by)
    return ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Add, for each entry, the running sum ``name`` in global order and the sum ``name_total``."""
    ranged = _sliced(
        df.select("*", *[value.alias(f"_{name}") for name, value in totals.items()]), order_by
    )
    # One row per slice, so these frames never outgrow the number of partitions.
    per_slice = ranged.groupBy("_slice").agg(*[F.sum(f"_{name}").alias(name) for name in totals])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = per_slice.select(
        "_slice",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}_before") for name in totals],
        *[F.sum(name).over(every).alias(f"{name}_total") for name in totals],
    )
    within = _within(order_by)
    return ranged.join(F.broadcast(offsets), "_slice").select(
        *df.columns,
        *[(F.sum(f"_{name}").over(within) + F.col(f"_{name}_before")).alias(name) for name in totals],
        *[f"{name}_total" for name in totals],
    )


def rows_at_ranks(
    df: DataFrame,
    order_by: Sequence[Column],
    ranks: Callable[[int], Sequence[int]],
    weight: Column | None = None,
) -> tuple[int, dict[int, Row]]:
    """The number of rows and the rows at a few ranks (from 1) of the global order.

    ``ranks`` is given the number of rows; ``weight`` says how many rows each one stands for.
    Only the slices that hold a wanted rank are sorted.
    """
    weighed = df.withColumn("_weight", F.lit(1) if weight is None else weight)
    ranged = _sliced(weighed, order_by)
    sizes = ranged.groupBy("_slice").agg(F.sum("_weight").alias("size")).collect()
    total, before = 0, {}
    wanted = sorted(set(ranks(sum(row["size"] for row in sizes))))
    for number, size in sorted((row["_slice"], row["size"]) for row in sizes):
        if any(total < rank <= total + size for rank in wanted):
            before[number] = total
        total += size
    if not before:
        return total, {}

    start = F.coalesce(*[F.when(F.col("_slice") == n, F.lit(b)) for n, b in before.items()])
    located = (
        ranged.where(F.col("_slice").isin(list(before)))
        .withColumn("_upto", F.sum("_weight").over(_within(order_by)) + start)
        .withColumn("_from", F.col("_upto") - F.col("_weight"))
    )
    holds = [(F.col("_from") < rank) & (F.col("_upto") >= rank) for rank in wanted]
    found = located.where(reduce(Column.__or__, holds)).collect()  # at most one row per rank
    return total, {
        rank: row for rank in wanted for row in found if row["_from"] < rank <= row["_upto"]
    }


def _bucket_starts(total: int, buckets: int) -> list[int]:
    """Rank of the first row of each bucket but the first; early buckets take the remainder."""
    size, larger = divmod(total, buckets)
    starts = [1 + i * size + min(i, larger) for i in range(1, buckets)]
    return [start for start in starts if start <= total]


def ntile(df: DataFrame, score: str, key: str, out: str, buckets: int = 10) -> DataFrame:
    """``ntile(buckets) OVER (ORDER BY score DESC, key)`` without moving the rows of ``df``.

    Only (score, key) is sorted. The first row of each bucket is looked up and every row of
    ``df`` then finds the first bucket start that lies after it. ``key`` is unique. Null scores
    come last, a null key first among equal scores.
    ``df`` is read again for the result, so a costly one should be materialised.
    """
    order = [F.col(score).desc_nulls_last(), F.col(key).asc()]
    _, starts = rows_at_ranks(
        df.select(score, key), order, lambda total: _bucket_starts(total, buckets)
    )
    if not starts:
        return df.withColumn(out, F.lit(1))

    def before(start: Row) -> Column:
        if start[key] is None:
            earlier_key = F.lit(False)
        else:
            earlier_key = F.col(key).isNull() | (F.col(key) < F.lit(start[key]))
        if start[score] is None:
            return F.col(score).isNotNull() | earlier_key
        at_start = F.lit(start[score])
        return (F.col(score) > at_start) | ((F.col(score) == at_start) & earlier_key)

    first, *others = [before(starts[rank]) for rank in sorted(starts)]
    bucket = F.when(first, F.lit(1))
    for number, condition in enumerate(others, start=2):
        bucket = bucket.when(condition, F.lit(number))
    return df.withColumn(out, bucket.otherwise(F.lit(len(starts) + 1)))


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation between neighbours; nulls and NaN are ignored.

    Equal values are counted before they are sorted.
    """

    def position(total: int, probability: float) -> tuple[int, float]:
        """Rank of the lower neighbour and the share of the way to the next."""
        exact = (total - 1) * float(probability)
        return int(exact) + 1, exact - int(exact)

    def neighbours(total: int) -> list[int]:
        lower = [position(total, p)[0] for p in probabilities] if total else []
        return [rank for low in lower for rank in (low, min(low + 1, total))]

    counts = df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(value).count()
    total, rows = rows_at_ranks(counts, [F.col(value).asc()], neighbours, F.col("count"))
    if not total:
        return [None for _ in probabilities]
    edges = []
    for probability in probabilities:
        low, share = position(total, probability)
        below, above = rows[low][value], rows[min(low + 1, total)][value]
        edges.append(below + (above - below) * share)
    return edges
