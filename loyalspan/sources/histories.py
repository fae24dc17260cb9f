"""Monthly states of the purchase histories: bucketed by customer, one folder each, listed by marks.

A state is written to a folder of its own and only then marked, so a lost driver leaves the marks as
they were. Marks are few (one row per prepared month) and carry what the next merge has to know: the
days covered, the latest purchase day of anyone, the cut, the buckets and the scale of the amounts.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspan.functions.scalars import period_end
from loyalspan.operators.history import batch_history, full_rows, merge_history, training_rows
from loyalspan.operators.rfm import amount_scale
from loyalspan.session import materialise

MARK_SCHEMA = (
    "period string, turn int, through string, current string, cut string, duration int,"
    " buckets int, scale int, folder string, columns string"
)


@dataclass(frozen=True)
class Mark:
    """A prepared month; ``turn`` counts how often it was prepared."""

    period: str
    turn: int
    through: str
    current: str
    cut: str
    duration: int
    buckets: int
    scale: int
    folder: str
    columns: str


class HistoryStore:
    """The states under ``path``, for one holdout length.

    ``buckets`` is the number of files of a state (by default ``spark.sql.shuffle.partitions``); later
    states take it from the one before, whatever the session's setting.
    """

    def __init__(self, spark: SparkSession, path: str, duration: int, buckets: int | None = None):
        self.spark, self.path, self.duration = spark, path.rstrip("/"), duration
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.createDataFrame([], MARK_SCHEMA).write.mode("ignore").parquet(f"{self.path}/marks")

    def marks(self) -> list[Mark]:
        """All marks by period and turn."""
        rows = self.spark.read.schema(MARK_SCHEMA).parquet(f"{self.path}/marks").collect()
        return sorted((Mark(**row.asDict()) for row in rows), key=lambda m: (m.period, m.turn))

    def before(self, period: str) -> Mark | None:
        """The latest state of a month before ``period``."""
        earlier = [mark for mark in self.marks() if mark.period < period]
        if earlier and earlier[-1].duration != self.duration:
            raise ValueError(f"the states hold {earlier[-1].duration} open days, not {self.duration}")
        return earlier[-1] if earlier else None

    def since(self, period: str, start: str) -> str:
        """The first day that the batch of ``period`` has to bring."""
        mark = self.before(period)
        return start if mark is None else (date.fromisoformat(mark.through) + timedelta(days=1)).isoformat()

    def read(self, mark: Mark) -> DataFrame:
        return self.spark.read.schema(mark.columns).parquet(f"{self.path}/{mark.folder}")

    def merged(self, mark: Mark | None, daily: DataFrame, cut: str, table: str = "") -> DataFrame:
        """The state of ``mark`` after ``daily``; ``table`` names the state as a bucketed table."""
        batch = batch_history(daily, cut)
        if mark is None:
            return batch
        if mark.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            batch = batch.repartition(mark.buckets, "customer_id")
        return merge_history(self.spark.table(table) if table else self.read(mark), batch, cut)

    def attach(self, mark: Mark) -> str:
        """A state as a table of the catalog, so that its buckets are known."""
        table = f"history_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {table} ({mark.columns}) USING parquet CLUSTERED BY (customer_id) "
            f"SORTED BY (customer_id) INTO {mark.buckets} BUCKETS LOCATION '{self.path}/{mark.folder}'"
        )
        return table

    def advance(self, daily: DataFrame, period: str) -> Mark:
        """Merges the customer-days of ``period`` into the latest state before it, and marks the result.

        ``daily`` may hold the days after the state's last one up to the end of the month; any other
        day is an error. Preparing a month again replaces its state; months after it have to be
        prepared again as well.
        """
        scale = amount_scale(daily)
        earlier = self.before(period)
        daily = materialise(daily.select("customer_id", "day", "amount"))
        end = period_end(F.lit(period).cast("date")).cast("string")
        first, last, through = daily.agg(
            F.min("day").cast("string"), F.max("day").cast("string"), F.max(end)
        ).first()
        through = through or self.spark.range(1).select(end).first()[0]
        if last and last > through or earlier and first and first <= earlier.through:
            raise ValueError(f"days {first} to {last} are not of the batch of {period}")
        if earlier and earlier.scale != scale:
            raise ValueError(f"amounts of scale {scale} do not merge with those of scale {earlier.scale}")
        current = last or (earlier.current if earlier else through)
        cut = (date.fromisoformat(current) - timedelta(days=self.duration)).isoformat()
        buckets = earlier.buckets if earlier else self.buckets
        folder, written = f"state-{uuid.uuid4().hex}", f"history_{uuid.uuid4().hex}"
        attached = self.attach(earlier) if earlier else ""
        state = self.merged(earlier, daily, cut, attached)
        if earlier is None:
            state = state.repartition(buckets, "customer_id")
        (
            state.write.bucketBy(buckets, "customer_id")
            .sortBy("customer_id")
            .option("path", f"{self.path}/{folder}")
            .saveAsTable(written)
        )
        for table in filter(None, (attached, written)):
            self.spark.sql(f"DROP TABLE {table}")  # of the catalog; the files stay
        turn = 1 + max((m.turn for m in self.marks() if m.period == period), default=0)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
        mark = Mark(period, turn, through, current, cut, self.duration, buckets, scale, folder, columns)
        marks = self.spark.createDataFrame([tuple(asdict(mark).values())], MARK_SCHEMA)
        marks.coalesce(1).write.mode("append").parquet(f"{self.path}/marks")
        return mark

    def training(self, mark: Mark) -> DataFrame:
        return training_rows(self.read(mark), mark.cut, mark.period, mark.duration, mark.scale)

    def full(self, mark: Mark) -> DataFrame:
        return full_rows(self.read(mark), mark.current, mark.period, mark.scale)
