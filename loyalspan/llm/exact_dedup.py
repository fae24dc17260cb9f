"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 digest of the normalised text. A new batch
is reduced to one row per digest (partial counts are formed before the shuffle, so a group with a
third of all rows reaches it as one row per task), anti-joined with the index by sort-merge - the
index side is read in its buckets, without a shuffle - and what is new is appended.

Rows find their group again through (digest, salt): the salt comes from the id, so that no task
meets more than a ``1 / SALTS`` share of a group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyalspan.llm.tables import ascii_lower
from loyalspan.session import materialise, scratch_path

SALTS = 256
DIGEST, SALT = "__digest", "__salt"

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("digest", T.StringType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)


def text_digest(text: Column) -> Column:
    """Hex SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(text), 256)


class DigestIndex:
    """The digests kept so far, each with the document that stands for it.

    ``location`` names the folder of an existing index; without it a new one of ``buckets`` (by default
    ``spark.sql.shuffle.partitions``) is made in the shared folder. The number of buckets is written
    beside the data and taken from there, whatever the session's setting; another number is refused,
    and so is a folder without it. A batch is added once: adding it again (after a lost driver) finds
    its own entries and gives the same decisions.
    """

    def __init__(self, spark: SparkSession, location: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.location = (location or scratch_path(spark, "digests")).rstrip("/")
        layout = f"{self.location}_layout"
        if location:
            self.buckets = spark.read.schema("buckets int").parquet(layout).first()["buckets"]
            if buckets not in (None, self.buckets):
                raise ValueError(f"the index has {self.buckets} buckets, not {buckets}")
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(layout)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        if location:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INDEX_SCHEMA)
            spark.sql(
                f"CREATE TABLE {self.table} ({columns}) USING parquet CLUSTERED BY (digest) "
                f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
            )
        else:
            self._append(spark.createDataFrame([], INDEX_SCHEMA))

    def _append(self, entries: DataFrame) -> None:
        (
            entries.repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.location)
            .mode("append")
            .saveAsTable(self.table)
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Appends the groups (digest, keep_id) whose digest is not in the index."""
        known = self.read().select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti")
        self._append(fresh.select("digest", "keep_id", F.lit(batch).alias("batch")))


def decide(
    df: DataFrame,
    index: DigestIndex | None = None,
    batch: str = "batch",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``df`` with keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the largest ``doc_id`` stays, unless an earlier batch of the index
    has the text, in which case none does and ``keep_id`` is the earlier document. ``group_size``
    counts the rows of this batch. A null text counts as empty. Null ids rank below all others; a
    group without any id keeps one row and has a null ``keep_id``. Of rows that repeat both id and
    text exactly one stays. Other columns pass through, but those with the names of the four new
    columns are replaced. An empty table gives an empty result.
    """
    spark = df.sparkSession
    index = index or DigestIndex(spark)
    df = df.drop("keep_id", "group_size", "kept", "text_sha256")
    salt = F.coalesce(F.pmod(F.xxhash64(F.col(doc_id)), F.lit(SALTS)), F.lit(0))
    keyed = df.withColumn(DIGEST, text_digest(F.col(text))).withColumn(SALT, salt)
    narrow = materialise(keyed.select(F.col(doc_id).cast("long").alias("id"), DIGEST, SALT))
    parts = materialise(
        narrow.groupBy(DIGEST, SALT).agg(F.count("*").alias("rows"), F.max("id").alias("top"))
    )
    groups = parts.groupBy(F.col(DIGEST).alias("digest")).agg(
        F.max("top").alias("keep_id"), F.sum("rows").alias("group_size")
    )
    groups = materialise(groups)
    index.add(groups.select("digest", "keep_id"), batch)
    entries = index.read().select("digest", "keep_id", (F.col("batch") == batch).alias("__own"))
    found = groups.drop("keep_id").join(entries, "digest")
    by_part = parts.select(DIGEST, SALT).join(
        found.withColumnRenamed("digest", DIGEST), DIGEST
    )
    rows = keyed.join(by_part, [DIGEST, SALT])
    chosen = F.col("__own") & F.col(doc_id).eqNullSafe(F.col("keep_id"))
    order = [
        f.name
        for f in df.schema
        if f.name not in (doc_id, text) and isinstance(f.dataType, T.AtomicType)
    ]
    rank = F.row_number().over(
        Window.partitionBy(DIGEST, SALT, doc_id).orderBy(*[F.col(c) for c in order], F.lit(1))
    )
    return rows.withColumn("kept", chosen & (rank == 1)).select(
        *df.columns, "keep_id", "group_size", "kept", F.col(DIGEST).alias("text_sha256")
    )


def decisions(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``decide`` without the texts, which then never enter a shuffle."""
    return decide(df.select(doc_id, text), doc_id=doc_id, text=text).drop(text)


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text, with the columns of ``df``; see :func:`decide`."""
    return decide(df, doc_id=doc_id, text=text).where("kept").select(*df.columns)
