"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty. Pure ASCII takes the fast built-in."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_key(doc_id: Column, text: Column) -> Column:
    """A string that stands for a row: its id, or the digest of its text where it has none.

    Rows without an id may be many; keyed by their text they still spread.
    """
    return F.coalesce(
        doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit(""))))
    )


def fraction(seed: str, key: Column) -> Column:
    """A number in (0, 1) drawn from ``key``, the same in every run and engine with MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**13))


def hex_bucket(seed: str, key: Column, digits: int) -> Column:
    """One of ``16 ** digits`` buckets, drawn from ``key``."""
    start = F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, digits)
    return F.conv(start, 16, 10).cast("int")
