"""Session helpers: a local session for tests and benches, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
SHIPPED: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session; on a cluster the caller brings their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loyalspan")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; a cluster without it is an error, since a
    machine-local folder would be invisible to the other executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="loyalspan-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table in the shared folder."""
    return f"{shared_dir(spark)}/loyalspan/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Exactly ``spark.sql.shuffle.partitions`` partitions, evenly or by ``keys``.

    For narrow tables that are cheap to move and costly to compute on: adaptive execution would
    otherwise merge them into a few tasks by their size in bytes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written table.

    Used where a frame feeds several jobs, or where a later step must see the very same
    partitioning. The table survives the loss of any executor, later passes read only the
    columns they need, and its size is known to the optimiser. Tables stay in the folder until
    its owner's clean-up removes them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the executors, once per application.

    The archive is a file of the driver that Spark itself hands out to every executor, new ones
    included; nothing reads it from a path.
    """
    context = spark.sparkContext
    if context.applicationId in SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for path in sorted(PACKAGE.rglob("*.py")):
            target.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    SHIPPED.add(context.applicationId)
