"""What every operator needs of the session: a shared folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which the smaller side of a join is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode where that setting is unset, as in tests.

    On a cluster executors would write to disks of their own: there the setting must name a folder they share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        if checkpoint.isDefined():
            folder = checkpoint.get()
        elif not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        else:
            folder = "file://" + tempfile.mkdtemp(prefix="feedmill-")
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again: column pruning holds for what reads it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is proven to hold no more than ``limit`` rows; else unchanged.

    ``rows`` is their number where it is known. Else ``df`` must be cheap to count: a written table or a checkpoint.
    """
    few = (df.limit(limit + 1).count() if rows is None else rows) <= limit
    return F.broadcast(df) if few else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front as many as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]
