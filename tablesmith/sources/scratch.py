"""Intermediate results that must not be computed twice, and size checks before a broadcast."""

from __future__ import annotations

import re
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..errors import TableOperationError

# A side is broadcast only when it is known to stay below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``. Only a session whose executors are threads
    of the driver may lack one and gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise TableOperationError("Set spark.checkpoint.dir to a folder that all executors share")
        folder = folder or tempfile.mkdtemp()
        context.setCheckpointDir(folder)


def pinned(df: DataFrame) -> DataFrame:
    """The rows as they are now, kept in the shared checkpoint folder.

    The copy survives lost executors and keeps partitions and their order. The disk cache spares
    the second computation a checkpoint would need.
    """
    use_shared_checkpoints(df.sparkSession)
    cached = df.persist(StorageLevel.DISK_ONLY)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows are proven to stay below the broadcast bounds.

    Reads at most ``BROADCAST_ROWS`` + 1 rows. Text is measured, other values count 16 bytes.
    """
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        name = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(field.dataType, T.AtomicType):
            width = width + F.lit(16)
        else:
            width = width + F.coalesce(F.octet_length(name.cast("string")), F.lit(0))
    row = (
        df.select(width.alias("w"))
        .limit(BROADCAST_ROWS + 1)
        .agg(F.count("*").alias("n"), F.sum("w").alias("bytes"))
        .first()
    )
    return row.n <= BROADCAST_ROWS and (row.bytes or 0) <= BROADCAST_BYTES


def join_side(df: DataFrame, small: bool) -> DataFrame:
    """The side of a join that has few rows per key, made ready for a join with one that may hold a
    hot key: broadcast if proven small.

    Otherwise it leaves the partitioning an aggregation may have given it. Spark then shuffles both
    sides for the join, which is what lets it split the hot key's rows over several tasks; a side
    that is joined where it was aggregated pins the hot key to one task.
    """
    return F.broadcast(df) if small else df.hint("rebalance")
