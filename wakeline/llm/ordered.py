"""Running values over a total order that is cut into blocks, so that no key meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.session import working_dir


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder."""
    path = working_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(df: DataFrame, *keys) -> DataFrame:
    """``df`` in ranges of ``keys``, numbered in their order in column ``block``.

    The ranges are written to the shared folder, because they come from a sample
    and a second computation could cut elsewhere. Give keys that end in a
    column that differs where the others may be equal for many rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *keys)
    return written(ranged.withColumn("block", F.spark_partition_id()), "blocks")
