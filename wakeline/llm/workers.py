"""Settings of the Python workers: where they find this package and how much they hold."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


#: Bytes of rows handed to a worker at once; texts are long, so rows say little.
BATCH_BYTES = 8 << 20


def importable(spark: SparkSession) -> SparkSession:
    """Workers started from now on search the folder this package was imported from.

    On a cluster the package is installed or sent with --py-files; a folder that
    is not there does no harm. Rows come in batches of bounded size, and freed memory
    goes back to the machine, so that the stages of a job do not add up.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([p for p in known if p] + [root])
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
    return spark
