"""Batch and stream readers. Schemas are always given, never inferred."""

from __future__ import annotations

import os
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas


def read_table(
    spark: SparkSession, path: str, schema: str = schemas.LAKE, fmt: str = "parquet"
) -> DataFrame:
    """A columnar table; an empty one if nothing has been written yet. Any other
    failure is raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_lake(
    spark: SparkSession, path: str | None = None, since: date | None = None, fmt: str = "parquet", extra: bool = False
) -> DataFrame:
    """The lake table, read as a directory so that date partitions are found.

    Without ``path`` the environment decides: ``WAKELINE_SNAPSHOT`` (a local
    extract used instead of the lake) wins over ``WAKELINE_LAKE``. ``since``
    prunes partitions at planning time. ``extra`` adds the column of that name, null where it
    was not written.
    """
    path = path or os.environ.get("WAKELINE_SNAPSHOT") or os.environ.get("WAKELINE_LAKE")
    if not path:
        raise ValueError("give a path or set WAKELINE_LAKE")
    schema = schemas.LAKE_WITH_EXTRA if extra else schemas.LAKE
    lake = read_table(spark, path, schema, fmt).select(*schemas.LAKE_COLUMNS, *(["extra"] if extra else []))
    return lake.filter(F.col("date") >= F.lit(since)) if since else lake


def _located(spark: SparkSession, path: str):
    """A path and the file system it is on, whichever that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def found_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders by names alone; none is opened."""
    place, files = _located(spark, pattern)
    return [str(status.getPath()) for status in files.globStatus(place) or []]


def make_folder(spark: SparkSession, path: str) -> None:
    place, files = _located(spark, path)
    files.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    place, files = _located(spark, path)
    files.delete(place, True)


def newest_day(spark: SparkSession, path: str) -> date | None:
    """The newest date of the lake table, from the names of its folders: no file is opened."""
    names = [found.rpartition("date=")[2] for found in found_paths(spark, f"{path}/date=*")]
    return max((date.fromisoformat(n) for n in names if n[:1].isdigit()), default=None)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON text, one message per line, as a ``value`` column."""
    return spark.read.schema(schemas.TEXT).text(path)


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON text as a stream of ``value`` records."""
    reader = spark.readStream.schema(schemas.TEXT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = None,
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """A topic as a stream of ``value`` records. Needs the Kafka connector on the classpath.

    Without ``max_offsets`` each trigger takes what is there; 200 suits a very small host.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load()
