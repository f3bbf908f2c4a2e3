"""Keyed tables in hash buckets: a change rewrites the buckets it touches, and no others.

``root/of=64/v=000000000007/bucket=12`` is bucket 12 as version 7 left it. A version holds only the
buckets it changed; the table as of a version is, for every bucket, its newest part up to then. Versions
are numbered by the caller, such as micro-batches: one that runs again reads older versions only and
overwrites its own, so that it ends the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wakeline.sources.readers import found_paths, make_folder, remove

BUCKETS = 64
#: Versions that can be read again as they were.
KEPT_VERSIONS = 10

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def version_path(root: str, buckets: int, version: int) -> str:
    return f"{root}/of={buckets}/v={version:012d}"


def _parts(spark: SparkSession, root: str, buckets: int) -> dict[int, list[tuple[int, str]]]:
    """Versions of every bucket, oldest first, with their folders; only versions written to the end."""
    whole = {re.search(r"/v=(\d+)/", path)[1] for path in found_paths(spark, f"{root}/of={buckets}/v=*/_SUCCESS")}
    parts: dict[int, list[tuple[int, str]]] = {}
    for path in found_paths(spark, f"{root}/of={buckets}/v=*/bucket=*"):
        version, bucket = re.search(r"/v=(\d+)/bucket=(\d+)", path).groups()
        if version in whole:
            parts.setdefault(int(bucket), []).append((int(version), path))
    return {bucket: sorted(own) for bucket, own in parts.items()}


def _newest(parts: dict[int, list[tuple[int, str]]], upto: int | None) -> dict[int, str]:
    old = {bucket: [path for version, path in own if upto is None or version <= upto] for bucket, own in parts.items()}
    return {bucket: own[-1] for bucket, own in old.items() if own}


def read_parts(spark: SparkSession, paths: Iterable[str], schema: StructType | str) -> DataFrame:
    paths = sorted(paths)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _buckets_of(spark: SparkSession, root: str) -> int | None:
    """How many buckets the table was made with; None before its first version."""
    found = found_paths(spark, f"{root}/of=*")
    return int(found[0].rpartition("=")[2]) if found else None


def read_snapshot(spark: SparkSession, root: str, schema: StructType | str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (default: the newest); empty before the first one. As many versions back
    as were retained can be read."""
    buckets = _buckets_of(spark, root)
    return read_parts(spark, (_newest(_parts(spark, root, buckets), version) if buckets else {}).values(), schema)


def changed_parts(spark: SparkSession, root: str, version: int) -> dict[int, str]:
    """The buckets that ``version`` wrote, each whole."""
    buckets = _buckets_of(spark, root)
    parts = _parts(spark, root, buckets) if buckets else {}
    return {bucket: path for bucket, own in parts.items() for number, path in own if number == version}


def write_version(
    table: DataFrame, root: str, version: int, buckets: int, touched: Iterable[int], retain: int | None = KEPT_VERSIONS
) -> None:
    """Write the buckets ``touched`` of ``table`` (whole, by its column ``bucket``) as ``version``; one without
    rows becomes an empty part. Then drop parts that no retained version needs."""
    spark, folder = table.sparkSession, version_path(root, buckets, version)
    table.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    for bucket in touched:
        make_folder(spark, f"{folder}/bucket={bucket}")
    if retain is None:
        return
    for own in _parts(spark, root, buckets).values():
        # of the versions up to the horizon the newest one is still in use
        for _, path in [part for part in own if part[0] <= version - retain][:-1]:
            remove(spark, path)


def upsert(
    changes: DataFrame,
    root: str,
    version: int,
    key: Sequence[str],
    merge: Merge,
    buckets: int = BUCKETS,
    retain: int | None = KEPT_VERSIONS,
    schema: StructType | None = None,
) -> None:
    """Write ``merge(before, changes)`` for the buckets that ``changes`` falls into.

    ``before`` is what these buckets held; ``merge`` gives whole buckets of the table's ``schema`` (by default
    that of ``changes``). Rows of one ``key`` always share a bucket. What is read and written follows the buckets touched, not the
    table. Without changes nothing is written.
    """
    spark, schema = changes.sparkSession, schema or changes.schema
    made = _buckets_of(spark, root)
    if made not in (None, buckets):
        raise ValueError(f"the table has {made} buckets, not {buckets}")
    changes = changes.persist()
    try:
        # at most as many numbers as there are buckets
        touched = [r[0] for r in changes.select(bucket_of(key, buckets)).distinct().collect()]
        if not touched:
            return
        known = _newest(_parts(spark, root, buckets), version - 1)
        before = read_parts(spark, [known[b] for b in touched if b in known], schema)
        after = merge(before, changes).select(*schema.names).withColumn("bucket", bucket_of(key, buckets))
        write_version(after, root, version, buckets, touched, retain)
    finally:
        changes.unpersist()
