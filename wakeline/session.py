"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping

from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def object_store_conf(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """S3A settings taken from the environment; empty when no endpoint is named.

    Keys are never written in code. Without explicit keys Hadoop's default
    credential provider chain applies.
    """
    env = os.environ if env is None else env
    endpoint = env.get("WAKELINE_S3_ENDPOINT")
    if not endpoint:
        return {}
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": env.get("WAKELINE_S3_PATH_STYLE", "true"),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": env.get("WAKELINE_S3_SSL", "true"),
    }
    if env.get("AWS_REGION"):
        conf["spark.hadoop.fs.s3a.endpoint.region"] = env["AWS_REGION"]
    if env.get("AWS_ACCESS_KEY_ID") and env.get("AWS_SECRET_ACCESS_KEY"):
        conf["spark.hadoop.fs.s3a.access.key"] = env["AWS_ACCESS_KEY_ID"]
        conf["spark.hadoop.fs.s3a.secret.key"] = env["AWS_SECRET_ACCESS_KEY"]
    return conf


def build_session(app: str = "wakeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package relies on: UTC and adaptive execution.

    Size settings (shuffle partitions, memory) are left to the cluster; pass
    them in ``conf`` where needed.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**object_store_conf(), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def package_on_workers(spark: SparkSession) -> None:
    """Python workers started from now on also search the folder this package was imported from.

    On a cluster the package is installed or sent with --py-files; a folder that is not there does no harm.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        environment["PYTHONPATH"] = ":".join([*known, root])


@cache
def _own_dir() -> str:
    """One temporary folder for this process, removed when it ends."""
    path = tempfile.mkdtemp(prefix="wakeline-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``, or the checkpoint folder that was set
    on the context.

    Only where neither is set and Spark runs in local mode is a temporary folder
    of this machine used; on a cluster without a shared folder this fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_dir()


def working_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
