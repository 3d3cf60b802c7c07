"""Session settings and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on; a cluster may set its own sizes on top of them.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}

_local_fallback: dict[str, str] = {}


def build_session(app: str = "sluicebox", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine's settings; keyword settings use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="sluicebox-")
    return _local_fallback[app]


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed, as in a checkout that driver and
    executors both see."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


# Spark's setting, how many blocks ask for it, and what it was before the first
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_sweeping: dict[str, tuple[int, str | None]] = {}
_sweep_lock = threading.Lock()


@contextmanager
def swept(spark: SparkSession):
    """Every query that runs inside deletes its shuffle files when it ends. Left to itself Spark keeps them until
    the driver's memory is cleaned, and a plan of many steps holds all its shuffles on disk at once. Blocks may
    nest and run in several threads."""
    session = spark._jsparkSession.sessionUUID()
    with _sweep_lock:
        depth, before = _sweeping.get(session, (0, None))
        if not depth:
            before = spark.conf.get(SWEEP, None)
            spark.conf.set(SWEEP, "true")
        _sweeping[session] = depth + 1, before
    try:
        yield
    finally:
        with _sweep_lock:
            depth, before = _sweeping.pop(session)
            if depth > 1:
                _sweeping[session] = depth - 1, before
            else:
                spark.conf.unset(SWEEP) if before is None else spark.conf.set(SWEEP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back, which cuts the lineage."""
    path = f"{shared_dir(df.sparkSession)}/sluicebox/work/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
