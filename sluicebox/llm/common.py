"""What the operators share: the shared folder, written intermediate tables, word hashes."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_own: dict[str, str] = {}


def importable(run):
    """Lets Python workers import this repository where it is not installed, as in a checkout that
    driver and executors both see; `run` takes the session first."""

    @functools.wraps(run)
    def with_path(spark: SparkSession, *args):
        env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
        return run(spark, *args)

    return with_path


def shared_dir(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`; only a local session without one makes its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _own[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and lost executors lose
    nothing of it."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(*columns: str | Column, over: int) -> Column:
    """A salt in 0..over-1 that depends on values only, so a task that runs again gives the same."""
    return F.pmod(F.xxhash64(*columns), F.lit(over)).cast("int")


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered while they fit in `limit` entries."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        from xxhash import xxh64_intdigest

        self.limit, self.hash = limit, xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        value = self.hash(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser over each value."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of `n` words; of the whole sequence where it is shorter, none for no words."""
    if not len(word_hashes):
        return word_hashes
    n = min(n, len(word_hashes))
    out = np.zeros(len(word_hashes) - n + 1, np.uint64)
    for k in range(n):
        out = mixed(out ^ word_hashes[k : len(word_hashes) - n + 1 + k], k)
    return out
