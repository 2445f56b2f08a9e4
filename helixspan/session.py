"""Session-level helpers: shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# Settings the library's jobs are meant to run with. Generated methods above 8000 bytes
# are never compiled by the JVM, so operators that would exceed it run unfused instead.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local masters."""
    ctx = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or ctx.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    current = ctx.getCheckpointDir()
    if current:
        return current
    if not ctx.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="helixspan-")
    ctx.setCheckpointDir(folder)
    return folder


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside, when their last reader is done.

    Frames that are built on them must have been written before the block ends.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        conf = spark._jsc.hadoopConfiguration()
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def tidy_job(job: Callable) -> Callable:
    """A job, with the session as first argument, that leaves no intermediate tables."""

    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        with tidy(spark):
            return job(spark, *args, **options)

    return run


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def hand_over(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the copy.

    Used where a reduced table (intervals, per-gene counts, ...) feeds a join: the
    heavy input is aggregated once, a lost executor cannot undo it, and the file
    size is a fact by the time the join is planned. Spark then broadcasts the
    table only if it is below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles both sides otherwise, so no broadcast hint is needed anywhere.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
