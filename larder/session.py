"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Runtime re-planning does the sizing: partitions are coalesced or split from
# measured bytes, joins turn into broadcasts only after a side was measured.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # File sizes are compressed; estimates made before a run must not be.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.ansi.enabled": "true",
    # Recording a Python call site per column expression costs more than planning wide tables.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_partitions(input_bytes: int, per_task: int = 256 << 20, at_most: int = 50_000) -> int:
    """Shuffle width so that a task handles about ``per_task`` bytes of a full shuffle of the input.

    Runtime coalescing merges what turns out smaller, so this is an upper start
    value; beyond ``at_most`` the number of map outputs costs more than spilling.
    """
    return max(200, min(at_most, -(-input_bytes // per_task)))


def build_session(
    app: str = "larder", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above; ``conf`` uses ``_`` for ``.`` in names.

    Give ``input_bytes``, the size of the largest table to be shuffled, on a
    cluster: the stock width of 200 would make tasks of hundreds of gigabytes.
    """
    if input_bytes is not None:
        conf.setdefault("spark_sql_shuffle_partitions", str(shuffle_partitions(input_bytes)))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("_", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session may go without one: it gets a fresh temp folder. On a
    cluster a machine-local folder would lose data, so there the setting is
    required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="larder-")


def run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses; it goes when the session ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing will read again; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files go with the query that made them, not when the driver next collects garbage.

    For queries inside that end in a table written: nothing reads their shuffles again.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
