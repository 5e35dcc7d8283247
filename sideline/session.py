"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: ANSI semantics, UTC day boundaries, AQE for
# runtime re-planning (partition coalescing, skew-join splitting, broadcast
# switching based on measured sizes).
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of results that are no longer referenced are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "sideline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``, as it is named
    there (Spark adds a random sub-folder of its own, which no later process finds).

    Where the setting is absent, a scratch folder is made if the master is local (tests,
    one machine); on a cluster that would be a path on one machine, so it is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sideline-ckpt-"))
    return sc.getCheckpointDir()


def _stage_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sideline-stage/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back for the
    duration of a block; the staged table is deleted on exit.

    Cuts lineage for inputs that several sinks consume; the written table
    survives executor loss (unlike cached blocks) and later reads prune
    columns and push filters into the Parquet scan.
    """
    spark = df.sparkSession
    path = _stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


_kept: set[str] = set()


def _remove(path, conf) -> None:
    """Delete a folder when the driver ends (the session may have been stopped before)."""
    try:
        path.getFileSystem(conf).delete(path, True)
    except Exception as e:  # the JVM has ended before
        sys.stderr.write(f"{path} was not deleted: {type(e).__name__}\n")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``staged`` for results that outlive the call: the table stays until the driver ends, and is deleted then."""
    sc = df.sparkSession.sparkContext
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/sideline-kept/{sc.applicationId}"
    if folder not in _kept:
        _kept.add(folder)
        atexit.register(_remove, sc._jvm.org.apache.hadoop.fs.Path(folder), sc._jsc.hadoopConfiguration())
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
