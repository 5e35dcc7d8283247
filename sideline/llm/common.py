"""Helpers shared by the operators."""

from __future__ import annotations

import atexit
import re
import sys
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a batch of rows sent to a Python worker (one row at least).
BATCH_BYTES = 8 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would change other letters too)."""
    return F.translate(c, UPPER, UPPER.lower())


def text_of(name: str = "text") -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. A scratch folder is made only
    where the setting is absent and the master is local (tests); elsewhere that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sideline-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage and survives lost executors. Where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, Spark removes the files once the result is no
    longer referenced; else they stay."""
    shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


_folders: set[str] = set()


def _remove(path, conf) -> None:
    """Delete a folder when the driver ends (the session may have been stopped before)."""
    try:
        path.getFileSystem(conf).delete(path, True)
    except Exception as e:  # the JVM has ended before
        sys.stderr.write(f"{path} was not deleted: {type(e).__name__}\n")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back. Unlike ``cut``, the result has a
    known size, so Spark's own threshold decides whether a join may broadcast it. Results are lazy, so the
    tables of an application stay until its driver ends, and are deleted then."""
    folder = f"{shared_dir(df.sparkSession)}/llm-{df.sparkSession.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        sc = df.sparkSession.sparkContext
        atexit.register(_remove, sc._jvm.org.apache.hadoop.fs.Path(folder), sc._jsc.hadoopConfiguration())
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> None:
    """Bound what travels to Python workers at a time: Arrow batches of BATCH_BYTES instead of 64 MB, each of which
    the JVM and the worker hold several times over. A session setting; it changes no result."""
    key, units = "spark.sql.execution.arrow.maxBytesPerBatch", {"k": 10, "m": 20, "g": 30}
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]?).*", df.sparkSession.conf.get(key).lower()).groups()
    now = int(number) << units.get(unit, 0)
    if now <= 0 or now > BATCH_BYTES:
        df.sparkSession.conf.set(key, f"{BATCH_BYTES}b")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
