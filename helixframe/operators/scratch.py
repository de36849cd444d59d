"""Tables and files that live while the driver does, in the folder that it shares with all executors."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a temporary one on a local master; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="helixframe-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; the folder is scratch space
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver's process ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def kept_table(df: DataFrame, name: str = "kept") -> DataFrame:
    """The rows as a Parquet table that is read again: later steps neither repeat the work nor lose it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    vars(table)["_scratch"] = path
    return table


def give_up(*tables: DataFrame) -> None:
    """Removes the files of kept tables that nothing will read again, as the steps of an iteration whose result is written; others stay."""
    for table in tables:
        if path := vars(table).pop("_scratch", None):
            _remove(table.sparkSession, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """kept_table() for the steps of iterations."""
    return kept_table(df, "step")
