"""Shared scratch space: cut lineage by writing a table, never on local disks.

Executors may be lost at any time, so intermediate results that must not be
computed twice go to the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Folders made by this process; ``clean_scratch`` deletes them.
_made: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder for staged tables; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tradeloom-")
    spark.sparkContext.setCheckpointDir(made)
    return scratch_root(spark)


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def clean_scratch(spark: SparkSession) -> int:
    """Delete all folders that ``new_folder`` has given out; returns their number.

    Results that read them must have been used or written by then.  It also
    runs when the driver's Python ends while its session is still up.
    """
    done = 0
    while _made:
        delete_folder(spark, _made.pop())
        done += 1
    return done


def _at_exit() -> None:
    context = SparkContext._active_spark_context
    if _made and context is not None and context._jsc is not None:
        clean_scratch(SparkSession(context))


atexit.register(_at_exit)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: fixed rows, short lineage, prunable."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the visible entries of a folder; none if it does not exist."""
    fs, target = _file_system(spark, folder)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write one small new file, whole; False if the name is taken.

    The text goes to a hidden file first and is then renamed without
    overwriting, so of two writers one gets the name and no reader sees a part.
    """
    folder, _ = path.rsplit("/", 1)
    fs, hidden = _file_system(spark, f"{folder}/_{uuid.uuid4().hex}.tmp")
    out = fs.create(hidden)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(hidden.toUri() if hidden.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(hidden, hadoop.Path(path), plain)
    except Py4JJavaError as error:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True
