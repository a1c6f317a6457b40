"""Small files and folders of the shared store, by Hadoop's file systems: only Spark may be able to reach it."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """Hadoop's path, with links of a view resolved, and its file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    parent = target.getParent()
    fs.mkdirs(parent)
    target = jvm.org.apache.hadoop.fs.Path(fs.resolvePath(parent), target.getName())
    return target, target.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written, with all it holds."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text`` unless it exists; tells whether this call created it.

    The text is written beside it first, and the whole file then takes the name in one step that fails where the name
    is taken: a hard link in a mounted folder, elsewhere a rename that may not overwrite, as Spark's own streaming log does.
    Of any number of callers exactly one creates the file, and no reader sees a part of it. A store without an atomic rename
    (a plain object store) cannot promise that.
    """
    target, fs = _path(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(beside.toUri().getPath(), target.toUri().getPath())
        else:
            option = jvm.org.apache.hadoop.fs.Options.Rename
            never = gateway.new_array(option, 1)
            never[0] = option.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(beside, target, never)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        fs.delete(beside, False)
