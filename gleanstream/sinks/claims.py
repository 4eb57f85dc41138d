"""Names that only one writer gets.

A folder is made aside and renamed to a name that must be free. Of several writers that want the name,
one gets it and the others are told so; whoever reads the name sees the whole folder or none.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from gleanstream.sources.ranges import files_of, names_in


def put_if_absent(spark: SparkSession, stage: str, target: str) -> bool:
    """Rename a folder that is not empty to ``target``; False, and nothing changed, if that exists.

    One step in a distributed file system, whose rename refuses an existing target, and in a local
    one, which refuses a target folder with something in it.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    files, source = files_of(spark, stage)
    source, target_path = files.makeQualified(source), files.makeQualified(hadoop.Path(target))
    files.mkdirs(target_path.getParent())
    if files.getScheme() == "file":
        try:
            os.rename(source.toUri().getPath(), target_path.toUri().getPath())
        except OSError:
            if files.exists(target_path):
                return False
            raise
        return True
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.NONE
    context = hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(source, target_path, how)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    files, place = files_of(spark, path)
    files.delete(place, True)


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Take the name ``path`` for ``owner``; True if the owner has it now, or had it before."""
    if names_in(spark, path) == [owner]:
        return True
    stage = f"{path}-{uuid.uuid4().hex}"
    files, mark = files_of(spark, f"{stage}/{owner}")
    files.mkdirs(mark)
    won = put_if_absent(spark, stage, path)
    if not won:
        remove(spark, stage)
    return won
