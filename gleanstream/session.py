"""What the library needs from a session it is given: a shared folder and its own code."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from datetime import datetime
from functools import cache

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a record batch for a Python task; a longer row goes on its own.
BATCH_BYTES = 4 << 20


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="gleanstream-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it.

    Only where driver and executors are one process, and nothing is set, is one made here.
    """
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder shared by the executors")
    return _local_dir()


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or cleared."""
    return f"{shared_dir(spark)}/gleanstream/{purpose}-{uuid.uuid4().hex}"


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, wherever the driver was started."""
    flag = "gleanstream.code.shipped"
    if spark.conf.get(flag, None):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="gleanstream-code-"), "gleanstream_code")
    archive = shutil.make_archive(target, "zip", root_dir=root, base_dir="gleanstream")
    spark.sparkContext.addPyFile(archive)
    spark.conf.set(flag, "true")


def bound_batches(spark: SparkSession) -> None:
    """Have record batches for Python tasks end by their bytes, not only by their rows.

    The engine's 10,000 rows a batch are a whole task's share when a row is a page. A session's own
    setting is left alone.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def now_stamp() -> str:
    """Driver-side wall clock as text, without a zone."""
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")
