"""Reading Parquet tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes up to which a table that is one file is dealt to all cores: such a file may be a single row group, and so a single task.
SMALL = 64 << 20


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of any number of files; one small file is spread over the cores, anything else is read as it lies."""
    rows = spark.read.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
    return rows.repartition(spark.sparkContext.defaultParallelism) if status.isFile() and status.getLen() < SMALL else rows


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; one of our own only for a plain ``local`` master that has none set, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor shares")
        root = "file://" + tempfile.mkdtemp(prefix="pagemill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/pagemill/{name}-{uuid.uuid4().hex}"
