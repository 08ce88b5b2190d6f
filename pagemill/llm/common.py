"""Shared helpers: tables written to the cluster's shared folder, and column plumbing.

Nothing here keeps data on one machine.  Intermediate tables go to the folder that
``spark.checkpoint.dir`` names; a folder of our own is made only for a plain ``local`` master
that has none set, as in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table, scratch

_written: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = scratch(spark, name)
    _written.append(path)
    return path


#: Rows of an Arrow batch that goes to Python: what a worker holds at once has a bound with long texts, too.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's rows an Arrow batch to ``BATCH_ROWS``, unless it has fewer."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many tables this process has written and not released."""
    return len(_written)


def release(spark: SparkSession, first: int = 0, last: int | None = None) -> None:
    """Delete the intermediate tables that this process has written (or those from ``first`` to ``last``); results that read them end with it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for gone in _written[first:last]:
        path = jvm.org.apache.hadoop.fs.Path(gone)
        path.getFileSystem(conf).delete(path, True)
    del _written[first:last]


#: A class is hot if it has more than one row in so many.
HOT = 1000


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str, salts: int = 64, how: str = "inner", total: int | None = None) -> DataFrame:
    """``rows`` with their class, by ``key``, which ``classes`` has once; ``size`` is how many rows a class has, ``total`` all of them together.

    There can't be more than ``HOT`` hot classes.  Each of them is repeated for every salt, so that its rows spread over as many tasks.
    """
    if total is None:
        total = classes.agg(F.sum(size)).first()[0] or 0
    hot = classes.where(F.col(size) * HOT > total).select(F.col(key).alias("hot"))
    marked = rows.join(F.broadcast(hot), rows[key] == hot["hot"], "left")
    salt = F.pmod(F.xxhash64(*rows.columns, F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    marked = marked.withColumn("salt", F.when(F.col("hot").isNotNull(), salt).otherwise(F.lit(0))).drop("hot")
    each = F.when(F.col(size) * HOT > total, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return marked.join(classes.withColumn("salt", F.explode(each)), [key, "salt"], how).drop("salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def restore(kept: DataFrame, columns: list[str]) -> DataFrame:
    """Only the given columns, in their order."""
    return kept.select(*[F.col(f"`{c}`") for c in columns])
