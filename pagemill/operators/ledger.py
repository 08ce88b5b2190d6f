"""Page batches that can be taken up again, and engines tried in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_PAGES = 20
#: Fixed values, in the order in which they are tried.
ENGINES = ["mineru", "docling", "markitdown", "pymupdf", "pypdf"]


def plan(pages: DataFrame, size: int = BATCH_PAGES) -> DataFrame:
    """doc_id, start_page, end_page, from 0; documents that fit one batch are one.  pages: doc_id, page_count."""
    n = F.col("page_count")
    starts = F.sequence(F.lit(0), (n - 1).cast("int"), F.lit(size))
    rows = pages.where(n > 0).select("doc_id", n.alias("n"), F.explode(starts).alias("start_page"))
    return rows.select("doc_id", "start_page", (F.least(F.col("start_page") + size, F.col("n")) - 1).cast("int").alias("end_page"))


def current(records: DataFrame) -> DataFrame:
    """The last record of each batch."""
    last = F.max_by(F.struct("status", "content_list"), "seq").alias("r")
    return records.groupBy("doc_id", "start_page", "end_page").agg(last, F.max("seq").alias("seq")).select("doc_id", "start_page", "end_page", "seq", "r.status", "r.content_list")


def pending(planned: DataFrame, records: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Planned batches that are not completed, or whose file is gone.  files: content_list."""
    done = current(records).where("status = 'completed'")
    if files is not None:
        done = done.join(files.select("content_list").distinct(), "content_list", "left_semi")
    return planned.join(done, ["doc_id", "start_page", "end_page"], "left_anti")


def first_success(attempts: DataFrame) -> DataFrame:
    """doc_id, engine of the first attempt that returned 0."""
    return attempts.where("returncode = 0").groupBy("doc_id").agg(F.min_by("engine", "attempt_no").alias("engine"))


def ranges(pages: DataFrame) -> DataFrame:
    """doc_id, first_page, last_page of runs of pages without a gap."""
    order = Window.partitionBy("doc_id").orderBy("page")
    runs = pages.select("doc_id", "page").distinct().withColumn("run", F.col("page") - F.row_number().over(order))
    return runs.groupBy("doc_id", "run").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page")).drop("run")
