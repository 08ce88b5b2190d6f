"""Model answers about pages: which one counts, what is still to be asked, what came of it."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compact_text, is_blocking

def _order() -> Column:
    return F.struct("src_file_ord", "line_no")


def last_described(rows: DataFrame) -> DataFrame:
    """One described answer a page: the last in file and line order, whatever the model."""
    described = rows.where("status = 'described'")
    return described.groupBy("doc_id", "page").agg(F.max_by(F.struct("model", "description"), _order()).alias("r")).select("doc_id", "page", "r.model", "r.description")


def first_described(rows: DataFrame) -> DataFrame:
    """One described, non-empty answer a page: the first in file and line order."""
    described = rows.where("status = 'described' AND trim(description) <> ''")
    return described.groupBy("doc_id", "page").agg(F.min_by(F.struct("model", "description"), _order()).alias("r")).select("doc_id", "page", "r.model", "r.description")


def of_model(rows: DataFrame, model: str, pages: DataFrame | None = None) -> DataFrame:
    """One row a page of one model, the last, of whatever status; of the given pages alone, if any are given."""
    own = rows.where(F.col("model") == model)
    if pages is not None:
        own = own.join(pages.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_semi")
    return own.groupBy("doc_id", "page").agg(F.max_by(F.struct("status", "description", "error"), _order()).alias("r")).select("doc_id", "page", "r.status", "r.description", "r.error")


def task_queue(routes: DataFrame, page_text: DataFrame, models: list[str], most: int = 9000) -> DataFrame:
    """doc_id, model, page, action, context: every selected page for every model."""
    spark = routes.sparkSession
    asked = routes.where("action <> 'keep'").select("doc_id", "page", "action").join(page_text, ["doc_id", "page"], "left")
    named = spark.range(1).select(F.explode(F.array(*map(F.lit, models))).alias("model"))
    # a handful of models, given by the caller
    return asked.crossJoin(F.broadcast(named)).select("doc_id", "model", "page", "action", compact_text(F.coalesce("pdf_text", F.lit("")), most).alias("context"))


#: What a model is asked for: everything, what a picture adds, a page anew; and what to do about boilerplate.
FULL = "Describe this page: summary, text, tables, visuals, then the section '推荐 Markdown' and what is uncertain."
ADD = "Add what the picture of this page shows and its text does not. One section '### 视觉与版面语义', Markdown only, no images, no fences."
ANEW = "Write this page anew as Markdown, from its picture and its text. No images, no fences."
OMIT = "Leave out headers, footers, watermarks, logos, confidentiality labels and page numbers that carry no content."
KEEP = "Keep text that tells where the content comes from; headers, footers and watermarks come last."


def page_prompt(context: Column, action: Column, page: Column, markdown_only: bool = True, omit_boilerplate: bool = True) -> Column:
    """What a model is asked about a page: three forms, each with or without the rule on boilerplate."""
    rule = OMIT if omit_boilerplate else KEEP
    tail = F.concat(F.lit(f"\n{rule}\n\nPage "), page.cast("string"), F.lit(", text as parsed:\n\n"), context)
    asked = F.when(action == "augment", F.lit(ADD)).otherwise(F.lit(ANEW)) if markdown_only else F.lit(FULL)
    return F.concat(asked, tail)


VISUAL = "Describe this visual element for a reader who cannot see it, in Markdown bullets: kind, labels, structure or axes, what it shows, what follows from it, what is uncertain. Only what is visible."


def visual_prompt(visual_id: Column, page: Column, label: Column, asset: Column, before: Column, after: Column) -> Column:
    """What a model is asked about a single visual, with what stands around it."""
    where = F.concat(F.lit("Visual "), visual_id.cast("string"), F.lit(", page "), F.coalesce(page.cast("string"), F.lit("unknown")), F.lit(", "), label, F.lit(" ("), asset, F.lit(")"))
    return F.concat(F.lit(VISUAL + "\n\n"), where, F.lit("\n\nBefore:\n"), before, F.lit("\n\nAfter:\n"), after)


class Provider(Protocol):
    """Answers (doc_id, model, page, prompt) rows; runs within a task."""

    def describe(self, model: str, prompt: str) -> str: ...


class DryRun:
    """Leaves every page pending."""


def run_queue(queue: DataFrame, provider: Provider | DryRun, parallel: int | None = None) -> DataFrame:
    """doc_id, model, page, action, context, status, description, error.  ``parallel`` bounds the tasks that call at once."""
    if isinstance(provider, DryRun):
        none = F.lit(None).cast("string")
        return queue.select("doc_id", "model", "page", "action", "context", F.lit("pending").alias("status"), none.alias("description"), none.alias("error"))

    def ask(batches: Iterator) -> Iterator:
        for frame in batches:
            found = []
            for model, prompt in zip(frame["model"], frame["context"], strict=True):
                try:
                    found.append(("described", provider.describe(model, prompt), None))
                except Exception as error:  # an answer that fails is a row that says so
                    found.append(("error", None, str(error)))
            frame = frame[["doc_id", "model", "page", "action", "context"]].copy()
            frame["status"], frame["description"], frame["error"] = zip(*found, strict=True) if found else ([], [], [])
            yield frame

    rows = queue.repartition(parallel) if parallel else queue
    return rows.mapInPandas(ask, "doc_id long, model string, page int, action string, context string, status string, description string, error string")


def until_blocked(rows: DataFrame) -> DataFrame:
    """The rows of each document and model up to its first blocking error, in order of pages."""
    before = Window.partitionBy("doc_id", "model").orderBy("src_file_ord", "line_no").rowsBetween(Window.unboundedPreceding, -1)
    blocked = F.max(F.when((F.col("status") == "error") & is_blocking(F.col("error")), 1).otherwise(0)).over(before)
    return rows.withColumn("b", F.coalesce(blocked, F.lit(0))).where("b = 0").drop("b")
