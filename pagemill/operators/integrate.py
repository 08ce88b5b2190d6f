"""Model answers written over parsed pages, with flags for pages that need a second look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import recommended_section, rstrip
from .segment import sections

# fixed values
UNCERTAIN = ["不确定", "冲突", "推断", "单位"]


def risk_flags(page: Column, original: Column, answer: Column, sampled: tuple[int, ...] = (4, 6, 8)) -> Column:
    n = lambda pattern: F.regexp_count(original, F.lit(pattern))
    numbers, tables, visuals = n(r"(?U)[$¥%]|\d+(?:\.\d+)?"), n(r"<table") + n(r"\|"), n(r"\*\*Visual element")
    doubt = F.lit(False)
    for word in UNCERTAIN:
        doubt = doubt | answer.contains(word)
    return F.array_compact(F.array(
        F.when(numbers >= 25, F.concat(F.lit("many_numeric_values:"), numbers.cast("string"))), F.when(tables >= 2, F.lit("dense_tables")),
        F.when(visuals >= 3, F.concat(F.lit("many_visual_elements:"), visuals.cast("string"))), F.when(doubt, F.lit("semantic_uncertainty_or_unit_issue")),
        F.when(page.isin(list(sampled)), F.lit("sample_review_page")),
    ))


def overlay(docs: DataFrame, answers: DataFrame, content: str = "content") -> DataFrame:
    """doc_id, ord, page, status, flags, text: each section with what takes its place.

    answers: doc_id, page, status, description, one a page.  Sections without an answer stay, and so do those
    whose answer is an error or empty.
    """
    rows = sections(docs, content).join(answers, ["doc_id", "page"], "left")
    written = recommended_section(F.col("description"))
    usable = (F.col("status") == "described") & (written != "")
    status = F.when(F.col("page").isNull() | F.col("status").isNull(), "original").when(usable, "integrated").otherwise("kept_original")
    heading = F.concat(F.lit("## Page "), F.col("page").cast("string"), F.lit("\n\n"), written, F.lit("\n\n"))
    text = F.when(status == "integrated", heading).otherwise(F.col("section"))
    flags = F.when(F.col("status").isNotNull(), risk_flags(F.col("page"), F.col("section"), F.coalesce("description", F.lit(""))))
    return rows.select("doc_id", "ord", "page", status.alias("status"), flags.alias("flags"), text.alias("text"))


def integrated(overlaid: DataFrame) -> DataFrame:
    """doc_id, content, integrated_pages."""
    listed = F.array_sort(F.collect_list(F.struct("ord", "text")))
    whole = F.concat(rstrip(F.array_join(F.transform(listed, lambda s: s["text"]), "")), F.lit("\n"))
    return overlaid.groupBy("doc_id").agg(whole.alias("content"), F.count_if(F.col("status") == "integrated").cast("long").alias("integrated_pages"))
