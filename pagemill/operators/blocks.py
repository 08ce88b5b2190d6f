"""Blocks of a parser: merging batches, rendering pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import caption, strip


def merge_batches(ledger: DataFrame, items: DataFrame) -> DataFrame:
    """Blocks of completed batches in page order, with page numbers of the document.

    ledger: doc_id, start_page, end_page, status.  items: doc_id, start_page, item_pos, page_idx and more.
    A batch whose numbers all fit its own length is taken to count from its own first page.
    """
    done = ledger.where("status = 'completed'").select("doc_id", "start_page", "end_page")
    bounds = items.where("page_idx IS NOT NULL").groupBy("doc_id", "start_page").agg(F.min("page_idx").alias("low"), F.max("page_idx").alias("high"))
    batches = done.join(bounds, ["doc_id", "start_page"], "left")
    relative = F.coalesce((F.col("low") >= 0) & (F.col("high") <= F.col("end_page") - F.col("start_page")), F.lit(False))
    shift = batches.select("doc_id", "start_page", F.when(relative, F.col("start_page")).otherwise(0).alias("shift"))
    return items.join(shift, ["doc_id", "start_page"]).withColumn("page_idx", (F.col("page_idx") + F.col("shift")).cast("int")).drop("shift")


def pick_content_list(files: DataFrame) -> DataFrame:
    """doc_id, path: the largest content list of each document, the first by name of equals; second versions don't count."""
    own = files.where(F.col("path").endswith("_content_list.json") & ~F.col("path").endswith("_content_list_v2.json"))
    return own.groupBy("doc_id").agg(F.min_by("path", F.struct((-F.col("size")).alias("s"), "path")).alias("path"))


def block_lines() -> Column:
    """The Markdown lines of one block."""
    own = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    text, kind = own("text"), F.coalesce("type", F.lit("unknown"))
    some = lambda c, line: F.when(c != "", F.array(line, F.lit(""))).otherwise(F.array().cast("array<string>"))
    titled = lambda label, c: F.array(F.concat(F.lit(f"### {label}: "), F.when(c != "", c).otherwise("untitled table" if label == "Table" else "untitled visual")), F.lit(""))
    image = lambda label: some(own("img_path"), F.concat(F.lit(f"![{label} visual]("), own("img_path"), F.lit(")")))
    level = F.col("text_level")
    heading = F.when(level.between(1, 6), F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(3), level)), F.lit(" "), text)).otherwise(text)
    visual = caption(F.col("image_caption"), F.col("chart_caption"), F.col("image_footnote"), F.col("chart_footnote"))
    pictured = lambda label: F.concat(titled(label, visual), some(own("content"), own("content")), image(label))
    return (
        F.when(kind == "table", F.concat(titled("Table", caption(F.col("table_caption"))), some(own("table_body"), own("table_body")), image("Table")))
        .when(kind == "image", pictured("Image"))
        .when(kind == "chart", pictured("Chart"))
        .when(text == "", F.array().cast("array<string>"))
        .when(kind.isin("header", "footer", "page_number", "aside_text"), F.array(F.concat(F.lit("*"), kind, F.lit(": "), text, F.lit("*")), F.lit("")))
        .when(kind == "text", F.array(heading, F.lit("")))
        .otherwise(F.array(text, F.lit("")))
    )


def render_pages(blocks: DataFrame) -> DataFrame:
    """doc_id, page, markdown; blocks without a page are left out."""
    rows = blocks.where("page_idx IS NOT NULL").select("doc_id", (F.col("page_idx") + 1).alias("page"), F.struct("block_pos", block_lines().alias("l")).alias("b"))
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["l"]))
    pages = rows.groupBy("doc_id", "page").agg(ordered.alias("l"))
    return pages.select("doc_id", "page", F.array_join(F.concat(F.array(F.concat(F.lit("## Page "), F.col("page").cast("string")), F.lit("")), "l"), "\n").alias("markdown"))


def assemble(pages: DataFrame, body: str = "markdown", between: str = "\n") -> DataFrame:
    """doc_id, content: a document's pages in order."""
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.col(body).alias("b")))), lambda s: s["b"]), between).alias("content"))


def fallback_page(text: Column, page: Column, snapshot: Column) -> Column:
    """A page of a plain text layer, with its snapshot if there is one."""
    own = strip(F.coalesce(text, F.lit("")))
    # fixed values: what stands for no text, and the name of a snapshot
    shown = F.when(own != "", own).otherwise("[No extractable text]")
    picture = F.concat(F.lit("\n\n![Page "), page.cast("string"), F.lit(" snapshot]("), snapshot, F.lit(")"))
    return F.concat(F.lit("## Page "), page.cast("string"), F.lit("\n\n"), shown, F.when(snapshot.isNotNull(), picture).otherwise(""), F.lit("\n"))
