"""Extraction risk of each page, and what is to be done about it.

``features`` is one aggregation over blocks and one join with the pages' own text; ``scored`` and ``routed``
are projections.  All keys are (doc_id, page), so a long document spreads over tasks page by page.  Texts are
measured where they are read: what a page needs of them adds up, so only numbers are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed2, numeric_count, round3, visible_length, without_tags

FURNITURE = ["header", "footer", "page_number"]
VISUAL = ["chart", "image"]


def caption_value(captions: Column, as_listed: bool = True) -> Column:
    """A caption list as evidence.  As listed: with the brackets and quotes of its printed form; else joined by spaces."""
    present = captions.isNotNull() & (F.size(captions) > 0)
    joined = F.concat(F.lit("['"), F.array_join(captions, "', '"), F.lit("']")) if as_listed else F.array_join(captions, " ")
    return without_tags(F.when(present, joined).otherwise(F.lit("")))


def block_measures(blocks: DataFrame, as_listed: bool = True) -> DataFrame:
    """Per block what pages add up; blocks without a page count as the first page's."""
    kind = F.coalesce("type", F.lit("None"))
    text = without_tags(F.col("text"))
    meaningful, visual = ~kind.isin(FURNITURE), kind.isin(VISUAL)
    captions = [caption_value(F.col(c), as_listed) for c in ("table_caption", "image_caption", "chart_caption")]
    pieces = F.filter(F.array(text, without_tags(F.col("table_body")), *captions), lambda x: x != "")
    box = F.col("bbox")
    area = F.greatest(F.lit(0.0), box[2] - box[0]) * F.greatest(F.lit(0.0), box[3] - box[1]) / 1_000_000
    rows = blocks.select(
        "doc_id", (F.coalesce("page_idx", F.lit(0)) + 1).alias("page"), "block_pos", kind.alias("type"), meaningful.alias("meaningful"), visual.alias("visual"),
        F.when(meaningful, F.array_join(pieces, " ")).otherwise(F.lit("")).alias("evidence"),
        F.when(kind == "text", text).otherwise(F.lit("")).alias("own_text"),
        F.when(visual & (F.size("bbox") == 4), area).otherwise(F.lit(0.0)).alias("area"),
        (visual & ((captions[1] != "") | (captions[2] != ""))).alias("captioned"),
        (meaningful & (kind == "text") & F.length(text).between(1, 30)).alias("short"),
    )
    # pieces are joined by a space, which is no visible character and part of no number
    return rows.withColumns({
        "evidence_chars": visible_length(F.col("evidence")).cast("long"), "numeric_tokens": numeric_count(F.col("evidence")).cast("long"),
        "own_chars": F.length("own_text").cast("long"),
    })


def _ordered_join(value: str) -> Column:
    """Non-empty values in the order of their blocks."""
    listed = F.array_sort(F.collect_list(F.when(F.col(value) != "", F.struct("block_pos", F.col(value).alias("v")))))
    return F.array_join(F.transform(listed, lambda s: s["v"]), " ")


def _counts() -> list[Column]:
    n = lambda c: F.count_if(c).cast("long")
    return [
        n(F.col("type") == "chart").alias("charts"), n(F.col("type") == "image").alias("images"), n(F.col("type") == "table").alias("tables"),
        n(F.col("meaningful")).alias("meaningful"), n(F.col("captioned")).alias("captioned"), n(F.col("short")).alias("short_text"),
        F.least(F.lit(1.0), F.sum("area")).alias("area"),
    ]


def page_evidence(blocks: DataFrame, as_listed: bool = True) -> DataFrame:
    """doc_id, page, counts and texts of each page that has blocks."""
    return block_measures(blocks, as_listed).groupBy("doc_id", "page").agg(*_counts(), _ordered_join("evidence").alias("evidence"), _ordered_join("own_text").alias("own_text"))


def page_measures(blocks: DataFrame, as_listed: bool = True) -> DataFrame:
    """doc_id, page, counts and the measures of the texts, which are added up before anything is shuffled."""
    own = F.sum("own_chars") + F.greatest(F.lit(0), F.count_if(F.col("own_chars") > 0) - 1)
    return block_measures(blocks, as_listed).groupBy("doc_id", "page").agg(*_counts(), F.sum("evidence_chars").alias("evidence_chars"), F.sum("numeric_tokens").alias("numeric_tokens"), own.alias("text_chars"))


def features(blocks: DataFrame, page_text: DataFrame, as_listed: bool = True) -> DataFrame:
    """One row a page of the page text, with or without blocks."""
    own = page_text.select("doc_id", "page", visible_length(F.col("pdf_text")).cast("long").alias("pdf_chars"))
    pages = own.join(page_measures(blocks, as_listed), ["doc_id", "page"], "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("charts", "images", "tables", "meaningful", "captioned", "short_text")]
    chars = F.coalesce("evidence_chars", F.lit(0))
    return pages.select(
        "doc_id", "page", *zero, F.coalesce("area", F.lit(0.0)).alias("area"), chars.alias("evidence_chars"), F.coalesce("text_chars", F.lit(0)).alias("text_chars"), "pdf_chars",
        F.least(F.lit(1.0), chars / F.greatest(F.lit(1), F.col("pdf_chars"))).alias("coverage"), F.coalesce("numeric_tokens", F.lit(0)).alias("numeric_tokens"),
    )


def _rules() -> list[tuple[Column, Column, Column]]:
    """(condition, points, reason) in the order in which reasons are told."""
    c = F.col
    visuals = c("charts") + c("images")
    two = fixed2  # pruned where reasons are not asked for
    named = lambda name, x: F.concat(F.lit(f"{name}:"), x.cast("string"))
    area, coverage = c("area"), c("coverage")
    return [
        (c("charts") > 0, F.least(F.lit(55), 40 + 8 * (c("charts") - 1)), named("chart_blocks", c("charts"))),
        (c("images") > 0, F.least(F.lit(35), 20 + 5 * (c("images") - 1)), named("image_blocks", c("images"))),
        (area >= 0.10, F.when(area >= 0.45, 30).when(area >= 0.25, 20).otherwise(10), F.concat(F.lit("visual_area:"), two(area))),
        (c("captioned") > 0, F.lit(10), named("captioned_visuals", c("captioned"))),
        ((c("images") >= 2) & (area >= 0.10), F.lit(15), F.lit("multi_panel_visual")),
        (coverage < 0.75, F.when(coverage < 0.45, 20).otherwise(10), F.concat(F.lit("text_coverage:"), two(coverage))),
        ((visuals > 0) & (c("text_chars") < 250), F.lit(10), named("low_text", c("text_chars"))),
        (c("meaningful") >= 10, F.when(c("meaningful") >= 16, 10).otherwise(5), named("layout_blocks", c("meaningful"))),
        ((c("short_text") >= 6) & (c("numeric_tokens") >= 5), F.lit(10), F.lit("kpi_or_callout_layout")),
        ((c("tables") > 0) & (visuals > 0), F.lit(10), F.lit("mixed_table_visual")),
    ]


def scored(pages: DataFrame) -> DataFrame:
    """Adds score and reasons to features."""
    rules = _rules()
    total = sum((F.when(when, points).otherwise(F.lit(0)) for when, points, _ in rules), F.lit(0))
    return pages.withColumns({"score": F.least(F.lit(100), total).cast("int"), "reasons": F.array_compact(F.array(*[F.when(when, reason) for when, _, reason in rules]))})


def routed(pages: DataFrame, sensitivity: int | Column = 50) -> DataFrame:
    """Adds the action to scored features.  Coverage and area are compared as they are reported: to three places."""
    if isinstance(sensitivity, int) and not 0 <= sensitivity <= 100:
        raise ValueError("sensitivity must lie between 0 and 100")
    threshold, c = 100 - (F.lit(sensitivity) if isinstance(sensitivity, int) else sensitivity), F.col
    coverage, area = round3(c("coverage")), round3(c("area"))
    pictures = (c("images") > 0) & (c("tables") == 0)
    hard = (pictures & (c("text_chars") == 0)) | (pictures & (coverage < 0.20))
    decorative = (threshold > 0) & (c("charts") == 0) & (c("images") > 0) & (area < 0.10) & (c("captioned") == 0) & (coverage >= 0.20)
    action = (
        F.when(decorative, "keep")
        .when((c("score") < threshold) & ~hard, "keep")
        .when((c("tables") > 0) | (c("charts") > 0), "augment")
        .when(hard | ((c("images") >= 3) & (c("text_chars") < 300)) | (c("text_chars") < 120), "rewrite")
        .otherwise("augment")
    )
    return pages.withColumn("action", action)


def routes(blocks: DataFrame, page_text: DataFrame, sensitivity: int = 50, as_listed: bool = True) -> DataFrame:
    return routed(scored(features(blocks, page_text, as_listed)), sensitivity)


def selection(routed_pages: DataFrame, sensitivity: int) -> DataFrame:
    """One row a document: pages, counts of each action, and the pages to describe."""
    from ..functions.text import page_spec

    n = lambda a: F.count_if(F.col("action") == a).cast("long").alias(a)
    chosen = F.collect_set(F.when(F.col("action") != "keep", F.col("page")))
    return routed_pages.groupBy("doc_id").agg(F.max("page").alias("expected_pages"), n("keep"), n("augment"), n("rewrite"), chosen.alias("p")).select(
        "doc_id", F.lit(sensitivity).alias("sensitivity"), F.lit(100 - sensitivity).alias("risk_threshold"), "expected_pages", "keep", "augment", "rewrite", page_spec(F.col("p")).alias("selected_page_spec")
    )
