"""Final Markdown: parsed pages cleaned, model answers cleaned, one joined to the other as each page's route says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS_IN_LINE, compact_blank_lines, is_boilerplate, is_confidential, let, novel_numbers, one_break, relevel_heading, rstrip, split_lines, strip, unwrap_fence

IMAGE = r"!\[[^\]]*\]\([^)]*\)"
_MARK = "\ue000"  # a private-use character; stands for a placeholder that is taken out
# fixed value
EMPTY_PAGE = "_本页无实质内容。_"


def clean_parsed_page(text: Column) -> Column:
    """A parser's page without furniture, confidentiality labels, image links and visual placeholders."""
    ws = WS_IN_LINE
    # a placeholder takes the blank lines and its own three notes after it along
    marked = F.regexp_replace(one_break(text), rf"(?Umd)^{ws}*\*\*Visual element \d+:.*\*\*{ws}*$(?:\n{ws}*(?:- (?:Asset|Textual description|Uncertainty):.*)?$)*", _MARK)
    footer = rf"(?Uid)\A\*footer:{ws}*(.*?)\*\z"

    def kept(line: Column) -> Column:
        return let(strip(line), lambda bare: kept_bare(line, bare))

    def kept_bare(line: Column, bare: Column) -> Column:
        cited = strip(F.regexp_extract(bare, footer, 1))
        source = cited.rlike(r"\A(?:资料来源|来源：|来源:)") & ~is_confidential(cited)
        return (
            F.when(bare == _MARK, F.lit(_MARK))
            .when(bare.rlike(rf"(?Ui)\A###{ws}+(?:Image|Chart):{ws}+untitled{ws}+(?:visual|chart)\z"), None)
            .when(bare.rlike(r"(?i)\A\*(?:header|page_number):"), None)
            .when(bare.rlike(footer), F.when(source, F.concat(F.lit("> "), cited)))
            .when(is_confidential(bare) | bare.rlike(IMAGE), None)
            .when(bare == "### Table: untitled table", F.lit("### 表格"))
            .otherwise(rstrip(line))
        )

    lines = F.array_compact(F.transform(F.split(marked, "\n"), kept))
    joined = F.regexp_replace(F.array_join(lines, "\n"), rf"(?Umd)(?:^{ws}*\n)*^{_MARK}(?:\n|\z)", "")
    return compact_blank_lines(joined)


def clean_answer(text: Column, action: Column) -> Column:
    """A model's Markdown without fence, labels and images, with headings below the page's; empty if it says that nothing is missing."""
    lines = F.filter(split_lines(unwrap_fence(text)), lambda x: ~(x.rlike(IMAGE) | is_confidential(x)))
    cleaned = compact_blank_lines(F.array_join(F.transform(lines, lambda x: relevel_heading(x, action)), "\n"))
    return let(cleaned, lambda x: F.when(x.contains("无需补充") & (F.length(x) < 80), F.lit("")).otherwise(x))


def clean_recommended(text: Column) -> Column:
    """A model's whole-page Markdown without boilerplate, its headings two levels down."""
    lines = F.filter(split_lines(unwrap_fence(text)), lambda x: ~(is_boilerplate(x) | (x.contains("推荐 Markdown") & x.rlike(rf"(?U)\A{WS_IN_LINE}*#"))))
    lowered = F.transform(lines, lambda x: F.when(x.rlike(rf"(?U)\A#{{1,5}}{WS_IN_LINE}+."), F.concat(F.lit("##"), x)).otherwise(x))
    return compact_blank_lines(F.array_join(lowered, "\n"))


def route_pages(bodies: DataFrame, routes: DataFrame, answers: DataFrame, page_text: DataFrame) -> DataFrame:
    """doc_id, page, route, score, status, novel, body.

    bodies: doc_id, page, body.  routes: doc_id, page, action, score.  answers: doc_id, page, description (one a page).
    """
    keys = ["doc_id", "page"]
    rows = bodies.join(routes.select(*keys, "action", "score"), keys, "left").join(answers.select(*keys, "description", F.lit(True).alias("answered")), keys, "left").join(page_text, keys, "left")
    action = F.coalesce("action", F.lit("keep"))
    rows = rows.select(*keys, "body", action.alias("route"), F.coalesce("score", F.lit(0)).alias("score"), F.coalesce("answered", F.lit(False)).alias("answered"), "pdf_text", clean_answer(F.col("description"), action).alias("generated"))
    evidence = F.concat("body", F.lit("\n"), F.coalesce("pdf_text", F.lit("")))
    asked = F.col("route").isin("augment", "rewrite") & F.col("answered")
    rows = rows.select("*", clean_parsed_page(F.col("body")).alias("parsed"), F.when(asked, novel_numbers(F.col("generated"), evidence)).otherwise(F.array().cast("array<string>")).alias("novel"))
    some, warned = F.col("generated") != "", F.size("novel") > 0
    status = (
        F.when(~F.col("route").isin("augment", "rewrite"), "kept_mineru")
        .when(~F.col("answered"), "fallback_missing_semantics")
        .when((F.col("route") == "augment") & ~some, "kept_no_missing_visual_semantics")
        .when(F.col("route") == "augment", F.when(warned, "augmented_numeric_warning").otherwise("augmented"))
        .when(~some, "fallback_empty_rewrite")
        .otherwise(F.when(warned, "rewritten_numeric_warning").otherwise("rewritten"))
    )
    rows = rows.withColumn("status", status)
    body = F.when(F.col("status").startswith("augmented"), F.concat(rstrip(F.col("parsed")), F.lit("\n\n"), "generated")).when(F.col("status").startswith("rewritten"), F.col("generated")).otherwise(F.col("parsed"))
    return rows.select(*keys, "route", "score", "status", "novel", body.alias("body"))


def final_markdown(routed: DataFrame, body: str = "body") -> DataFrame:
    """doc_id, content: all pages under their headings, a note where a page has nothing."""
    own = F.when(F.col(body) != "", F.col(body)).otherwise(EMPTY_PAGE)
    section = F.concat(F.lit("## 第 "), F.col("page").cast("string"), F.lit(" 页\n\n"), own, F.lit("\n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("page", section.alias("s")))), lambda x: x["s"])
    return routed.groupBy("doc_id").agg(F.concat(rstrip(F.array_join(listed, "\n")), F.lit("\n")).alias("content"))


def missing_pages(expected: DataFrame, present: DataFrame) -> DataFrame:
    """doc_id, page of the pages 1 to expected_pages that ``present`` lacks."""
    wanted = expected.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("expected_pages").cast("int"))).alias("page"))
    return wanted.join(present.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti")


def require_complete(expected: DataFrame, present: DataFrame) -> None:
    """An error if any page is missing; at most some are named."""
    lost = missing_pages(expected, present).orderBy("doc_id", "page").limit(20).collect()
    if lost:
        raise ValueError("refusing incomplete Markdown; missing pages: " + ", ".join(f"{r.doc_id}:{r.page}" for r in lost))
