"""Segments, chunks, rendering, cleaning, routing and overlays."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagemill.operators import blocks, integrate, routing, segment, semantics
from pagemill.schemas import PAGE_SEMANTICS, PAGE_TEXT

from .test_scoring import block


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")


def chunks_of(spark, text):
    return [(r.page, r.text) for r in segment.page_chunks(docs_of(spark, text)).orderBy("chunk_index").collect()]


def test_page_chunks(spark):
    assert chunks_of(spark, "## Page 1\na\n\n## Page 2\nb") == [(1, "## Page 1\na"), (2, "## Page 2\nb")]
    assert chunks_of(spark, "# t\n\n## 第 1 页\na\n## 第 2 页\n\n## 第 3 页\nc") == [(None, "# t"), (1, "## 第 1 页\na"), (2, "## 第 2 页"), (3, "## 第 3 页\nc")]
    assert chunks_of(spark, " no pages ") == [(None, "no pages")] and chunks_of(spark, "") == [(None, "")]
    assert chunks_of(spark, "\n\n## Page 2x\n## Page 3 y") == [(3, "## Page 3 y")] or chunks_of(spark, "\n\n## Page 2x\n## Page 3 y") == [(None, "## Page 2x"), (3, "## Page 3 y")]


def test_the_last_section_of_a_page_counts(spark):
    found = segment.page_bodies(docs_of(spark, "x\n## Page 1 tail\na\n## Page 2\nb\n## Page 1\nc\n"))
    assert {r.page: r.body for r in found.collect()} == {1: "c", 2: "b"}
    assert segment.page_bodies(docs_of(spark, "## Page 1 tail\na")).first().body == "tail\na"
    assert [r.page for r in segment.sections(docs_of(spark, "p\n## Page 1\na\n## Page 1\nb")).orderBy("ord").collect()] == [None, 1, 1]


def plain_chunks(content, most):
    """Units first, then as many lines of a unit as fit at a time."""
    units = [(None, [])]
    for line in content.splitlines():
        if head := re.match(r"##\s+(page|slide)\s+(\d+)\b", line, re.I):
            units.append((":".join(head.groups()).lower(), []))
        units[-1][1].append(line)
    out = []
    for unit, lines in units:
        while lines:
            fits = 1
            while fits < len(lines) and sum(map(len, lines[: fits + 1])) + fits <= most:
                fits += 1
            out.append((unit, "\n".join(lines[:fits]).strip()))
            lines = lines[fits:]
    return [c for c in out if c[1]]


def test_greedy_chunks_are_those_of_a_loop(spark):
    draw = random.Random(6)
    texts = ["", "\n\n", "a" * 50, "## SLIDE 3\nx\r\ny z"]
    for _ in range(40):
        lines = []
        for _ in range(draw.randrange(30)):
            lines.append(draw.choice(["", " ", "## Page 4", "##  slide 12 x", "## Pages 3", "w" * draw.choice([1, 9, 10, 19, 20, 21, 45])]))
        texts.append("\n".join(lines))
    found = segment.greedy_chunks(docs_of(spark, *texts), most=20).collect()
    for k, text in enumerate(texts):
        got = sorted((r.chunk_index, r.page_or_slide, r.text) for r in found if r.doc_id == k)
        assert got == [(n, *c) for n, c in enumerate(plain_chunks(text, 20))], text


def test_blocks_are_rendered_by_type(spark):
    rows = [
        block(1, 0, 0, "text", " Title ", text_level=1), block(1, 1, 0, "text", "deep", text_level=6), block(1, 2, 0, "text", "odd", text_level=7), block(1, 3, 0, "text", " "), block(1, 4, 0, "footer", "f"),
        block(1, 5, 1, "table", table_body="<table>", img_path="t.png"), block(1, 6, 1, "chart", content="c", chart_caption=["a", " b "], chart_footnote=["n"]), block(1, 7, 1, "image", image_caption=[""], img_path="i.png"),
        block(1, 8, 1, "equation", "e=1"), block(1, 9, None, "text", "nowhere"), block(1, 10, 1, "aside_text", "side"), block(1, 11, 1, None, "bare"),
    ]
    from pagemill.schemas import BLOCKS

    pages = blocks.render_pages(spark.createDataFrame(rows, BLOCKS))
    assert {r.page: r.markdown for r in pages.collect()} == {
        1: "## Page 1\n\n### Title\n\n###### deep\n\nodd\n\n*footer: f*\n",
        2: "## Page 2\n\n### Table: untitled table\n\n<table>\n\n![Table visual](t.png)\n\n### Chart: a; b; n\n\nc\n\n### Image: untitled visual\n\n![Image visual](i.png)\n\ne=1\n\n*aside_text: side*\n\nbare\n",
    }
    assert blocks.assemble(pages).first().content.count("## Page") == 2


def test_batches_are_put_together(spark):
    ledger = spark.createDataFrame([(1, 20, 39, "completed"), (1, 0, 19, "completed"), (2, 0, 19, "error"), (3, 20, 39, "completed"), (4, 20, 39, "completed")], "doc_id long, start_page int, end_page int, status string")
    items = spark.createDataFrame([(1, 20, 0, 0), (1, 20, 1, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 20, 0, 20), (3, 20, 1, 21), (4, 20, 0, None)], "doc_id long, start_page int, item_pos int, page_idx int")
    found = blocks.merge_batches(ledger, items).orderBy("doc_id", "start_page", "item_pos").collect()
    assert [(r.doc_id, r.page_idx) for r in found] == [(1, 0), (1, 20), (1, 21), (3, 20), (3, 21), (4, None)]
    files = spark.createDataFrame([(1, "b_content_list.json", 5), (1, "a_content_list.json", 5), (1, "a_content_list_v2.json", 9), (2, "x.json", 1)], "doc_id long, path string, size long")
    assert [(r.doc_id, r.path) for r in blocks.pick_content_list(files).collect()] == [(1, "a_content_list.json")]


PLACEHOLDER = "**Visual element 1: x**\n\n- Asset: `a.png`\n- Textual description: TODO\n- Uncertainty: no\n"
PAGES = [
    ("内部使用——严格保密\n*header: h*\nnormal\n*page_number: 3*", "normal"),
    (f"a\n\n### Image: untitled visual\n\n{PLACEHOLDER}\n\nb", "a\nb"),
    (f"a\n*HEADER: h*\n{PLACEHOLDER}*footer: 来源: x*\n\n\nb", "a\n> 来源: x\n\nb"),
    (f"{PLACEHOLDER}*header: h*\n\nb\n- Asset: stays", "b\n- Asset: stays"),
    ("*footer: © 2020*\n*footer: 资料来源 严格保密*\n*footer: 来源：y*", "> 资料来源 严格保密\n> 来源：y"),
    ("### Table: untitled table\n![p](q) z\n  indented  ", "### 表格\n  indented"),
    ("", ""),
    (f"{PLACEHOLDER}\n{PLACEHOLDER}tail", "tail"),
]


@pytest.mark.parametrize("source, want", PAGES)
def test_parsed_pages_are_cleaned(spark, source, want):
    want = want.replace("> 资料来源 严格保密\n", "")  # a label, whoever is cited
    assert spark.range(1).select(routing.clean_parsed_page(F.lit(source)).alias("o")).first().o == want


def test_answers_are_cleaned(spark):
    clean = lambda text, action="augment": spark.range(1).select(routing.clean_answer(F.lit(text), F.lit(action)).alias("o")).first().o
    assert clean("```\n严格保密\n# T\n![a](b)\nbody  \n\n\n\nx\n```") == "### T\nbody\n\nx"
    assert clean("#### T", "rewrite") == "###### T"
    assert clean("无需补充。") == "" and clean("无需补充" + "x" * 80) != "" and clean(None) == ""
    whole = lambda text: spark.range(1).select(routing.clean_recommended(F.lit(text)).alias("o")).first().o
    assert whole("## 推荐 Markdown\n# a\n> Page 3\n###### b\n\n\nc\n推荐 Markdown 是") == "### a\n###### b\n\nc\n推荐 Markdown 是"


def test_routes_decide_what_is_written(spark):
    bodies = spark.createDataFrame([(1, p, "body 10") for p in range(1, 9)], "doc_id long, page int, body string")
    routes = spark.createDataFrame([(1, 2, "augment", 50), (1, 3, "augment", 50), (1, 4, "augment", 50), (1, 5, "rewrite", 60), (1, 6, "rewrite", 60), (1, 7, "rewrite", 60), (1, 8, "augment", 1)], "doc_id long, page int, action string, score int")
    answers = spark.createDataFrame([(1, 3, "无需补充"), (1, 4, "saw 10 and 77"), (1, 5, ""), (1, 6, "new 55%"), (1, 7, "new 10"), (1, 1, "not asked"), (1, 8, "saw 33")], "doc_id long, page int, description string")
    text = spark.createDataFrame([(1, p, "layer 55%" if p == 6 else "33") for p in range(1, 9)], PAGE_TEXT)
    routed = routing.route_pages(bodies, routes, answers, text)
    found = {r.page: (r.route, r.status, r.novel, r.body) for r in routed.collect()}
    assert found == {
        1: ("keep", "kept_mineru", [], "body 10"), 2: ("augment", "fallback_missing_semantics", [], "body 10"), 3: ("augment", "kept_no_missing_visual_semantics", [], "body 10"),
        4: ("augment", "augmented_numeric_warning", ["77"], "body 10\n\nsaw 10 and 77"), 5: ("rewrite", "fallback_empty_rewrite", [], "body 10"), 6: ("rewrite", "rewritten", [], "new 55%"), 7: ("rewrite", "rewritten", [], "new 10"),
        8: ("augment", "augmented", [], "body 10\n\nsaw 33"),
    }
    final = routing.final_markdown(routed.where("page < 3").withColumn("body", F.when(F.col("page") == 2, "").otherwise(F.col("body")))).first().content
    assert final == "## 第 1 页\n\nbody 10\n\n## 第 2 页\n\n_本页无实质内容。_\n"
    expected = spark.createDataFrame([(1, 9)], "doc_id long, expected_pages int")
    assert [tuple(r) for r in routing.missing_pages(expected, bodies).collect()] == [(1, 9)]
    with pytest.raises(ValueError, match="1:9"):
        routing.require_complete(expected, bodies)


def rows_of(spark):
    rows = [(1, 0, 1, "m", 1, "described", None, "first", None), (1, 0, 2, "n", 1, "described", None, "", None), (1, 1, 0, "n", 1, "described", None, "last", None), (1, 1, 1, "m", 1, "error", None, None, "401 Unauthorized"), (1, 1, 2, "m", 2, "described", None, "two", None)]
    return spark.createDataFrame(rows, PAGE_SEMANTICS)


def test_which_answer_counts(spark):
    rows = rows_of(spark)
    assert {r.page: r.description for r in semantics.last_described(rows).collect()} == {1: "last", 2: "two"}
    assert {r.page: r.description for r in semantics.first_described(rows).collect()} == {1: "first", 2: "two"}
    assert {r.page: r.status for r in semantics.of_model(rows, "m").collect()} == {1: "error", 2: "described"}
    assert [r.page for r in semantics.of_model(rows, "m", rows.where("page = 2")).collect()] == [2]
    assert sorted(r.line_no for r in semantics.until_blocked(rows.where("model = 'm'")).collect()) == [1, 1]


def test_the_queue_is_every_model_for_every_selected_page(spark):
    routes = spark.createDataFrame([(1, 1, "keep"), (1, 2, "augment"), (1, 3, "rewrite")], "doc_id long, page int, action string")
    text = spark.createDataFrame([(1, 2, "x" * 100)], PAGE_TEXT)
    queue = semantics.task_queue(routes, text, ["a", "b"], 20)
    assert sorted((r.model, r.page, r.context) for r in queue.collect()) == [(m, p, "x" * 10 + "\n\n[...middle omitted...]\n\n" + "x" * 10 if p == 2 else "") for m in "ab" for p in (2, 3)]
    assert {(r.status, r.description) for r in semantics.run_queue(queue, semantics.DryRun()).collect()} == {("pending", None)}

    class Echo:
        def describe(self, model, prompt):
            if not prompt:
                raise RuntimeError("nothing to see")
            return model

    assert {(r.model, r.page, r.status, r.error) for r in semantics.run_queue(queue, Echo(), 2).collect()} == {("a", 2, "described", None), ("b", 2, "described", None), ("a", 3, "error", "nothing to see"), ("b", 3, "error", "nothing to see")}
    prompts = [spark.range(1).select(semantics.page_prompt(F.lit("ctx"), F.lit(a), F.lit(3), m, o).alias("p")).first().p for a in ("augment", "rewrite") for m in (True, False) for o in (True, False)]
    assert len(set(prompts)) == 6 and all("ctx" in p and "Page 3" in p for p in prompts)


def test_overlays(spark):
    docs = docs_of(spark, "# t\n\n## Page 1\na | b | c\n## Page 2\nb\n## Page 4\n" + "1 " * 25)
    answers = spark.createDataFrame([(0, 1, "described", "# new 不确定"), (0, 2, "error", None), (0, 4, "described", " ")], "doc_id long, page int, status string, description string")
    over = integrate.overlay(docs, answers)
    found = {r.page: (r.status, r.flags) for r in over.collect()}
    assert found == {None: ("original", None), 1: ("integrated", ["dense_tables", "semantic_uncertainty_or_unit_issue"]), 2: ("kept_original", []), 4: ("kept_original", ["many_numeric_values:26", "sample_review_page"])}
    whole = integrate.integrated(over).first()
    assert whole.integrated_pages == 1 and whole.content.startswith("# t\n\n## Page 1\n\n### new 不确定\n\n## Page 2\nb\n")


def test_a_long_document_has_all_its_chunks(spark):
    text = "\n".join(f"## Page {k}\n" + "x" * 100 for k in range(1, 1500)) + "\n" + "\n".join(["y" * 999] * 2000)
    rows = segment.greedy_chunks(docs_of(spark, text)).orderBy("chunk_index").collect()
    assert [r.page_or_slide for r in rows[:1498]] == [f"page:{k}" for k in range(1, 1499)]
    assert "\n".join(r.text for r in rows) == text and [r.chunk_index for r in rows] == list(range(len(rows)))
