"""Summaries, structure records, reports and baselines."""

from pyspark.sql import functions as F

from pagemill.operators import package
from pagemill.schemas import ASSETS


def documents(spark):
    return spark.createDataFrame([(1, "in/deck.pptx", "docling", "m", "auto", 12), (2, "x/notes", "pypdf", "m", "off", None)], "doc_id long, source string, engine string, mode string, ocr string, counted long")


def warned(spark):
    return spark.createDataFrame([(1, k, f"w{k}") for k in range(10)], "doc_id long, ord int, message string")


def test_summaries(spark):
    found = {r.doc_id: r.summary for r in package.conversion_summary(documents(spark), warned(spark)).collect()}
    lines = found[1].split("\n")
    assert lines[0] == "# deck.pptx" and "- Source type: slides" in lines and "- Expected slides: 12" in lines and "  - ... 2 more warnings omitted from summary" in lines and lines[-1] == ""
    assert "- Expected units: unknown" in found[2] and found[2].endswith("- Warnings: none recorded\n")
    contents = spark.createDataFrame([(1, "body")], "doc_id long, content string")
    assert package.with_summary(contents, package.conversion_summary(documents(spark), warned(spark))).first().content.endswith("\n---\n\nbody")
    shown = spark.range(1).select(package.integration_summary(F.lit("m"), F.lit("s.jsonl"), F.array(F.lit(9), F.lit(2))).alias("s")).first().s
    assert "- Integrated pages: 2, 9\n" in shown and shown.endswith("`content.md`.\n")


def test_structure_records(spark):
    assets = spark.createDataFrame([(1, "b.html", "assets/b.html", None, 1), (1, "a.png", "assets/a.png", None, 2)], ASSETS)
    attempts = spark.createDataFrame([(1, 1, "docling", 0), (1, 0, "mineru", 124)], "doc_id long, attempt_no int, engine string, returncode int")
    records = package.structure_records(documents(spark), assets, warned(spark), attempts)
    rated = spark.createDataFrame([(1, "pending"), (1, "described"), (1, "pending")], "doc_id long, status string")
    found = {r.doc_id: r for r in package.with_visual_record(records, rated, "c.md", "d.jsonl", "a.md").collect()}
    one, two = found[1], found[2]
    assert [(a.relative_path, a.kind) for a in one.assets] == [("a.png", "image"), ("b.html", "table")] and one.warnings[9] == "w9" and [a.engine for a in one.attempts] == ["mineru", "docling"]
    assert one.artifacts.assets == "assets" and one.artifacts.visual_audit_md == "a.md" and one.visual_description.total == 3 and one.visual_description.status_counts == {"described": 1, "pending": 2}
    assert two.assets == [] and two.warnings == [] and two.artifacts.assets is None and two.visual_description.status_counts == {} and tuple(two.expected_units) == ("units", None)
    assert package.structure_records(documents(spark), assets, warned(spark), attempts, "single-md").count() == 0
    packages = spark.createDataFrame([(1,), (7,)], "doc_id long")
    assert {r.doc_id: r.source for r in package.source_of(packages, records).collect()} == {1: "in/deck.pptx", 7: ""}


def test_reports(spark):
    routed = spark.createDataFrame([(1, 10, "keep", 0, "kept_mineru", []), (1, 2, "augment", 55, "augmented_numeric_warning", ["7.5", "9%"])], "doc_id long, page int, route string, score int, status string, novel array<string>")
    report = package.routed_report(routed, 30).first().report
    assert "- Risk threshold: 70\n- Pages: 2\n- Statuses: augmented_numeric_warning=1, kept_mineru=1\n" in report
    assert report.endswith("- Page 2: route=augment; status=augmented_numeric_warning; score=55; novel_numbers=7.5,9%\n- Page 10: route=keep; status=kept_mineru; score=0; novel_numbers=none\n")
    over = spark.createDataFrame([(1, 0, None, "original", None), (1, 2, 4, "integrated", ["dense_tables", "x"]), (1, 1, 3, "kept_original", None)], "doc_id long, ord int, page int, status string, flags array<string>")
    assert package.integration_report(over).first().report.endswith("pages: 1\n\n## Pages\n\n- Page 3: kept_original; risk_flags=none\n- Page 4: integrated; risk_flags=dense_tables, x\n")


def test_baselines(spark):
    contents = spark.createDataFrame([(1, "ä"), (2, "")], "doc_id long, content string")
    chunks = spark.createDataFrame([(1, "{}\n{}\n")], "doc_id long, content string")
    assert {r.doc_id: (r.bytes, len(r.sha256), r.chunk_lines) for r in package.baseline(contents, chunks).collect()} == {1: (2, 64, 2), 2: (0, 64, 0)}
