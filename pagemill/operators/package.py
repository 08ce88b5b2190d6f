"""What a package says of itself: summary, structure record, reports and baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import asset_kind, expected_units, source_kind, split_lines
from .audit import artifacts, warning_summary


def source_of(packages: DataFrame, structures: DataFrame) -> DataFrame:
    """Packages with the source their structure record names; empty if there is no record or it names none."""
    return packages.join(structures.select("doc_id", "source"), "doc_id", "left").withColumn("source", F.coalesce("source", F.lit("")))


def conversion_summary(documents: DataFrame, warnings: DataFrame) -> DataFrame:
    """doc_id, summary: what stands above a converted document.

    documents: doc_id, source, engine, mode, ocr, counted (units that a parser found).  warnings: doc_id, ord, message.
    """
    rows = documents.join(warning_summary(warnings).select("doc_id", F.col("lines").alias("listed")), "doc_id", "left")
    units = expected_units(F.col("source"), F.col("counted"))
    line = lambda label, value: F.concat(F.lit(f"- {label}: "), value)
    # fixed values: labels and their order
    parts = [
        F.concat(F.lit("# "), F.element_at(F.split("source", "/"), -1)), F.lit(""), F.lit("## Conversion Summary"), F.lit(""),
        line("Source", F.concat(F.lit("`"), "source", F.lit("`"))), line("Source type", source_kind(F.col("source"))), line("Engine", F.col("engine")), line("Mode", F.col("mode")), line("OCR preference", F.col("ocr")),
        F.concat(F.lit("- Expected "), units["unit"], F.lit(": "), F.coalesce(units["count"].cast("string"), F.lit("unknown"))), F.lit("- Images embedded: no"), F.lit(""),
        F.coalesce("listed", F.lit("- Warnings: none recorded")), F.lit(""),
    ]
    return rows.select("doc_id", F.concat_ws("\n", *parts).alias("summary"))


def with_summary(contents: DataFrame, summaries: DataFrame) -> DataFrame:
    """doc_id, content: the summary, a rule, the Markdown."""
    return contents.join(summaries, "doc_id").select("doc_id", F.concat("summary", F.lit("\n---\n\n"), "content").alias("content"))


def integration_summary(model: Column, source: Column, pages: Column) -> Column:
    """What stands above integrated Markdown; the time of writing is left to the sink."""
    listed = F.when(F.size(pages) > 0, F.array_join(F.transform(F.array_sort(pages), lambda p: p.cast("string")), ", ")).otherwise("none")
    # fixed values: labels and their order
    return F.concat_ws("\n", F.lit("## Integration Summary"), F.lit(""), F.concat(F.lit("- Primary page model: `"), model, F.lit("`")), F.concat(F.lit("- Page semantic source: `"), source, F.lit("`")), F.concat(F.lit("- Integrated pages: "), listed), F.lit("- Non-integrated pages remain from `content.md`."), F.lit(""))


def structure_records(documents: DataFrame, assets: DataFrame, warnings: DataFrame, attempts: DataFrame, mode: str = "research-archive") -> DataFrame:
    """doc_id and the structure record: source, source_type, expected_units, artifacts, assets, warnings, attempts.  Nothing for a single Markdown."""
    if "structure.json" not in artifacts(mode):
        return documents.sparkSession.createDataFrame([], "doc_id long, source string")
    ordered = lambda rows, name, order, *fields: rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*fields).alias("v")))), lambda s: s["v"]).alias(name))
    held = ordered(assets, "assets", "relative_path", "relative_path", "asset_path", asset_kind(F.col("relative_path")).alias("kind"))
    warned = ordered(warnings, "warned", "ord", "message")
    tried = ordered(attempts, "attempts", "attempt_no", "engine", "returncode")
    rows = documents.join(held, "doc_id", "left").join(warned, "doc_id", "left").join(tried, "doc_id", "left")
    units = expected_units(F.col("source"), F.col("counted"))
    made = F.struct(F.lit("content.md").alias("content_md"), F.lit("chunks.jsonl").alias("chunks_jsonl"), F.lit("audit.md").alias("audit_md"), F.when(F.size("assets") > 0, F.lit("assets")).alias("assets"))
    some = lambda name, kind: F.coalesce(name, F.array().cast(kind)).alias(name)
    return rows.select(
        "doc_id", "source", source_kind(F.col("source")).alias("source_type"), "engine", "mode", F.struct(units["unit"].alias("kind"), units["count"].alias("count")).alias("expected_units"), made.alias("artifacts"),
        some("assets", dict(held.dtypes)["assets"]), F.transform(F.coalesce("warned", F.array().cast(dict(warned.dtypes)["warned"])), lambda w: w["message"]).alias("warnings"), some("attempts", dict(tried.dtypes)["attempts"]),
    )


def with_visual_record(structures: DataFrame, rated: DataFrame, content: str, descriptions: str, audit: str) -> DataFrame:
    """Structure records that also tell of the visuals described: names of the files, total and a count for each status."""
    counts = rated.groupBy("doc_id", "status").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status_counts"))
    names = {"content_visual_md": content, "visual_descriptions_jsonl": descriptions, "visual_audit_md": audit}
    rows = structures.join(counts, "doc_id", "left")
    made = F.col("artifacts")
    for name, value in names.items():
        made = made.withField(name, F.lit(value))
    told = F.struct(F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("status_counts", F.create_map().cast("map<string,bigint>")).alias("status_counts"), *[F.lit(v).alias(k) for k, v in names.items()])
    return rows.withColumns({"artifacts": made, "visual_description": told}).drop("total", "status_counts")


def routed_report(routed: DataFrame, sensitivity: int) -> DataFrame:
    """doc_id, report: a line for each page, under the counts of each status."""
    novel = F.when(F.size("novel") > 0, F.array_join("novel", ",")).otherwise("none")
    line = F.format_string("- Page %d: route=%s; status=%s; score=%d; novel_numbers=%s", "page", "route", "status", "score", novel)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("page", line.alias("l")))), lambda s: s["l"])
    counts = routed.groupBy("doc_id", "status").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("status", F.lit("="), F.col("n").cast("string")))), ", ").alias("statuses"))
    pages = routed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(lines, "\n").alias("pages"))
    head = F.format_string(f"# Routed Markdown Audit\n\n- Sensitivity: {sensitivity}\n- Risk threshold: {100 - sensitivity}\n- Pages: %d\n- Statuses: %s\n\n## Pages\n\n", "n", "statuses")
    return pages.join(counts, "doc_id").select("doc_id", F.concat(head, "pages", F.lit("\n")).alias("report"))


def integration_report(overlaid: DataFrame) -> DataFrame:
    """doc_id, report: a line for each page with its flags, under the count of integrated ones."""
    flags = F.when(F.size("flags") > 0, F.array_join("flags", ", ")).otherwise("none")
    line = F.format_string("- Page %d: %s; risk_flags=%s", "page", "status", flags)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda s: s["l"])
    rows = overlaid.where("page IS NOT NULL").groupBy("doc_id").agg(F.count_if(F.col("status") == "integrated").alias("n"), F.array_join(lines, "\n").alias("pages"))
    return rows.select("doc_id", F.concat(F.format_string("# Integrated Markdown Audit\n\n- Integrated pages: %d\n\n## Pages\n\n", "n"), "pages", F.lit("\n")).alias("report"))


def baseline(contents: DataFrame, chunk_files: DataFrame) -> DataFrame:
    """doc_id, bytes and sha256 of the Markdown, lines of the chunk file (0 where there is none)."""
    data = F.col("content").cast("binary")
    own = contents.select("doc_id", F.octet_length(data).cast("long").alias("bytes"), F.sha2(data, 256).alias("sha256"))
    lines = chunk_files.select("doc_id", F.size(split_lines(F.col("content"))).cast("long").alias("chunk_lines"))
    return own.join(lines, "doc_id", "left").fillna(0, ["chunk_lines"])
