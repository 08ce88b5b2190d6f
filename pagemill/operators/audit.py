"""Counts, fingerprints and file lists that tell what a package holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(rows: DataFrame, column: str = "status") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def package_counts(docs: DataFrame, chunks: DataFrame, assets: DataFrame) -> DataFrame:
    """doc_id, page_headings, visual_placeholders, chunks, asset_files."""
    n = lambda p: F.regexp_count("content", F.lit(p)).cast("long")
    own = docs.select("doc_id", n(r"(?Umd)^## Page \d+\b").alias("page_headings"), n(r"(?Umd)^\*\*Visual element \d+:").alias("visual_placeholders"))
    per = lambda rows, name: rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    joined = own.join(per(chunks, "chunks"), "doc_id", "left").join(per(assets, "asset_files"), "doc_id", "left")
    return joined.fillna(0, ["chunks", "asset_files"])


def extensions(assets: DataFrame) -> DataFrame:
    """doc_id, extension, n."""
    suffix = F.lower(F.regexp_extract("relative_path", r"(\.[^./]+)$", 1))
    return assets.groupBy("doc_id", F.when(suffix != "", suffix).otherwise("<none>").alias("extension")).agg(F.count(F.lit(1)).alias("n"))


def fingerprints(files: DataFrame, content: str = "content") -> DataFrame:
    """path or doc_id columns, bytes and sha256 of each file's content (binary or string)."""
    data = F.col(content).cast("binary")
    return files.withColumns({"bytes": F.octet_length(data).cast("long"), "sha256": F.sha2(data, 256)}).drop(content)


def keep_list(entries: DataFrame, keep: str | None = None) -> DataFrame:
    """doc_id, name of the one Markdown that a minimised package keeps.  entries: doc_id, name.

    The only final or integrated Markdown, else ``content.md``; more than one is an error.
    """
    if keep is not None:
        return entries.where(F.col("name") == keep).select("doc_id", "name")
    final = F.col("name").endswith(".final.md") | (F.col("name") == "content.integrated.md")
    found = entries.groupBy("doc_id").agg(F.collect_set(F.when(final, F.col("name"))).alias("final"), F.max(F.col("name") == "content.md").alias("plain"))
    many = F.raise_error(F.concat(F.lit("several final Markdown files in "), F.col("doc_id").cast("string"))).cast("string")
    name = F.when(F.size("final") > 1, many).when(F.size("final") == 1, F.element_at("final", 1)).when(F.col("plain"), F.lit("content.md"))
    return found.select("doc_id", name.alias("name")).where("name IS NOT NULL")


def removals(entries: DataFrame, keep: str | None = None) -> DataFrame:
    """The entries that minimising removes: all but the Markdown that stays and its chunks."""
    kept = keep_list(entries, keep)
    kept = kept.unionByName(kept.select("doc_id", F.lit("chunks.jsonl").alias("name")))
    return entries.join(kept, ["doc_id", "name"], "left_anti")


def artifacts(mode: str) -> list[str]:
    """What a mode writes."""
    return ["content.md", "audit.md"] if mode == "single-md" else ["content.md", "chunks.jsonl", "structure.json", "assets", "audit.md"]


def warning_summary(warnings: DataFrame, shown: int = 8) -> DataFrame:
    """doc_id, n, lines: the first warnings of each document, and how many more there are."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "message"))), lambda w: F.concat(F.lit("  - "), w["message"]))
    rows = warnings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), listed.alias("l"))
    more = F.when(F.col("n") > shown, F.array(F.concat(F.lit("  - ... "), (F.col("n") - shown).cast("string"), F.lit(" more warnings omitted from summary")))).otherwise(F.array().cast("array<string>"))
    head = F.array(F.concat(F.lit("- Warnings: "), F.col("n").cast("string"), F.lit(" recorded; see `audit.md` for the full list")))
    return rows.select("doc_id", "n", F.array_join(F.concat(head, F.slice("l", 1, shown), more), "\n").alias("lines"))
