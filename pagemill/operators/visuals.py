"""Image links and the placeholders that stand for them.

Links are exploded, joined with the assets by (doc_id, key) and put back by position, so a document's text
stays in one row and only links travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_model_text, compact_context, strip
from ..functions.udfs import link_key

LINK = r"!\[([^\]]*)\]\(([^)]+)\)"
# fixed values
TODO = "- Textual description: TODO review the asset or engine output and replace this note with a complete description.\n- Uncertainty: description not yet verified.\n"
PLACEHOLDER = r"\*\*Visual element (\d+): (.*?)\*\*\n\n- Asset: `([^`]+)`\n- Textual description: TODO review the asset or engine output and replace this note with a complete description\.\n- Uncertainty: description not yet verified\.\n?"


def asset_lookup(assets: DataFrame) -> DataFrame:
    """doc_id, key, asset: an asset's name if no other has it, else its path, else its last two parts; later assets before earlier."""
    path = F.replace("relative_path", F.lit("\\"), F.lit("/"))
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    rows = assets.where("relative_path <> '' AND asset_path <> ''").select(
        "doc_id", "relative_path", F.replace("asset_path", F.lit("\\"), F.lit("/")).alias("asset"), link_key(F.col("relative_path")).alias("full"),
        F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), "/")).alias("two"), F.element_at(F.split("relative_path", "/"), -1).alias("name"),
    )
    shared = rows.groupBy("doc_id", "name").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(shared, ["doc_id", "name"])
    # what is written later wins: names come last, and within a turn the later path, its last two parts after the whole
    step = lambda turn, k, key: F.struct(F.struct(F.lit(turn).alias("turn"), F.col("relative_path").alias("path"), F.lit(k).alias("k")).alias("o"), key.alias("key"))
    keys = F.array(step(0, 0, F.col("full")), step(0, 1, F.col("two")), step(1, 0, F.when(F.col("n") == 1, F.col("name"))))
    written = rows.select("doc_id", "asset", F.explode(keys).alias("w")).where("w.key IS NOT NULL AND w.key <> ''")
    return written.groupBy("doc_id", F.col("w.key").alias("key")).agg(F.max_by("asset", "w.o").alias("asset"))


def links(docs: DataFrame, assets: DataFrame, content: str = "content") -> DataFrame:
    """doc_id, n (from 1), alt, path, asset (the path where no asset is found)."""
    found = F.arrays_zip(F.regexp_extract_all(content, F.lit(LINK), F.lit(1)).alias("alt"), F.regexp_extract_all(content, F.lit(LINK), F.lit(2)).alias("path"))
    rows = docs.select("doc_id", F.posexplode(found).alias("k", "l")).select("doc_id", (F.col("k") + 1).alias("n"), strip(F.col("l.alt")).alias("alt"), strip(F.col("l.path")).alias("path"))
    keyed = rows.withColumn("key", link_key(F.col("path")))
    named = keyed.join(asset_lookup(assets), ["doc_id", "key"], "left")
    return named.select("doc_id", "n", F.when(F.col("alt") != "", F.col("alt")).otherwise("visual element").alias("alt"), "path", F.coalesce("asset", "path").alias("asset"))


def warnings(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.col("n").alias("ord"), F.concat(F.lit("Visual element "), F.col("n").cast("string"), F.lit(" requires textual verification: "), "asset").alias("message"))


def placeholder(number: Column, label: Column, asset: Column) -> Column:
    return F.concat(F.lit("**Visual element "), number.cast("string"), F.lit(": "), label, F.lit("**\n\n- Asset: `"), asset, F.lit("`\n" + TODO))


def _put_back(docs: DataFrame, pattern: str, instead: DataFrame, content: str) -> DataFrame:
    """Replaces the k-th match (from 1) by what ``instead`` (doc_id, n, text) has for it; nothing there leaves it as it is."""
    new = instead.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("n", "text"))).alias("new"))
    both = docs.join(new, "doc_id", "left")
    parts, old = F.split(content, pattern, -1), F.regexp_extract_all(content, F.lit(f"({pattern.replace('(?P<', '(?<')})"), F.lit(1))
    joined = F.array_join(F.transform(parts, lambda part, k: F.when(k == 0, part).otherwise(F.concat(F.coalesce(F.try_element_at("new", k), F.element_at(old, F.greatest(k, F.lit(1)))), part))), "")
    return both.withColumn(content, F.when(F.size(parts) > 1, joined).otherwise(F.col(content))).drop("new")


def rewrite_links(docs: DataFrame, assets: DataFrame, content: str = "content", policy: str = "todo") -> DataFrame:
    """Image links as numbered placeholders."""
    if policy == "off":
        return docs
    found = links(docs, assets, content)
    return _put_back(docs, LINK, found.select("doc_id", "n", F.concat(F.lit("\n\n"), placeholder(F.col("n"), F.col("alt"), F.col("asset")), F.lit("\n")).alias("text")), content)


def items(docs: DataFrame, content: str = "content") -> DataFrame:
    """doc_id, n, visual_id, label, asset, page, context_before, context_after of each placeholder.

    Its page is that of the last heading before it; its contexts end at its neighbours.
    """
    got = lambda g: F.regexp_extract_all(content, F.lit(PLACEHOLDER), F.lit(g))
    zipped = F.arrays_zip(got(1).alias("id"), got(2).alias("label"), got(3).alias("asset"))
    cut = docs.select("doc_id", F.split(content, PLACEHOLDER, -1).alias("parts"), zipped.alias("found"))
    rows = cut.where(F.size("found") > 0).select("doc_id", F.posexplode(F.transform("found", lambda f, k: F.struct(f.alias("f"), F.element_at("parts", k + 1).alias("before"), F.element_at("parts", k + 2).alias("after")))).alias("k", "r"))
    last = F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all("r.before", F.lit(r"(?Umd)^## Page (\d+)\b"), F.lit(1))), -1)
    so_far = Window.partitionBy("doc_id").orderBy("k")
    return rows.select(
        "doc_id", (F.col("k") + 1).alias("n"), F.col("r.f.id").cast("int").alias("visual_id"), strip(F.col("r.f.label")).alias("label"), strip(F.col("r.f.asset")).alias("asset"),
        F.last(last.cast("int"), ignorenulls=True).over(so_far).alias("page"),
        compact_context(F.right("r.before", F.lit(2000))).alias("context_before"), compact_context(F.left("r.after", F.lit(1200))).alias("context_after"),
    )


def first_items(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` items of each document, in its order."""
    return found.where(F.col("n") <= limit)


def statuses(found: DataFrame, files: DataFrame, least_bytes: int = 0, described: DataFrame | None = None) -> DataFrame:
    """Items with asset_exists, asset_bytes and status.  files: doc_id, asset_path, bytes.  described: doc_id, visual_id, description."""
    own = files.select("doc_id", F.col("asset_path").alias("asset"), "bytes")
    rows = found.join(own, ["doc_id", "asset"], "left")
    exists = F.col("bytes").isNotNull()
    rows = rows.withColumns({"asset_exists": exists, "asset_bytes": F.coalesce("bytes", F.lit(0))}).drop("bytes")
    answered = F.lit(False)
    if described is not None:
        rows = rows.join(described.select("doc_id", "visual_id", "description"), ["doc_id", "visual_id"], "left")
        answered = F.col("description").isNotNull()
    status = F.when(~F.col("asset_exists"), "missing_asset").when(F.col("asset_bytes") < least_bytes, "skipped_small_asset").when(answered, "described").otherwise("pending")
    return rows.withColumn("status", status)


def fill(docs: DataFrame, rated: DataFrame, least_bytes: int = 0, content: str = "content") -> DataFrame:
    """Placeholders of described and of too small assets replaced; others as they are."""
    head = F.concat(F.lit("**Visual element "), F.col("visual_id").cast("string"), F.lit(": "), "label", F.lit("**\n\n- Asset: `"), "asset", F.lit("`\n"))
    described = F.concat(head, F.lit("- Textual description:\n\n"), clean_model_text(F.col("description")), F.lit("\n\n- Uncertainty: see description above.\n"))
    small = F.concat(head, F.lit("- Textual description: skipped as likely decorative or low-information visual asset ("), F.col("asset_bytes").cast("string"), F.lit(f" bytes < min-size-bytes {least_bytes}).\n- Uncertainty: verify manually if this element is semantically important.\n"))
    text = F.when(F.col("status") == "described", described).when(F.col("status") == "skipped_small_asset", small)
    return _put_back(docs, PLACEHOLDER, rated.select("doc_id", "n", text.alias("text")).where("text IS NOT NULL"), content)


def as_of_page(headings: DataFrame, offsets: DataFrame) -> DataFrame:
    """doc_id, off, page of the last heading at or before each offset.  headings: doc_id, off, page.  offsets: doc_id, off."""
    both = headings.select("doc_id", "off", "page", F.lit(0).alias("side")).unionByName(offsets.select("doc_id", "off", F.lit(None).cast("int").alias("page"), F.lit(1).alias("side")))
    upto = Window.partitionBy("doc_id").orderBy("off", "side")
    return both.withColumn("page", F.last("page", ignorenulls=True).over(upto)).where("side = 1").drop("side")
