"""Exact deduplication by skew-safe combining.  DataFrame functions only.

Two texts are equal when they are identical after deleting space, tab, LF, VT, FF and CR.
Three combining stages, each of which groups by SHA-256 *and* by the whole normalised text, so that
equality is always decided by content:

1. local: the map-side half of the first aggregation leaves one row a text and task;
2. salted: those rows meet in ``salts`` buckets a digest, so that no group lands in one task;
3. global: the at most ``salts`` winners of a text are combined.

The winners then go back to the documents by digest.  That join carries no text, as stage 3 has shown
for every digest whether it stands for one text.  Where one stands for more (never seen with SHA-256,
easily made with a weaker ``digest``), the whole text joins as well.  Digests of many rows are
salted in that join, too.

Defined results: a null text counts as empty; empty texts form one group; doc_ids are any long, negative
ones included; a null doc_id ranks after all others and may only represent a group of null doc_ids; rows
that repeat both doc_id and text are members each (``group_size`` counts them) and share ``kept``; an empty
table gives an empty result; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_classes, materialize

#: [\x20\x09-\x0D]
WHITE = " \t\n\x0b\x0c\r"
SALTS = 64
_LAST_ID = (1 << 63) - 1
#: One more than the largest part of a rank that stands for a doc_id.
_UNIT = 1 << 65


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def _rank(text: Column, doc_id: Column) -> Column:
    """One number that orders by most code points, then by smallest doc_id, null last: fixed width, so hash aggregation holds it."""
    length = F.length(F.coalesce(text, F.lit(""))).cast("decimal(38,0)")
    back = F.coalesce(_whole(_LAST_ID + 1) - doc_id.cast("long").cast("decimal(38,0)"), _whole(0))
    return (length * _whole(_UNIT) + back).cast("decimal(38,0)")


def _ranked_id(rank: Column) -> Column:
    back = rank % _whole(_UNIT)
    return F.when(back > 0, _whole(_LAST_ID + 1) - back).cast("long")


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row a distinct text: digest, keep_id, group_size, n_contents (texts of this digest), content (null if one), keep_chars."""
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    rows = docs.select(doc_id.cast("long").alias("doc_id"), normalised(text).alias("content"), _rank(text, doc_id).alias("rank"))
    rows = rows.select(digest(F.col("content")).alias("digest"), "content", "rank", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "salt", "content").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    # by digest alone, so that the texts of one digest are counted where they are combined
    whole = salted.repartition("digest").groupBy("digest", "content").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))
    keep, length = _ranked_id(F.col("rank")), F.floor(F.col("rank") / _whole(_UNIT)).cast("long")
    n_contents = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    return whole.select("digest", "content", keep.alias("keep_id"), length.alias("keep_chars"), "group_size", n_contents.alias("n_contents")).select(
        "digest", F.when(F.col("n_contents") > 1, F.col("content")).alias("content"), "keep_id", "keep_chars", "group_size", "n_contents"
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = materialize(classes(docs, id_col, text_col, salts, digest), "exact-classes")
    by_digest = found.where("n_contents = 1").select("digest", "keep_id", "group_size")
    clash = found.where("n_contents > 1").select("digest", "content", "keep_id", "group_size")
    content = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), digest(content).alias("digest"), F.sha2(F.encode(content, "UTF-8"), 256).alias("text_sha256"), content.alias("content"))
    out = join_classes(rows.drop("content"), by_digest, "digest", "group_size", salts)
    if not clash.isEmpty():
        out = out.unionByName(rows.join(clash, ["digest", "content"]).drop("content"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with their own columns.

    Of rows that repeat the doc_id, the length and the normalised text that stay, one is kept.
    """
    found = materialize(classes(docs, id_col, text_col, salts), "exact-classes")
    clash = found.where("n_contents > 1").select("digest", "content")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # so that no column's name can clash
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    work = docs.select(own, sha256(normalised(text)).alias("digest"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.length(text).cast("long").alias("chars"), normalised(text).alias("content"))
    keys = ["digest", "doc_id", "chars"]
    stay = found.select(*[F.col(c).alias(f"k_{c}") for c in ("digest", "content", "keep_id", "keep_chars")])
    same = work["digest"].eqNullSafe(stay["k_digest"]) & work["doc_id"].eqNullSafe(stay["k_keep_id"]) & (work["chars"] == stay["k_keep_chars"])
    if clash.isEmpty():
        work = work.drop("content")
    else:
        keys.append("content")
        same &= stay["k_content"].isNull() | (work["content"] == stay["k_content"])
    kept = work.join(stay, same, "left_semi").dropDuplicates(keys)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
