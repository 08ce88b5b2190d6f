"""Cutting Markdown into pages and chunks.  Everything happens within a document's row; nothing is shuffled but for last-wins dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, split_lines, strip

PAGE = r"(?Umd)(?=^## Page \d+\b)"
PAGE_CN = rf"(?Umd)(?=^## 第{WS}*\d+{WS}*页)"
PAGE_NUMBER = r"(?U)\A## Page (\d+)\b"
PAGE_NUMBER_CN = rf"(?U)\A## 第{WS}*(\d+){WS}*页"
CHUNK_CHARS = 2400
SHELF = 256


def _number(section: Column, pattern: str) -> Column:
    return F.when(section.rlike(pattern), F.regexp_extract(section, pattern, 1).cast("int"))


def sections(docs: DataFrame, content: str = "content") -> DataFrame:
    """doc_id, ord, page (null before the first heading), section with its heading: all of them, in order."""
    return docs.select("doc_id", F.posexplode(F.split(content, PAGE)).alias("ord", "section")).where("section <> ''").select("doc_id", "ord", _number(F.col("section"), PAGE_NUMBER).alias("page"), "section")


def page_bodies(docs: DataFrame, content: str = "content") -> DataFrame:
    """doc_id, page, body after the heading; the last of a page's sections counts."""
    found = sections(docs, content).where("page IS NOT NULL")
    body = strip(F.regexp_replace("section", r"(?U)\A## Page \d+", ""))
    return found.groupBy("doc_id", "page").agg(F.max_by(body, "ord").alias("body"))


def page_chunks(docs: DataFrame, content: str = "content") -> DataFrame:
    """doc_id, chunk_index, page, page_or_slide, text: one chunk a page; Chinese headings where there is no English one."""
    text = F.col(content)
    english, chinese = text.rlike(PAGE), text.rlike(PAGE_CN)
    parts = F.when(english, F.split(text, PAGE)).when(chinese, F.split(text, PAGE_CN)).otherwise(F.array(text))
    numbered = F.transform(parts, lambda s: F.struct(F.when(english, _number(s, PAGE_NUMBER)).when(chinese, _number(s, PAGE_NUMBER_CN)).alias("page"), strip(s).alias("text")))
    kept = F.filter(numbered, lambda s: (s["text"] != "") | ~(english | chinese))
    rows = docs.select("doc_id", F.posexplode(kept).alias("chunk_index", "s"))
    return rows.select("doc_id", "chunk_index", F.col("s.page").alias("page"), page_key(F.lit("page"), F.col("s.page")).alias("page_or_slide"), F.col("s.text").alias("text"))


def page_key(kind: Column, number: Column) -> Column:
    return F.when(number.isNotNull(), F.concat(F.lower(kind), F.lit(":"), number.cast("string")))


def greedy_chunks(docs: DataFrame, content: str = "content", most: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, chunk_index, page_or_slide, text: lines gathered up to ``most`` characters, anew at each page or slide."""
    heading = rf"(?Ui)\A##{WS}+(Page|Slide){WS}+(\d+)\b"

    def flushed(done: Column, unit: Column, held: Column) -> Column:
        text = strip(held)
        return F.when(text != "", F.concat(done, F.array(F.struct(unit.alias("unit"), text.alias("text"))))).otherwise(done)

    # finished chunks go to shelves of SHELF, so that adding one copies a shelf and not all that a long document has
    none = F.array().cast("array<struct<unit:string,text:string>>")

    def add(a: Column, line: Column) -> Column:
        starts = line.rlike(heading)
        unit = F.when(starts, F.concat(F.lower(F.regexp_extract(line, heading, 1)), F.lit(":"), F.regexp_extract(line, heading, 2))).otherwise(a["unit"])
        fresh = starts | (a["size"] + F.length(line) > most)
        shelved = F.size(a["done"]) >= SHELF
        return F.struct(
            F.when(fresh & shelved, F.concat(a["shelves"], F.array(a["done"]))).otherwise(a["shelves"]).alias("shelves"),
            F.when(fresh, flushed(F.when(shelved, none).otherwise(a["done"]), a["unit"], a["held"])).otherwise(a["done"]).alias("done"),
            unit.alias("unit"),
            F.when(fresh | (a["size"] == 0), line).otherwise(F.concat(a["held"], F.lit("\n"), line)).alias("held"),
            (F.when(fresh, 0).otherwise(a["size"]) + F.length(line) + 1).alias("size"),
        )

    nothing = F.struct(F.array().cast("array<array<struct<unit:string,text:string>>>").alias("shelves"), none.alias("done"), F.lit(None).cast("string").alias("unit"), F.lit("").alias("held"), F.lit(0).alias("size"))
    chunks = F.aggregate(split_lines(F.col(content)), nothing, add, lambda a: F.flatten(F.concat(a["shelves"], F.array(flushed(a["done"], a["unit"], a["held"])))))
    return docs.select("doc_id", F.posexplode(chunks).alias("chunk_index", "c")).select("doc_id", "chunk_index", F.col("c.unit").alias("page_or_slide"), F.col("c.text").alias("text"))
