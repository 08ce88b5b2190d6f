"""Reading packages' files, and writing them."""

from __future__ import annotations

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.text import one_break
from ..schemas import SEMANTICS_JSON


def read_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, content: whole files, bad bytes replaced, line breaks as LF."""
    rows = spark.read.format("binaryFile").load(paths).select("path", F.decode(F.make_valid_utf8(F.col("content").cast("string")).cast("binary"), "UTF-8").alias("content"))
    return rows.withColumn("content", one_break(F.col("content")))


def read_jsonl(spark: SparkSession, paths: list[str], schema: str = SEMANTICS_JSON) -> DataFrame:
    """src_file_ord, line_no and the fields: files in the order given, blank lines skipped; a malformed line is an error."""
    parts = []
    for k, path in enumerate(paths):
        rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(one_break(F.col("value")), "\n")).alias("line_no", "line")).where("trim(line) <> ''")
        parsed = rows.select(F.lit(k).alias("src_file_ord"), F.col("line_no").cast("long").alias("line_no"), F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r"))
        parts.append(parsed.select("src_file_ord", "line_no", "r.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def captions_of(value: Column) -> Column:
    """A VARIANT that holds a string or a list of strings, as a list."""
    listed, one = F.try_variant_get(value, "$", "array<string>"), F.try_variant_get(value, "$", "string")
    return F.coalesce(listed, F.when(one.isNotNull(), F.array(one)))


def read_content_lists(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Blocks from content lists: doc_id, block_pos and the fields of a block.  files: doc_id, content (JSON text)."""
    items = files.select("doc_id", F.parse_json("content").alias("v"))
    elements = F.try_variant_get("v", "$", "array<variant>")
    rows = items.select("doc_id", F.posexplode(elements).alias("block_pos", "b")).where(F.schema_of_variant("b").startswith("OBJECT"))
    get = lambda name, kind: F.try_variant_get("b", f"$.{name}", kind).alias(name)
    plain = [get("page_idx", "int"), get("type", "string"), get("text", "string"), get("text_level", "int"), get("bbox", "array<double>"), get("table_body", "string"), get("img_path", "string"), get("content", "string")]
    listed = [captions_of(F.try_variant_get("b", f"$.{c}", "variant")).alias(c) for c in ("table_caption", "image_caption", "chart_caption", "image_footnote", "chart_footnote")]
    return rows.select("doc_id", F.col("block_pos").cast("long").alias("block_pos"), *plain, *listed)


def list_files(spark: SparkSession, root: str, suffixes: list[str]) -> DataFrame:
    """path, size, modified of files below ``root`` whose suffix is one of these; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return rows.where(suffix.isin([s.lower() for s in suffixes])).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def file_signature(files: DataFrame, backend: str, ocr: str, batch_pages: int) -> DataFrame:
    """path, signature: what must be the same for finished batches to count."""
    fields = F.struct("path", "size", F.unix_micros("modified").alias("modified_us"), F.lit(backend).alias("backend"), F.lit(ocr).alias("ocr"), F.lit(batch_pages).alias("batch_pages"))
    return files.select("path", F.to_json(fields).alias("signature"))


@F.pandas_udf(LongType())
def slide_count(content: pd.Series) -> pd.Series:
    """Slides of a presentation's bytes; null where it is no readable archive."""

    def count(data) -> int | None:
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as archive:
                return sum(bool(re.fullmatch(r"ppt/slides/slide\d+\.xml", n)) for n in archive.namelist())
        except (zipfile.BadZipFile, TypeError):
            return None

    return content.map(count).astype("Int64")


def write_jsonl(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line, nulls kept, a folder a document."""
    rows.write.mode(mode).option("ignoreNullFields", False).partitionBy("doc_id").json(path)


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One indented JSON document a row; Spark's commit takes the place of rename."""
    rows.select("doc_id", F.to_json(F.struct(*[c for c in rows.columns if c != "doc_id"]), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).write.mode(mode).partitionBy("doc_id").text(path)


def write_markdown(docs: DataFrame, path: str, content: str = "content", mode: str = "errorifexists") -> None:
    docs.select("doc_id", F.regexp_replace(content, r"\s+\z", "").alias("value")).write.mode(mode).partitionBy("doc_id").text(path)
