"""The driver's tables as the relations this engine works on.

A document is a document; its lines are the blocks, ``PAGE_LINES`` to a page.  Types, boxes and captions follow
from doc_id and position, so that every rule of the decision tables is met somewhere.  Each adapter is a
projection of one row (no shuffle), and has the same definition in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table

PAGE_LINES = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos (from 0), line."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


LINES_SQL = """lines AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
)"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as a parser's blocks; see ``schemas.BLOCKS``."""
    rows = lines(spark, sf_dir).select("*", F.pmod("doc_id", F.lit(8)).alias("c"), F.pmod("pos", F.lit(PAGE_LINES)).alias("p"))
    c, p = F.col("c"), F.col("p")
    kind = (
        F.when((c == 1) & (p == 1), "table")
        .when((c == 2) & (p == 0), "chart")
        .when(c == 3, F.when(p <= 1, "image").otherwise("footer"))
        .when((c == 4) & (p == 0), "image")
        .when((c == 5) & (p < 3), "image")
        .when((c == 6) & (p == 0), "chart").when((c == 6) & (p == 1), "table")
        .when((c == 7) & (p == 0), "header").when((c == 7) & (p == 1), "aside_text").when((c == 7) & (p == 2), "page_number")
        .otherwise("text")
    )
    rows = rows.withColumn("type", kind)
    visual = F.col("type").isin("chart", "image")
    # width of a box of height 500: the areas come to .09, .16, .01, .12, .25 of a page
    width = F.when(c == 2, 180).when(c == 3, 320).when(c == 4, 20).when(c == 5, 240).otherwise(500)
    own = F.col("line")
    listed = lambda when: F.when(when & (F.pmod(F.col("doc_id") + F.col("pos"), F.lit(3)) == 0), F.array(F.concat(F.lit("Fig "), F.col("pos").cast("string"))))
    none = F.lit(None).cast("array<string>")
    return rows.select(
        "doc_id", F.col("pos").cast("long").alias("block_pos"), F.floor(F.col("pos") / PAGE_LINES).cast("int").alias("page_idx"), "type",
        F.when(~visual & (F.col("type") != "table"), own).alias("text"), F.when((F.col("type") == "text") & (p == 0), F.pmod("doc_id", F.lit(9)).cast("int")).alias("text_level"),
        F.when(visual, F.array(F.lit(0.0), F.lit(0.0), width.cast("double"), F.lit(500.0))).alias("bbox"),
        F.when(F.col("type") == "table", own).alias("table_body"), F.when(visual, F.concat(F.lit("images/"), F.col("doc_id").cast("string"), F.lit("-"), F.col("pos").cast("string"), F.lit(".png"))).alias("img_path"),
        F.when(F.col("type") == "chart", own).alias("content"),
        listed(F.col("type") == "table").alias("table_caption"), listed(F.col("type") == "image").alias("image_caption"), listed(F.col("type") == "chart").alias("chart_caption"), none.alias("image_footnote"), none.alias("chart_footnote"),
    )


BLOCKS_SQL = (
    LINES_SQL
    + f""",
shaped AS (SELECT doc_id, pos, line, doc_id % 8 AS c, pos % {PAGE_LINES} AS p FROM lines),
typed AS (SELECT *, CASE WHEN c = 1 AND p = 1 THEN 'table' WHEN c = 2 AND p = 0 THEN 'chart' WHEN c = 3 AND p <= 1 THEN 'image' WHEN c = 3 THEN 'footer'
  WHEN c = 4 AND p = 0 THEN 'image' WHEN c = 5 AND p < 3 THEN 'image' WHEN c = 6 AND p = 0 THEN 'chart' WHEN c = 6 AND p = 1 THEN 'table'
  WHEN c = 7 AND p = 0 THEN 'header' WHEN c = 7 AND p = 1 THEN 'aside_text' WHEN c = 7 AND p = 2 THEN 'page_number' ELSE 'text' END AS type FROM shaped),
blocks AS (SELECT doc_id, pos AS block_pos, pos // {PAGE_LINES} AS page_idx, type,
  CASE WHEN type NOT IN ('chart', 'image', 'table') THEN line END AS text,
  CASE WHEN type = 'text' AND p = 0 THEN doc_id % 9 END AS text_level,
  CASE WHEN type IN ('chart', 'image') THEN (CASE c WHEN 2 THEN 180 WHEN 3 THEN 320 WHEN 4 THEN 20 WHEN 5 THEN 240 ELSE 500 END) * 500 / 1000000.0::DOUBLE ELSE 0 END AS area,
  CASE WHEN type = 'table' THEN line END AS table_body,
  CASE WHEN type IN ('chart', 'image') THEN 'images/' || doc_id || '-' || pos || '.png' END AS img_path,
  CASE WHEN type = 'chart' THEN line END AS content,
  CASE WHEN (doc_id + pos) % 3 = 0 AND type IN ('table', 'image', 'chart') THEN 'Fig ' || pos END AS caption FROM typed)"""
)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's own text: its lines, twice for every fifth document."""
    pages = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    paged = pages.select("doc_id", "l", F.posexplode(F.sequence(F.lit(0), F.size("l") - 1, F.lit(PAGE_LINES))).alias("k", "at"))
    text = F.array_join(F.slice("l", F.col("at") + 1, F.lit(PAGE_LINES)), "\n")
    return paged.select("doc_id", (F.col("k") + 1).cast("int").alias("page"), F.when(F.pmod("doc_id", F.lit(5)) == 4, F.concat(text, F.lit("\n"), text)).otherwise(text).alias("pdf_text"))


PAGE_TEXT_SQL = f"""page_text AS (
  SELECT doc_id, pos // {PAGE_LINES} + 1 AS page, string_agg(line, chr(10) ORDER BY pos) || CASE WHEN doc_id % 5 = 4 THEN chr(10) || string_agg(line, chr(10) ORDER BY pos) ELSE '' END AS pdf_text
  FROM lines GROUP BY doc_id, pos // {PAGE_LINES}
)"""


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, content: a title and ``## Page n`` sections."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    pages = F.sequence(F.lit(0), F.size("l") - 1, F.lit(PAGE_LINES))
    body = F.transform(pages, lambda at, k: F.concat(F.lit("## Page "), (k + 1).cast("string"), F.lit("\n\n"), F.array_join(F.slice(F.col("l"), at + 1, F.lit(PAGE_LINES)), "\n"), F.lit("\n")))
    return docs.select("doc_id", F.concat(F.lit("# Document "), F.col("doc_id").cast("string"), F.lit("\n\n"), F.array_join(body, "\n")).alias("content"))


MARKDOWN_SQL = f"""sections AS (
  SELECT doc_id, pos // {PAGE_LINES} + 1 AS page, '## Page ' || (pos // {PAGE_LINES} + 1) || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY pos) || chr(10) AS section FROM lines GROUP BY doc_id, pos // {PAGE_LINES}
), markdown AS (SELECT doc_id, '# Document ' || doc_id || chr(10) || chr(10) || string_agg(section, chr(10) ORDER BY page) AS content FROM sections GROUP BY doc_id)"""


def semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as answers about pages 1 to 4 of a document, in two files; one in five is an error, one in seven empty."""
    rows = table(spark, sf_dir, "conversations")
    turn = F.col("turn")
    return rows.select(
        F.col("conv_id").alias("doc_id"), F.pmod(turn, F.lit(2)).cast("int").alias("src_file_ord"), turn.alias("line_no"), F.concat(F.lit("model-"), F.pmod(turn, F.lit(3)).cast("string")).alias("model"),
        (F.pmod(turn, F.lit(4)) + 1).cast("int").alias("page"), F.when(F.pmod(F.col("conv_id") + turn, F.lit(5)) == 0, "error").otherwise("described").alias("status"),
        F.when(F.pmod(F.col("conv_id") + turn, F.lit(7)) != 0, F.col("text")).otherwise(F.lit("")).alias("description"),
        F.when(F.pmod(F.col("conv_id") + turn, F.lit(5)) == 0, F.when(F.pmod(turn, F.lit(2)) == 0, "HTTP 401 Unauthorized").otherwise("timeout")).alias("error"),
    )


SEMANTICS_SQL = """semantics AS (
  SELECT conv_id AS doc_id, turn % 2 AS src_file_ord, turn AS line_no, 'model-' || (turn % 3) AS model, turn % 4 + 1 AS page, CASE WHEN (conv_id + turn) % 5 = 0 THEN 'error' ELSE 'described' END AS status,
    CASE WHEN (conv_id + turn) % 7 <> 0 THEN text ELSE '' END AS description, CASE WHEN (conv_id + turn) % 5 = 0 THEN CASE WHEN turn % 2 = 0 THEN 'HTTP 401 Unauthorized' ELSE 'timeout' END END AS error
  FROM conversations)"""


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as number-rich answers with their evidence: key, generated, evidence."""
    l = table(spark, sf_dir, "lineitem")
    s = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    return l.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        F.concat(F.lit("sold "), F.col("l_quantity").cast("int").cast("string"), F.lit(" at 1,"), s("l_extendedprice"), F.lit(" less "), s("l_discount"), F.lit("% x"), F.col("l_partkey").cast("string")).alias("generated"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(", quantity "), F.col("l_quantity").cast("int").cast("string"), F.lit("; tax "), s("l_tax")).alias("evidence"),
    )


NUMBERS_SQL = """numbers AS (
  SELECT l_orderkey || '-' || l_linenumber AS key,
    'sold ' || l_quantity::INT || ' at 1,' || l_extendedprice::DECIMAL(18,2) || ' less ' || l_discount::DECIMAL(18,2) || '% x' || l_partkey AS generated,
    'part ' || l_partkey || ', quantity ' || l_quantity::INT || '; tax ' || l_tax::DECIMAL(18,2) AS evidence FROM lineitem)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as batch records: a user's runs of 20-page batches, in time order."""
    e = table(spark, sf_dir, "events")
    start = F.pmod("event_id", F.lit(5)) * 20
    return e.select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), start.cast("int").alias("start_page"), (start + 19).cast("int").alias("end_page"),
        F.when(F.pmod("event_id", F.lit(3)) == 0, "error").otherwise("completed").alias("status"), F.concat(F.lit("batch_"), F.col("event_id").cast("string"), F.lit("_content_list.json")).alias("content_list"),
    )


LEDGER_SQL = """ledger AS (
  SELECT user_id AS doc_id, event_id AS seq, event_id % 5 * 20 AS start_page, event_id % 5 * 20 + 19 AS end_page, CASE WHEN event_id % 3 = 0 THEN 'error' ELSE 'completed' END AS status, 'batch_' || event_id || '_content_list.json' AS content_list FROM events)"""


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a document, with names that clash: doc_id, relative_path, asset_path, kind, bytes."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0), F.pmod("doc_id", F.lit(6)).cast("int"))).alias("k"))
    path = F.concat(F.when(F.col("k") % 2 == 0, "images/").otherwise("auto/images/"), F.when(F.col("k") < 3, F.lit("fig")).otherwise(F.concat(F.lit("p"), F.col("k").cast("string"))), F.when(F.col("k") == 4, ".html").otherwise(".png"))
    rows = rows.select("doc_id", path.alias("relative_path"), F.pmod(F.col("n_chars") * (F.col("k") + 1), F.lit(5000)).alias("bytes"), "k").where("k <> 2")
    from ..functions.text import asset_kind

    return rows.select("doc_id", "relative_path", F.concat(F.lit("assets/"), "relative_path").alias("asset_path"), asset_kind(F.col("relative_path")).alias("kind"), F.col("bytes").cast("long").alias("bytes"))


ASSETS_SQL = """assets AS (SELECT doc_id, relative_path, 'assets/' || relative_path AS asset_path, CASE WHEN relative_path LIKE '%.html' THEN 'table' ELSE 'image' END AS kind, bytes FROM (
  SELECT doc_id, k, CASE WHEN k % 2 = 0 THEN 'images/' ELSE 'auto/images/' END || CASE WHEN k < 3 THEN 'fig' ELSE 'p' || k END || CASE WHEN k = 4 THEN '.html' ELSE '.png' END AS relative_path, n_chars * (k + 1) % 5000 AS bytes
  FROM (SELECT doc_id, n_chars, unnest(range(doc_id % 6 + 1)) AS k FROM documents)) WHERE k <> 2)"""


def with_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, content: paged Markdown with image links, some quoted, relative or unknown."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    i = F.col("doc_id").cast("string")

    def line(x, k):
        link = F.when(k % 3 == 0, "![ ](./images/fig.png)").when(k % 3 == 1, "![chart](auto/images/p3.png#x)").otherwise("![lost](gone.png)")
        return F.when(k % 4 == 0, F.concat(F.lit("## Page "), (k / 4 + 1).cast("int").cast("string"), F.lit("\n\n"), x)).when(k % 4 == 2, F.concat(x, F.lit("\n"), link)).otherwise(x)

    return docs.select("doc_id", F.concat(F.lit("# Document "), i, F.lit("\n\n"), F.array_join(F.transform("l", line), "\n")).alias("content"))


WITH_VISUALS_SQL = (
    LINES_SQL
    + """, lined AS (SELECT doc_id, pos, CASE WHEN pos % 4 = 0 THEN '## Page ' || (pos // 4 + 1) || chr(10) || chr(10) || line
    WHEN pos % 4 = 2 THEN line || chr(10) || CASE pos % 3 WHEN 0 THEN '![ ](./images/fig.png)' WHEN 1 THEN '![chart](auto/images/p3.png#x)' ELSE '![lost](gone.png)' END ELSE line END AS line FROM lines),
visual_md AS (SELECT doc_id, '# Document ' || doc_id || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY pos) AS content FROM lined GROUP BY doc_id)"""
)
