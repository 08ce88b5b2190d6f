"""Registered queries over files, and over what a run may do and say; with their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import text as T
from ..operators import audit, blocks, package, runs, semantics, visuals
from ..sources import files
from ..sources.tables import scratch
from . import adapters as A
from .queries import ITEMS_SQL, placeholders
from .registry import query

# --- files: the benchmark's items as Markdown, and read again


def _written(spark, sf_dir):
    items = A.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("content"))
    path = scratch(spark, "markdown")
    files.write_markdown(items, path)
    return path


def _doc_id(path):
    return F.regexp_extract(path, r"doc_id=(\d+)", 1).cast("long")


@query("SELECT item_id AS doc_id, rtrim(text, ' ' || chr(9) || chr(10) || chr(13)) || chr(10) AS content FROM benchmark")
def markdown_files(spark, sf_dir):
    path = _written(spark, sf_dir)
    return files.read_texts(spark, f"{path}/doc_id=*/*.txt").select(_doc_id(F.col("path")).alias("doc_id"), "content")


@query("SELECT item_id AS doc_id, octet_length(encode(rtrim(text, ' ' || chr(9) || chr(10) || chr(13)))) + 1 AS size FROM benchmark")
def files_found(spark, sf_dir):
    path = _written(spark, sf_dir)
    return files.list_files(spark, path, [".TXT"]).select(_doc_id(F.col("path")).alias("doc_id"), "size")


@query("SELECT item_id AS doc_id, octet_length(encode(rtrim(text, ' ' || chr(9) || chr(10) || chr(13)))) + 1 AS size, 'pipeline' AS backend, 'auto' AS ocr, 20::BIGINT AS batch_pages, TRUE AS told FROM benchmark")
def file_signatures(spark, sf_dir):
    found = files.list_files(spark, _written(spark, sf_dir), [".txt"])
    rows = files.file_signature(found, "pipeline", "auto", 20).select(_doc_id(F.col("path")).alias("doc_id"), F.from_json("signature", "size long, modified_us long, backend string, ocr string, batch_pages long").alias("s"))
    return rows.select("doc_id", "s.size", "s.backend", "s.ocr", "s.batch_pages", (F.col("s.modified_us") > 0).alias("told"))


@query(f"WITH {A.SEMANTICS_SQL} SELECT doc_id, src_file_ord::INT AS src_file_ord, model, page::INT AS page, status, description, error FROM semantics")
def jsonl_rows(spark, sf_dir):
    """Answers as two files of JSON lines, read in the order in which the files are given."""
    rows = A.semantics(spark, sf_dir)
    paths = []
    for k in (0, 1):
        paths.append(scratch(spark, "answers"))
        own = rows.where(F.col("src_file_ord") == k).select(F.to_json(F.struct("doc_id", "model", "page", "status", "description", "error")).alias("value"))
        own.repartition(1).write.text(paths[-1])  # one file, as a model run writes it
    return files.read_jsonl(spark, paths, "doc_id long, model string, page int, status string, description string, error string").drop("line_no")


@query(f"WITH {A.BLOCKS_SQL} SELECT doc_id, block_pos, page_idx::INT AS page_idx, type, text, text_level::INT AS text_level, table_body, img_path, content, caption FROM blocks")
def content_lists(spark, sf_dir):
    """Each document's blocks as one JSON list, and read from it."""
    rows = A.blocks(spark, sf_dir)
    listed = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("block_pos", F.struct(*[c for c in rows.columns if c not in ("doc_id", "block_pos")]).alias("b")))).alias("l"))
    lists = listed.select("doc_id", F.to_json(F.transform("l", lambda s: s["b"])).alias("content"))
    read = files.read_content_lists(spark, lists)
    caption = F.coalesce(*[F.array_join(c, ",") for c in ("table_caption", "image_caption", "chart_caption")])
    return read.select("doc_id", "block_pos", "page_idx", "type", "text", "text_level", "table_body", "img_path", "content", F.when(caption != "", caption).alias("caption"))


@query(f"WITH {A.ASSETS_SQL} SELECT doc_id, relative_path, kind, bytes::BIGINT AS bytes FROM assets")
def json_documents(spark, sf_dir):
    """Each document's assets as an indented JSON document in a file, and read again."""
    held = A.assets(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("relative_path", "kind", "bytes"))).alias("assets"))
    bucketed = held.groupBy(F.pmod("doc_id", F.lit(16)).alias("doc_id")).agg(F.collect_list(F.struct("doc_id", "assets")).alias("documents"))
    path = scratch(spark, "json")
    files.write_json(bucketed, path)
    read = files.read_texts(spark, f"{path}/doc_id=*/*.txt").select(F.explode(F.from_json("content", "documents array<struct<doc_id:long,assets:array<struct<relative_path:string,kind:string,bytes:long>>>>")["documents"]).alias("d"))
    return read.select("d.doc_id", F.explode("d.assets").alias("a")).select("doc_id", "a.relative_path", "a.kind", "a.bytes")


@F.pandas_udf(BinaryType())
def _deck(slides: pd.Series) -> pd.Series:
    """A presentation with so many slides, and other members."""
    import io
    import zipfile

    def made(n):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for k in range(n):
                z.writestr(f"ppt/slides/slide{k + 1}.xml", "")
                z.writestr(f"ppt/slides/_rels/slide{k + 1}.xml.rels", "")
        return held.getvalue()

    return slides.map(made)


@query("SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey % 7 END::BIGINT AS slides FROM part")
def slide_counts(spark, sf_dir):
    deck = F.when(F.pmod("p_partkey", F.lit(11)) != 0, _deck(F.pmod("p_partkey", F.lit(7)).cast("int"))).otherwise(F.lit(b"no archive"))
    return A.table(spark, sf_dir, "part").select("p_partkey", files.slide_count(deck).alias("slides"))


# --- packages


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN source ELSE '' END AS source FROM documents")
def package_sources(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents")
    records = docs.where("doc_id % 3 <> 0").select("doc_id", F.when(F.pmod("doc_id", F.lit(3)) == 1, F.col("source")).alias("source"))
    return package.source_of(docs.select("doc_id"), records)


def _summarised(spark, sf_dir):
    """Markdown below a title and a list of warnings, and without a title."""
    head = F.concat(F.lit("# Document\n\n- Warnings: 2 recorded; see `audit.md` for the full list\n  - first\n  - second\n\n- Other: "), F.col("doc_id").cast("string"), F.lit("\n"))
    return A.table(spark, sf_dir, "documents").select("doc_id", F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(head, "text")).otherwise(F.col("text")).alias("content"))


SUMMARISED_SQL = """summarised AS (SELECT doc_id, rtrim(text, ' ' || chr(10)) AS body, doc_id % 2 = 0 AS titled FROM documents)"""


@query(
    f"""WITH {SUMMARISED_SQL} SELECT doc_id, CASE WHEN titled THEN '# Document' || chr(10) || chr(10) || '- Original visual verification warnings were superseded by page-level semantic integration; see `a.md` and `page_semantics*.md`.' || chr(10) || chr(10) || '- Other: ' || doc_id || chr(10) ELSE '' END || body || chr(10) AS content FROM summarised"""
)
def stale_warnings(spark, sf_dir):
    return _summarised(spark, sf_dir).select("doc_id", T.drop_stale_warnings(F.col("content"), "a.md").alias("content"))


@query(
    f"""WITH {SUMMARISED_SQL} SELECT doc_id, CASE WHEN titled THEN '# Document' || chr(10) || chr(10) || '## Summary' || chr(10) || chr(10) || '- Warnings: 2 recorded; see `audit.md` for the full list' || chr(10) || '  - first' || chr(10) || '  - second' || chr(10) || chr(10) || '- Other: ' || doc_id || chr(10) || body || chr(10)
  ELSE '## Summary' || chr(10) || text END AS content FROM summarised JOIN documents USING (doc_id)"""
)
def inserted_summaries(spark, sf_dir):
    return _summarised(spark, sf_dir).select("doc_id", T.insert_summary(F.col("content"), F.lit("## Summary")).alias("content"))


@query(
    f"""WITH {A.LINES_SQL}, {A.PAGE_TEXT_SQL} SELECT doc_id, page::INT AS page, '## Page ' || page || chr(10) || chr(10) || CASE WHEN doc_id % 3 = 0 OR trim(pdf_text, ' ' || chr(10)) = '' THEN '[No extractable text]' ELSE trim(pdf_text, ' ' || chr(10)) END
  || CASE WHEN page % 2 = 0 THEN chr(10) || chr(10) || '![Page ' || page || ' snapshot](p' || page || '.png)' ELSE '' END || chr(10) AS shown FROM page_text"""
)
def fallback_pages(spark, sf_dir):
    text = F.when(F.pmod("doc_id", F.lit(3)) != 0, F.col("pdf_text"))
    snapshot = F.when(F.col("page") % 2 == 0, F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(".png")))
    return A.page_text(spark, sf_dir).select("doc_id", "page", blocks.fallback_page(text, F.col("page"), snapshot).alias("shown"))


@query(f"WITH {A.ASSETS_SQL} SELECT doc_id, relative_path AS source, 'engine_output/' || relative_path AS target FROM assets")
def raw_outputs(spark, sf_dir):
    return runs.raw_output(A.assets(spark, sf_dir))


MODES = ["single-md", "rag-lite", "research-archive"]


@query(f"""WITH m AS (SELECT doc_id, ['single-md', 'rag-lite', 'research-archive'][doc_id % 3 + 1] AS mode FROM documents)
SELECT doc_id, mode, CASE WHEN mode = 'single-md' THEN 'content.md,audit.md' ELSE 'content.md,chunks.jsonl,structure.json,assets,audit.md' END AS artifacts FROM m""")
def artifacts_by_mode(spark, sf_dir):
    mode = F.element_at(F.array(*map(F.lit, MODES)), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    held = F.create_map(*[F.lit(x) for m in MODES for x in (m, ",".join(audit.artifacts(m)))])
    return A.table(spark, sf_dir, "documents").select("doc_id", mode.alias("mode"), F.element_at(held, mode).alias("artifacts"))


# --- what a run may do: orders stand for runs


def _k(n):
    return F.pmod("o_orderkey", F.lit(n))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'auto' WHEN 1 THEN 'pipeline' ELSE NULL END IS NOT NULL AS accepted, CASE WHEN o_orderkey % 4 < 2 THEN 'pipeline' END AS backend FROM orders")
def parser_backends(spark, sf_dir):
    """Of four that are asked for, two are accepted."""
    asked = F.element_at(F.array(*map(F.lit, ["auto", "pipeline", "hybrid-engine", "vlm-http-client"])), (_k(4) + 1).cast("int"))
    accepted = asked.isin(*runs.BACKENDS)
    return A.table(spark, sf_dir, "orders").select("o_orderkey", accepted.alias("accepted"), F.when(accepted, runs.backend(asked)).alias("backend"))


@query("""SELECT o_orderkey, array_to_string(list_concat([CASE WHEN o_orderkey % 5 = 0 THEN '/opt/Magic-PDF' ELSE 'bin/mineru' END, '-p', 'in/' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '.docx' ELSE '.PDF' END, '-o', 'raw'],
  CASE WHEN o_orderkey % 5 = 0 THEN ['-m', 'auto'] ELSE [] END, ['-b', 'pipeline'], CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 THEN ['-m', ['auto', 'ocr', 'txt'][o_orderkey % 3 + 1]] ELSE [] END,
  CASE WHEN o_orderkey % 2 = 0 THEN ['-s', (o_orderkey % 7 * 20)::VARCHAR, '-e', (o_orderkey % 7 * 20 + 19)::VARCHAR] ELSE [] END), ' ') AS command FROM orders""")
def parser_commands(spark, sf_dir):
    program = F.when(_k(5) == 0, "/opt/Magic-PDF").otherwise("bin/mineru")
    source = F.concat(F.lit("in/"), F.col("o_orderkey").cast("string"), F.when(_k(3) == 0, ".docx").otherwise(".PDF"))
    ocr = F.element_at(F.array(*map(F.lit, ["auto", "on", "off"])), (_k(3) + 1).cast("int"))
    first = F.when(_k(2) == 0, _k(7) * 20)
    command = runs.parser_command(program, source, F.lit("raw"), runs.backend(F.lit("auto")), ocr, first, first + 19)
    return A.table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(command, " ").alias("command"))


@query("""WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN '1-3' ELSE '' END AS pages, CASE WHEN o_orderkey % 3 = 0 THEN 'selection.json' END AS selection, CASE WHEN o_orderkey % 5 < 2 THEN 'openai' ELSE 'dry-run' END AS provider,
  o_orderkey % 7 <> 0 AS allowed, o_orderkey % 11 <> 0 AS has_key, CASE WHEN o_orderkey % 13 = 0 THEN ' , ' ELSE 'a,b' END AS models, o_orderkey % 17 * 10 - 10 AS sensitivity, o_orderkey % 2 = 0 AS resume, o_orderkey % 4 = 0 AS overwrite, o_orderkey % 3 * 10 AS batch FROM orders)
SELECT k AS o_orderkey, CASE WHEN sensitivity NOT BETWEEN 0 AND 100 THEN 'sensitivity must lie between 0 and 100' WHEN provider = 'openai' AND NOT allowed THEN 'external calls are not allowed' WHEN provider = 'openai' AND NOT has_key THEN 'the key is not set'
  WHEN (pages <> '') = (selection IS NOT NULL) THEN 'give either pages or a selection' WHEN models = ' , ' THEN 'no models' END AS page_run,
  CASE WHEN resume AND overwrite THEN 'resume and overwrite exclude each other' WHEN resume AND batch <= 0 THEN 'resume needs batches' END AS conversion FROM r""")
def run_complaints(spark, sf_dir):
    page_run = runs.page_run_complaint(F.when(_k(2) == 0, "1-3").otherwise(""), F.when(_k(3) == 0, F.lit("selection.json")), F.when(_k(5) < 2, "openai").otherwise("dry-run"), _k(7) != 0, _k(11) != 0, F.when(_k(13) == 0, " , ").otherwise("a,b"), _k(17) * 10 - 10)
    return A.table(spark, sf_dir, "orders").select("o_orderkey", page_run.alias("page_run"), runs.conversion_complaint(_k(2) == 0, _k(4) == 0, _k(3) * 10).alias("conversion"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderkey % 7 = 0 THEN 4 WHEN o_orderkey % 2 = 0 AND o_orderkey % 11 > 0 THEN 5 ELSE 0 END AS code,
  'package' || CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') ELSE '' END AS folder FROM orders""")
def run_results(spark, sf_dir):
    """Exit codes and output folders."""
    code = runs.exit_code(F.when(_k(3) == 0, F.lit("bad")), _k(5) != 0, _k(7) != 0, _k(2) == 0, _k(11))
    folder = runs.output_name(F.lit("package"), _k(2) == 0, _k(3) == 0, _k(5) == 0, F.date_format("o_orderdate", "yyyyMMdd_HHmmss"))
    return A.table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"), folder.alias("folder"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '127.0.0.1,localhost,::1' WHEN 1 THEN 'example.org,localhost,127.0.0.1,::1' ELSE '::1,127.0.0.1,localhost' END AS no_proxy,
  o_orderkey % 4 IN (0, 2) AS may_remove FROM orders""")
def run_environments(spark, sf_dir):
    """Hosts without proxy, and what may be removed below a package."""
    given = F.when(_k(3) == 1, F.lit(" example.org , localhost,")).when(_k(3) == 2, F.lit("::1"))
    path = F.element_at(F.array(*map(F.lit, ["/work/package/raw/", "/work/package/../other", "/work/./package//a/../b", "/work/package"])), (_k(4) + 1).cast("int"))
    return A.table(spark, sf_dir, "orders").select("o_orderkey", runs.no_proxy(given).alias("no_proxy"), runs.may_remove(path, F.lit("/work/package")).alias("may_remove"))


@query("""WITH c AS (SELECT s_nationkey AS environment, s_suppkey, s_suppkey % 5 <> 0 AS ok FROM supplier) SELECT environment, bool_and(ok) AS ready, coalesce(string_agg('tool-' || s_suppkey, ',' ORDER BY 'tool-' || s_suppkey) FILTER (NOT ok), '') AS missing FROM c GROUP BY environment""")
def environments_ready(spark, sf_dir):
    rows = A.table(spark, sf_dir, "supplier")
    k = F.pmod("s_suppkey", F.lit(5))
    checks = rows.select(F.col("s_nationkey").alias("environment"), F.concat(F.lit("tool-"), F.col("s_suppkey").cast("string")).alias("name"), F.lit("1.0").alias("expected"), F.when(k != 0, "1.0").when(F.pmod("s_suppkey", F.lit(2)) == 0, "0.9").alias("installed"))
    return runs.readiness(checks).select("environment", "ready", F.array_join("missing", ",").alias("missing"))


@query("""WITH p AS (SELECT p_partkey, ['src/a.py', 'deck.PPTX', '.git/x.pdf', 'lib/__pycache__', 'keys/id.pem', '.pdf', 'venv', 'x.pdf.md', 'rows.jsonl'][p_partkey % 9 + 1] AS path FROM part)
SELECT p_partkey, path, path IN ('deck.PPTX', 'lib/__pycache__', 'keys/id.pem', 'venv', 'rows.jsonl') AS forbidden FROM p""")
def forbidden_paths(spark, sf_dir):
    path = F.element_at(F.array(*map(F.lit, ["src/a.py", "deck.PPTX", ".git/x.pdf", "lib/__pycache__", "keys/id.pem", ".pdf", "venv", "x.pdf.md", "rows.jsonl"])), (F.pmod("p_partkey", F.lit(9)) + 1).cast("int"))
    return A.table(spark, sf_dir, "part").select("p_partkey", path.alias("path"), T.is_forbidden_path(path).alias("forbidden"))


# --- what models are asked, and what their answers say


@query("""WITH c AS (SELECT conv_id, turn, trim(text, ' ' || chr(10)) AS t, (conv_id + turn) % 6 AS k, ['auto', 'responses', 'chat'][turn % 3 + 1] AS mode FROM conversations),
a AS (SELECT *, CASE k WHEN 0 THEN t WHEN 1 THEN t || chr(10) || 'more' END AS r, CASE k WHEN 0 THEN 'chat ' || t WHEN 2 THEN t WHEN 3 THEN t || chr(10) || 'more' END AS c FROM c),
b AS (SELECT *, CASE WHEN mode <> 'chat' AND r <> '' THEN r END AS one, CASE WHEN mode <> 'responses' AND c <> '' THEN c END AS two FROM a)
SELECT conv_id, turn, coalesce(one, two) AS text, CASE WHEN one IS NOT NULL THEN 'responses' WHEN two IS NOT NULL THEN 'chat' END AS api_mode, CASE WHEN one IS NULL AND two IS NULL THEN mode || ': no text' END AS error FROM b""")
def model_answers(spark, sf_dir):
    """Turns as responses and chat completions in all their forms: a string, a list of parts, parts without text, no choice, no JSON."""
    k = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(6))
    said = F.concat(F.lit(" "), F.col("text"), F.lit("\n"))
    part = lambda t: F.struct(F.lit("text").alias("type"), t.alias("text"))
    bare = F.trim(F.col("text"), F.lit(" \n"))
    parts = F.array(part(bare), part(F.lit("")), part(F.lit("more")))
    responses = F.when(k == 0, F.to_json(F.struct(said.alias("output_text")))).when(k == 1, F.to_json(F.struct(F.array(F.struct(parts.alias("content")), F.struct(F.array(part(F.lit(""))).alias("content"))).alias("output")))).when(k == 5, F.lit("{no json"))
    choice = lambda content: F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    chat = F.when(k == 0, choice(F.concat(F.lit("chat "), bare))).when(k == 2, choice(said)).when(k == 3, choice(parts)).when(k == 4, F.lit('{"choices": []}'))
    mode = F.element_at(F.array(*map(F.lit, ["auto", "responses", "chat"])), (F.pmod("turn", F.lit(3)) + 1).cast("int"))
    rows = A.table(spark, sf_dir, "conversations").select("conv_id", "turn", runs.answer(responses, chat, mode).alias("a"))
    return rows.select("conv_id", "turn", "a.text", "a.api_mode", "a.error")


def _prompt_sql():
    quoted = lambda s: "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    tail = f"chr(10) || {quoted(semantics.OMIT)} || chr(10) || chr(10) || 'Page ' || page || ', text as parsed:' || chr(10) || chr(10) || t"
    return f"SELECT doc_id, page::INT AS page, CASE WHEN page % 3 = 0 THEN {quoted(semantics.FULL)} WHEN page % 2 = 0 THEN {quoted(semantics.ADD)} ELSE {quoted(semantics.ANEW)} END || {tail} AS prompt FROM (SELECT doc_id, page, pdf_text AS t FROM page_text)"


@query(ITEMS_SQL + " SELECT doc_id, n::INT AS n, " + f"'{semantics.VISUAL}' || chr(10) || chr(10) || 'Visual ' || n || ', page ' || page || ', ' || label || ' (' || asset || ')' || chr(10) || chr(10) || 'Before:' || chr(10) || right(b, 1200) || chr(10) || chr(10) || 'After:' || chr(10) || right(a, 1200) AS prompt FROM items")
def visual_prompts(spark, sf_dir):
    items = visuals.items(placeholders(spark, sf_dir))
    return items.select("doc_id", "n", semantics.visual_prompt(*[F.col(c) for c in ("visual_id", "page", "label", "asset", "context_before", "context_after")]).alias("prompt"))


@query(f"WITH {A.LINES_SQL}, {A.PAGE_TEXT_SQL} {_prompt_sql()}")
def page_prompts(spark, sf_dir):
    action = F.when(F.col("page") % 2 == 0, "augment").otherwise("rewrite")
    prompts = [semantics.page_prompt(F.col("pdf_text"), action, F.col("page"), markdown_only) for markdown_only in (True, False)]
    return A.page_text(spark, sf_dir).select("doc_id", "page", F.when(F.col("page") % 3 == 0, prompts[1]).otherwise(prompts[0]).alias("prompt"))
