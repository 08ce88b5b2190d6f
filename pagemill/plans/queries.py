"""The registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit, blocks, integrate, ledger, package, routing, scoring, segment, semantics, visuals
from . import adapters as A
from .registry import query

SENSITIVITIES = (0, 30, 50, 70, 100)


def joined(column: str, by: str = ","):
    return F.array_join(column, by).alias(column)


# --- scoring and routes

PLAIN = r"trim(regexp_replace(regexp_replace(coalesce({0}, ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))".format
FEATURES_SQL = (
    f"WITH {A.BLOCKS_SQL}, {A.PAGE_TEXT_SQL},"
    + rf"""
measured AS (SELECT *, page_idx + 1 AS page, type NOT IN ('header', 'footer', 'page_number') AS meaningful, type IN ('chart', 'image') AS visual, {PLAIN("text")} AS t, {PLAIN("table_body")} AS tb,
  CASE WHEN caption IS NOT NULL THEN '[''' || caption || ''']' ELSE '' END AS cap FROM blocks),
evidenced AS (SELECT *, CASE WHEN meaningful THEN array_to_string(list_filter([t, tb, cap], lambda x: x <> ''), ' ') ELSE '' END AS evidence, CASE WHEN type = 'text' THEN t ELSE '' END AS own_text FROM measured),
paged AS (SELECT doc_id, page, count(*) FILTER (type = 'chart') AS charts, count(*) FILTER (type = 'image') AS images, count(*) FILTER (type = 'table') AS tables, count(*) FILTER (meaningful) AS meaningful,
  count(*) FILTER (visual AND cap <> '') AS captioned, count(*) FILTER (meaningful AND type = 'text' AND length(t) BETWEEN 1 AND 30) AS short_text, least(1.0, sum(area)) AS area,
  coalesce(string_agg(evidence, ' ' ORDER BY block_pos) FILTER (evidence <> ''), '') AS evidence, coalesce(string_agg(own_text, ' ' ORDER BY block_pos) FILTER (own_text <> ''), '') AS own_text FROM evidenced GROUP BY doc_id, page),
measures AS (SELECT p.doc_id, p.page, charts, images, tables, meaningful, captioned, short_text, area, length(regexp_replace(evidence, '\s+', '', 'g')) AS evidence_chars, length(own_text) AS text_chars,
  length(regexp_replace(pdf_text, '\s+', '', 'g')) AS pdf_chars, len(regexp_extract_all(evidence, '\d+(?:[.,]\d+)?%?')) AS numeric_tokens FROM page_text p JOIN paged USING (doc_id, page)),
features AS (SELECT *, least(1.0, evidence_chars / greatest(1, pdf_chars)) AS coverage FROM measures)"""
)
SCORED_SQL = (
    FEATURES_SQL
    + """, scored AS (SELECT *, least(100,
  CASE WHEN charts > 0 THEN least(55, 40 + 8 * (charts - 1)) ELSE 0 END + CASE WHEN images > 0 THEN least(35, 20 + 5 * (images - 1)) ELSE 0 END
  + CASE WHEN area >= 0.45 THEN 30 WHEN area >= 0.25 THEN 20 WHEN area >= 0.10 THEN 10 ELSE 0 END + CASE WHEN captioned > 0 THEN 10 ELSE 0 END + CASE WHEN images >= 2 AND area >= 0.10 THEN 15 ELSE 0 END
  + CASE WHEN coverage < 0.45 THEN 20 WHEN coverage < 0.75 THEN 10 ELSE 0 END + CASE WHEN charts + images > 0 AND text_chars < 250 THEN 10 ELSE 0 END
  + CASE WHEN meaningful >= 16 THEN 10 WHEN meaningful >= 10 THEN 5 ELSE 0 END + CASE WHEN short_text >= 6 AND numeric_tokens >= 5 THEN 10 ELSE 0 END + CASE WHEN tables > 0 AND charts + images > 0 THEN 10 ELSE 0 END)::INT AS score,
  array_to_string(list_filter([CASE WHEN charts > 0 THEN 'chart_blocks:' || charts END, CASE WHEN images > 0 THEN 'image_blocks:' || images END, CASE WHEN area >= 0.10 THEN 'visual_area:' || printf('%.2f', area) END,
    CASE WHEN captioned > 0 THEN 'captioned_visuals:' || captioned END, CASE WHEN images >= 2 AND area >= 0.10 THEN 'multi_panel_visual' END, CASE WHEN coverage < 0.75 THEN 'text_coverage:' || printf('%.2f', coverage) END,
    CASE WHEN charts + images > 0 AND text_chars < 250 THEN 'low_text:' || text_chars END, CASE WHEN meaningful >= 10 THEN 'layout_blocks:' || meaningful END,
    CASE WHEN short_text >= 6 AND numeric_tokens >= 5 THEN 'kpi_or_callout_layout' END, CASE WHEN tables > 0 AND charts + images > 0 THEN 'mixed_table_visual' END], lambda x: x IS NOT NULL), ',') AS reasons FROM features)"""
)


def routed_sql(sensitivities: tuple[int, ...]) -> str:
    return (
        SCORED_SQL
        + f""", levels AS (SELECT unnest([{", ".join(map(str, sensitivities))}]) AS sensitivity), ruled AS (SELECT *, 100 - sensitivity AS threshold,
  (images > 0 AND text_chars = 0 AND tables = 0) OR (round(coverage, 3) < 0.20 AND images > 0 AND tables = 0) AS hard,
  100 - sensitivity > 0 AND charts = 0 AND images > 0 AND round(area, 3) < 0.10 AND captioned = 0 AND round(coverage, 3) >= 0.20 AS decorative FROM scored, levels),
routes AS (SELECT *, CASE WHEN decorative THEN 'keep' WHEN score < threshold AND NOT hard THEN 'keep' WHEN tables > 0 OR charts > 0 THEN 'augment'
  WHEN hard OR (images >= 3 AND text_chars < 300) OR text_chars < 120 THEN 'rewrite' ELSE 'augment' END AS action FROM ruled)"""
    )


def _features(spark, sf_dir):
    return scoring.features(A.blocks(spark, sf_dir), A.page_text(spark, sf_dir))


def _routes(spark, sf_dir, sensitivity=50):
    return scoring.routed(scoring.scored(_features(spark, sf_dir)), sensitivity)


@query(FEATURES_SQL + " SELECT doc_id, page::INT AS page, charts, images, tables, meaningful, captioned, short_text, area::DOUBLE AS area, evidence_chars, text_chars, pdf_chars, coverage::DOUBLE AS coverage, numeric_tokens::BIGINT AS numeric_tokens FROM features")
def page_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query(SCORED_SQL + " SELECT doc_id, page::INT AS page, score, reasons FROM scored")
def page_scores(spark, sf_dir):
    return scoring.scored(_features(spark, sf_dir)).select("doc_id", "page", "score", joined("reasons"))


@query(routed_sql(SENSITIVITIES) + " SELECT sensitivity, doc_id, page::INT AS page, score, action FROM routes")
def page_routes(spark, sf_dir):
    scored = scoring.scored(_features(spark, sf_dir))
    levels = scored.withColumn("sensitivity", F.explode(F.array(*map(F.lit, SENSITIVITIES))))
    return scoring.routed(levels, F.col("sensitivity")).select("sensitivity", "doc_id", "page", "score", "action")


@query(
    routed_sql((50,))
    + """, chosen AS (SELECT doc_id, page, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS run FROM routes WHERE action <> 'keep'),
runs AS (SELECT doc_id, min(page) AS a, max(page) AS b FROM chosen GROUP BY doc_id, run),
specs AS (SELECT doc_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ',' ORDER BY a) AS spec FROM runs GROUP BY doc_id)
SELECT doc_id, 50 AS sensitivity, 50 AS risk_threshold, max(page)::INT AS expected_pages, count(*) FILTER (action = 'keep') AS keep, count(*) FILTER (action = 'augment') AS augment, count(*) FILTER (action = 'rewrite') AS rewrite,
  coalesce(any_value(spec), '') AS selected_page_spec FROM routes LEFT JOIN specs USING (doc_id) GROUP BY doc_id"""
)
def route_summary(spark, sf_dir):
    return scoring.selection(_routes(spark, sf_dir), 50)


@query(f"WITH {A.BLOCKS_SQL} SELECT doc_id, (page_idx + 1)::INT AS page, type, count(*) AS n FROM blocks GROUP BY ALL")
def block_type_histogram(spark, sf_dir):
    return A.blocks(spark, sf_dir).groupBy("doc_id", (F.col("page_idx") + 1).alias("page"), "type").agg(F.count(F.lit(1)).alias("n"))


@query(FEATURES_SQL + " SELECT doc_id, page::INT AS page, evidence, own_text FROM paged")
def page_evidence(spark, sf_dir):
    return scoring.page_evidence(A.blocks(spark, sf_dir)).select("doc_id", "page", "evidence", "own_text")


@query(
    routed_sql((50,))
    + """, chosen AS (SELECT doc_id, page, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS run FROM routes WHERE action <> 'keep')
SELECT doc_id, min(page)::INT AS first_page, max(page)::INT AS last_page FROM chosen GROUP BY doc_id, run"""
)
def selected_ranges(spark, sf_dir):
    return ledger.ranges(_routes(spark, sf_dir).where("action <> 'keep'"))


# --- text

@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_plain_text(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", T.page_plain_text(F.col("html")).alias("text"))


NUMBERS = "list_sort(list_distinct(list_filter(list_transform(list_filter(list_transform(string_split({0}, ' '), lambda t: rtrim(t, ';')), lambda t: regexp_full_match(t, '[0-9][0-9,]*([.][0-9]+)?%?')), lambda t: replace(t, ',', '')), lambda t: length(regexp_replace(t, '[^0-9]', '', 'g')) >= 2 OR contains(t, '.') OR contains(t, '%'))))".format


@query(f"WITH {A.NUMBERS_SQL} SELECT key, array_to_string({NUMBERS('generated')}, ' ') AS found, array_to_string({NUMBERS('evidence')}, ' ') AS known FROM numbers")
def numeric_tokens(spark, sf_dir):
    return A.numbers(spark, sf_dir).select("key", F.array_join(T.numeric_tokens(F.col("generated")), " ").alias("found"), F.array_join(T.numeric_tokens(F.col("evidence")), " ").alias("known"))


@query(f"WITH {A.NUMBERS_SQL} SELECT key, array_to_string(list_filter({NUMBERS('generated')}, lambda t: NOT list_contains({NUMBERS('evidence')}, t)), ' ') AS novel FROM numbers")
def novel_numbers(spark, sf_dir):
    return A.numbers(spark, sf_dir).select("key", F.array_join(T.novel_numbers(F.col("generated"), F.col("evidence")), " ").alias("novel"))


FEWER = r"regexp_replace(trim({0}, ' ' || chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')".format


@query(
    rf"""WITH x AS (SELECT doc_id, text, {FEWER("text")} AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 301 THEN t ELSE left(t, 150) || chr(10) || chr(10) || '[...middle omitted...]' || chr(10) || chr(10) || right(t, 151) END AS compact, right(t, 1200) AS context, right(text, 100) AS tail FROM x"""
)
def compact_texts(spark, sf_dir):
    text = F.col("text")
    return A.table(spark, sf_dir, "documents").select("doc_id", T.compact_text(text, 301).alias("compact"), T.compact_context(text).alias("context"), T.tail(text, 100).alias("tail"))


@query(
    rf"""WITH {A.LINES_SQL}, bare AS (SELECT doc_id, pos, lower(trim(regexp_replace(regexp_replace(line, '^[#>*+\-\s]+', ''), '\*\*|__|`', '', 'g'), '*_ ')) AS seen FROM lines)
SELECT doc_id, count(*) FILTER (contains(seen, '内部使用') OR contains(seen, '严格保密') OR seen IN ('confidential', 'strictly confidential') OR contains(seen, 'confidential')) AS labelled, count(*) AS n FROM bare GROUP BY doc_id"""
)
def confidential_lines(spark, sf_dir):
    line = F.col("line")
    seen = T.is_confidential(line) | F.lower(T.visible_line(line)).contains("confidential")
    return A.lines(spark, sf_dir).groupBy("doc_id").agg(F.count_if(seen).cast("long").alias("labelled"), F.count(F.lit(1)).alias("n"))


@query(
    rf"""WITH {A.LINES_SQL}, more AS (SELECT doc_id, pos, line FROM lines UNION ALL SELECT doc_id, 1000000 + pos, '> Page ' || pos FROM lines WHERE pos % 2 = 0 UNION ALL SELECT doc_id, 2000000 + pos, '- Confidential' FROM lines WHERE pos % 3 = 0),
bare AS (SELECT doc_id, pos, lower(regexp_replace(regexp_replace(trim(line), '^(?:(?:>\s*)|(?:[-*+]\s+))+', ''), '\s+', ' ', 'g')) AS seen FROM more)
SELECT doc_id, count(*) FILTER (seen IN ('confidential', 'strictly confidential', '严格保密') OR regexp_full_match(seen, '(?:page|第)\s*\d+\s*(?:页)?')) AS boilerplate, count(*) AS n FROM bare GROUP BY doc_id"""
)
def boilerplate_lines(spark, sf_dir):
    rows = A.lines(spark, sf_dir)
    numbered = rows.where("pos % 2 = 0").select("doc_id", F.concat(F.lit("> Page "), F.col("pos").cast("string")).alias("line"))
    secret = rows.where("pos % 3 = 0").select("doc_id", F.lit("- Confidential").alias("line"))
    both = rows.select("doc_id", "line").unionByName(numbered).unionByName(secret)
    return both.groupBy("doc_id").agg(F.count_if(T.is_boilerplate(F.col("line"))).cast("long").alias("boilerplate"), F.count(F.lit(1)).alias("n"))


SECRET_RULES = [*T.SECRETS.items(), ("absolute user path", T.USER_PATH)]


@query(
    "SELECT doc_id, array_to_string(list_filter(["
    + ", ".join("CASE WHEN regexp_matches(text, '{}') THEN '{}' END".format(p.replace("'", "''"), name) for name, p in SECRET_RULES)
    + "], lambda x: x IS NOT NULL), ',') AS findings FROM documents"
)
def secret_scan(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.secret_findings(F.col("text")), ",").alias("findings"))


PATHS = ["deck.PPTX", "a.b/report.pdf", "scan.JPeg", "notes", "x.tar.gz", "sheet.tsv", "page.mhtml", "letter.rtf"]


@query(
    f"""WITH f AS (SELECT p_partkey, [{", ".join(f"'{p}'" for p in PATHS)}][p_partkey % {len(PATHS)} + 1] AS path, p_name FROM part)
SELECT p_partkey, CASE p_partkey % {len(PATHS)} WHEN 0 THEN 'slides' WHEN 1 THEN 'pdf' WHEN 2 THEN 'image' WHEN 5 THEN 'spreadsheet' WHEN 6 THEN 'web' WHEN 7 THEN 'document' ELSE 'unknown' END AS kind,
  CASE p_partkey % {len(PATHS)} WHEN 0 THEN 'slides' WHEN 1 THEN 'pages' WHEN 2 THEN 'images' ELSE 'units' END AS unit, CASE p_partkey % {len(PATHS)} WHEN 0 THEN p_partkey % 50 WHEN 1 THEN p_partkey % 50 WHEN 2 THEN 1 END::BIGINT AS units,
  regexp_replace(p_name, '[<>:"/|?*]+', '_', 'g') || '_' || path_name AS name FROM f, LATERAL (SELECT replace(path, '/', '_') AS path_name)"""
)
def source_kinds(spark, sf_dir):
    path = F.element_at(F.array(*map(F.lit, PATHS)), (F.pmod("p_partkey", F.lit(len(PATHS))) + 1).cast("int"))
    units = T.expected_units(F.col("path"), F.pmod("p_partkey", F.lit(50)))
    rows = A.table(spark, sf_dir, "part").select("p_partkey", "p_name", path.alias("path"))
    return rows.select("p_partkey", T.source_kind(F.col("path")).alias("kind"), units["unit"].alias("unit"), units["count"].alias("units"), T.safe_name(F.concat("p_name", F.lit("?<"), "path")).alias("name"))


@query(r"""SELECT o_orderkey, (o_orderkey % 5 + 1)::VARCHAR || ', ' || (o_orderkey % 7 + 3) || '-' || (o_orderkey % 7 + 5) AS spec,
  array_to_string(list_sort(list_distinct([o_orderkey % 5 + 1, o_orderkey % 7 + 3, o_orderkey % 7 + 4, o_orderkey % 7 + 5])), ' ') AS pages FROM orders""")
def parsed_page_specs(spark, sf_dir):
    k = lambda m, add: (F.pmod("o_orderkey", F.lit(m)) + add).cast("string")
    rows = A.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(k(5, 1), F.lit(", "), k(7, 3), F.lit("-"), k(7, 5)).alias("spec"))
    return rows.select("o_orderkey", "spec", F.array_join(F.transform(T.parse_pages(F.col("spec")), lambda p: p.cast("string")), " ").alias("pages"))


@query("SELECT doc_id, octet_length(encode(text))::BIGINT AS bytes, sha256(text) AS sha256 FROM documents")
def sha256_docs(spark, sf_dir):
    return audit.fingerprints(A.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))).select("doc_id", "bytes", "sha256")


@query("SELECT doc_id, 'data:image/png;base64,' || to_base64(encode(text)) AS url FROM documents")
def data_urls(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", T.data_url(F.lit("x.png"), F.encode("text", "UTF-8")).alias("url"))


# --- segments and blocks

@query(
    f"""WITH {A.LINES_SQL}, {A.MARKDOWN_SQL}
SELECT doc_id, 0 AS chunk_index, NULL::INT AS page, NULL::VARCHAR AS page_or_slide, '# Document ' || doc_id AS text FROM documents
UNION ALL SELECT doc_id, page::INT, page::INT, 'page:' || page, trim(section, ' ' || chr(10)) FROM sections"""
)
def page_chunks(spark, sf_dir):
    return segment.page_chunks(A.markdown(spark, sf_dir))


@query(f"WITH {A.LINES_SQL} SELECT doc_id, (pos // {A.PAGE_LINES} + 1)::INT AS page, trim(string_agg(line, chr(10) ORDER BY pos), ' ' || chr(10)) AS body FROM lines GROUP BY ALL")
def page_bodies(spark, sf_dir):
    return segment.page_bodies(A.markdown(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {A.LINES_SQL}, {A.MARKDOWN_SQL}, md AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(rtrim(content, chr(10)), chr(10)) AS l FROM markdown)),
marked AS (SELECT *, CASE WHEN regexp_matches(line, '^## Page [0-9]+') THEN 'page:' || regexp_extract(line, '[0-9]+') END AS head FROM md),
fold AS (SELECT doc_id, pos, line, head AS unit, 0 AS chunk, length(line) + 1 AS size FROM marked WHERE pos = 0
  UNION ALL SELECT m.doc_id, m.pos, m.line, coalesce(m.head, f.unit), CASE WHEN m.head IS NOT NULL OR f.size + length(m.line) > {segment.CHUNK_CHARS} THEN f.chunk + 1 ELSE f.chunk END,
    CASE WHEN m.head IS NOT NULL OR f.size + length(m.line) > {segment.CHUNK_CHARS} THEN 0 ELSE f.size END + length(m.line) + 1 FROM fold f JOIN marked m ON m.doc_id = f.doc_id AND m.pos = f.pos + 1),
texts AS (SELECT doc_id, chunk, any_value(unit) AS page_or_slide, trim(string_agg(line, chr(10) ORDER BY pos), ' ' || chr(10)) AS text FROM fold GROUP BY doc_id, chunk)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY chunk) - 1)::INT AS chunk_index, page_or_slide, text FROM texts WHERE text <> ''"""
)
def greedy_chunks(spark, sf_dir):
    return segment.greedy_chunks(A.markdown(spark, sf_dir))


RENDERED_SQL = (
    f"WITH {A.BLOCKS_SQL}"
    + r""", b AS (SELECT *, trim(coalesce(text, '')) AS t, coalesce(caption, CASE WHEN type = 'table' THEN 'untitled table' ELSE 'untitled visual' END) AS cap FROM blocks),
made AS (SELECT doc_id, page_idx, block_pos, CASE WHEN type = 'table' THEN '### Table: ' || cap || chr(10) || chr(10) || CASE WHEN trim(table_body) <> '' THEN trim(table_body) || chr(10) || chr(10) ELSE '' END
  WHEN type IN ('image', 'chart') THEN '### ' || CASE type WHEN 'image' THEN 'Image' ELSE 'Chart' END || ': ' || cap || chr(10) || chr(10) || CASE WHEN trim(coalesce(content, '')) <> '' THEN trim(content) || chr(10) || chr(10) ELSE '' END
    || '![' || CASE type WHEN 'image' THEN 'Image' ELSE 'Chart' END || ' visual](' || img_path || ')' || chr(10) || chr(10)
  WHEN t = '' THEN '' WHEN type <> 'text' THEN '*' || type || ': ' || t || '*' || chr(10) || chr(10)
  WHEN text_level BETWEEN 1 AND 6 THEN repeat('#', greatest(3, text_level)) || ' ' || t || chr(10) || chr(10) ELSE t || chr(10) || chr(10) END AS md FROM b),
rendered AS (SELECT doc_id, (page_idx + 1)::INT AS page, '## Page ' || (page_idx + 1) || chr(10) || chr(10) || string_agg(md, '' ORDER BY block_pos) AS md FROM made GROUP BY doc_id, page_idx)"""
)


@query(RENDERED_SQL + " SELECT doc_id, page, left(md, length(md) - 1) AS markdown FROM rendered")
def rendered_pages(spark, sf_dir):
    return blocks.render_pages(A.blocks(spark, sf_dir))


@query(RENDERED_SQL + " SELECT doc_id, string_agg(left(md, length(md) - 1), chr(10) ORDER BY page) AS content FROM rendered GROUP BY doc_id")
def rendered_documents(spark, sf_dir):
    return blocks.assemble(blocks.render_pages(A.blocks(spark, sf_dir)))


def _batches(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit(0), F.lit(20), F.lit(40))).alias("start_page"))
    records = docs.select("doc_id", "start_page", (F.col("start_page") + 19).alias("end_page"), F.when(F.pmod(F.col("doc_id") + F.col("start_page") / 20, F.lit(4)) == 3, "error").otherwise("completed").alias("status"))
    items = docs.select("doc_id", "start_page", F.posexplode(F.sequence(F.lit(0), F.pmod("doc_id", F.lit(4)).cast("int"))).alias("item_pos", "k"))
    return records, items.select("doc_id", "start_page", "item_pos", (F.col("k") * 5 + F.when(F.pmod("doc_id", F.lit(2)) == 0, 0).otherwise(F.col("start_page"))).cast("int").alias("page_idx"))


@query(
    """WITH d AS (SELECT doc_id, unnest([0, 20, 40]) AS start_page FROM documents), i AS (SELECT doc_id, start_page, unnest(range(doc_id % 4 + 1)) AS k FROM d),
items AS (SELECT doc_id, start_page, k::INT AS item_pos, k * 5 + CASE WHEN doc_id % 2 = 0 THEN 0 ELSE start_page END AS page_idx FROM i),
b AS (SELECT *, min(page_idx) OVER w >= 0 AND max(page_idx) OVER w <= 19 AS relative FROM items WINDOW w AS (PARTITION BY doc_id, start_page))
SELECT doc_id, start_page, item_pos, (page_idx + CASE WHEN relative THEN start_page ELSE 0 END)::INT AS page_idx FROM b WHERE (doc_id + start_page // 20) % 4 <> 3"""
)
def rebased_blocks(spark, sf_dir):
    return blocks.merge_batches(*_batches(spark, sf_dir)).select("doc_id", "start_page", "item_pos", "page_idx")


def _files(spark, sf_dir):
    kinds = F.array(*map(F.lit, ["a_content_list.json", "b_content_list.json", "b_content_list_v2.json", "notes.json"]))
    return A.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.slice(kinds, F.lit(1), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))).alias("k", "path")).select("doc_id", "path", ((F.col("k") * 7 + F.col("doc_id")) % 3).alias("size"))


@query(
    """WITH f AS (SELECT doc_id, k, ['a_content_list.json', 'b_content_list.json', 'b_content_list_v2.json', 'notes.json'][k + 1] AS path, (k * 7 + doc_id) % 3 AS size FROM (SELECT doc_id, unnest(range(doc_id % 4 + 1)) AS k FROM documents))
SELECT doc_id, first(path ORDER BY size DESC, path) AS path FROM f WHERE path LIKE '%\\_content\\_list.json' ESCAPE '\\' GROUP BY doc_id""".replace("\\\\", "\\")
)
def picked_content_lists(spark, sf_dir):
    return blocks.pick_content_list(_files(spark, sf_dir))


# --- answers

DESCRIBED = f"WITH {A.SEMANTICS_SQL}, "


@query(DESCRIBED + "r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY src_file_ord DESC, line_no DESC) AS k FROM semantics WHERE status = 'described') SELECT doc_id, page::INT AS page, model, description FROM r WHERE k = 1")
def semantics_last(spark, sf_dir):
    return semantics.last_described(A.semantics(spark, sf_dir))


@query(DESCRIBED + "r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY src_file_ord, line_no) AS k FROM semantics WHERE status = 'described' AND trim(description) <> '') SELECT doc_id, page::INT AS page, model, description FROM r WHERE k = 1")
def semantics_first(spark, sf_dir):
    return semantics.first_described(A.semantics(spark, sf_dir))


@query(DESCRIBED + "r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY src_file_ord DESC, line_no DESC) AS k FROM semantics WHERE model = 'model-1' AND (doc_id % 2 = 0 OR page < 3)) SELECT doc_id, page::INT AS page, status, description, error FROM r WHERE k = 1")
def semantics_of_model(spark, sf_dir):
    rows = A.semantics(spark, sf_dir)
    return semantics.of_model(rows, "model-1", rows.where("doc_id % 2 = 0 OR page < 3"))


@query(DESCRIBED + """b AS (SELECT *, coalesce(max(CASE WHEN status = 'error' AND contains(lower(error), 'unauthorized') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, model ORDER BY src_file_ord, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS blocked FROM semantics)
SELECT doc_id, model, page::INT AS page, line_no, status FROM b WHERE blocked = 0""")
def rows_until_blocked(spark, sf_dir):
    return semantics.until_blocked(A.semantics(spark, sf_dir)).select("doc_id", "model", "page", "line_no", "status")


@query(
    routed_sql((70,))
    + rf""", m AS (SELECT unnest(['m-a', 'm-b']) AS model), t AS (SELECT doc_id, model, page, action, {FEWER("pdf_text")} AS t FROM routes JOIN page_text USING (doc_id, page), m WHERE action <> 'keep')
SELECT doc_id, model, page::INT AS page, action, CASE WHEN length(t) <= 9000 THEN t ELSE left(t, 4500) || chr(10) || chr(10) || '[...middle omitted...]' || chr(10) || chr(10) || right(t, 4500) END AS context, 'pending' AS status FROM t"""
)
def task_queue(spark, sf_dir):
    queue = semantics.task_queue(_routes(spark, sf_dir, 70), A.page_text(spark, sf_dir), ["m-a", "m-b"])
    return semantics.run_queue(queue, semantics.DryRun()).select("doc_id", "model", "page", "action", "context", "status")


@query(f"WITH {A.SEMANTICS_SQL}, e AS (SELECT doc_id, max(page) AS n FROM semantics GROUP BY doc_id), w AS (SELECT doc_id, unnest(range(1, n + 1)) AS page FROM e) SELECT doc_id, page::INT AS page FROM w ANTI JOIN (SELECT DISTINCT doc_id, page FROM semantics WHERE status = 'described') USING (doc_id, page)")
def missing_pages(spark, sf_dir):
    rows = A.semantics(spark, sf_dir)
    return routing.missing_pages(rows.groupBy("doc_id").agg(F.max("page").alias("expected_pages")), rows.where("status = 'described'"))


@query(f"WITH {A.SEMANTICS_SQL} SELECT status, count(*) AS n FROM semantics GROUP BY status")
def status_histogram(spark, sf_dir):
    return audit.histogram(A.semantics(spark, sf_dir))


# --- final Markdown

CLEAN_LINES = r"trim(regexp_replace(regexp_replace({0}, '[ \t]+(\n|$)', '\1', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))".format
ANSWERS_SQL = "answers AS (SELECT doc_id, page, description FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY src_file_ord DESC, line_no DESC) AS k FROM semantics WHERE status = 'described') WHERE k = 1)"
ROUTED_SQL = (
    routed_sql((100,))
    + rf""", {A.SEMANTICS_SQL}, {ANSWERS_SQL},
bodies AS (SELECT doc_id, pos // {A.PAGE_LINES} + 1 AS page, trim(string_agg(line, chr(10) ORDER BY pos), ' ' || chr(10)) AS body FROM lines GROUP BY ALL),
j AS (SELECT b.doc_id, b.page, r.action AS route, r.score, a.doc_id IS NOT NULL AS answered, {CLEAN_LINES("coalesce(a.description, '')")} AS generated, {CLEAN_LINES("b.body")} AS parsed FROM bodies b LEFT JOIN routes r USING (doc_id, page) LEFT JOIN answers a USING (doc_id, page)),
s AS (SELECT *, CASE WHEN route = 'keep' THEN 'kept_mineru' WHEN NOT answered THEN 'fallback_missing_semantics' WHEN route = 'augment' AND generated = '' THEN 'kept_no_missing_visual_semantics' WHEN route = 'augment' THEN 'augmented'
  WHEN generated = '' THEN 'fallback_empty_rewrite' ELSE 'rewritten' END AS status FROM j),
finished AS (SELECT *, CASE status WHEN 'augmented' THEN rtrim(parsed, ' ' || chr(10)) || chr(10) || chr(10) || generated WHEN 'rewritten' THEN generated ELSE parsed END AS body FROM s)"""
)


def _routed(spark, sf_dir):
    bodies = segment.page_bodies(A.markdown(spark, sf_dir))
    return routing.route_pages(bodies, _routes(spark, sf_dir, 100), semantics.last_described(A.semantics(spark, sf_dir)), A.page_text(spark, sf_dir))


@query(ROUTED_SQL + " SELECT doc_id, page::INT AS page, route, score, status FROM finished")
def routed_status(spark, sf_dir):
    return _routed(spark, sf_dir).select("doc_id", "page", "route", "score", F.replace("status", F.lit("_numeric_warning"), F.lit("")).alias("status"))


@query(ROUTED_SQL + """ SELECT doc_id, rtrim(string_agg('## 第 ' || page || ' 页' || chr(10) || chr(10) || CASE WHEN body <> '' THEN body ELSE '_本页无实质内容。_' END || chr(10), chr(10) ORDER BY page), ' ' || chr(10)) || chr(10) AS content FROM finished GROUP BY doc_id""")
def routed_markdown(spark, sf_dir):
    return routing.final_markdown(_routed(spark, sf_dir))


@query(
    DESCRIBED
    + rf"""r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY src_file_ord, line_no) AS k FROM semantics WHERE status = 'described' AND trim(description) <> '')
SELECT doc_id, rtrim(string_agg('## 第 ' || page || ' 页' || chr(10) || chr(10) || {CLEAN_LINES("description")} || chr(10), chr(10) ORDER BY page), ' ' || chr(10)) || chr(10) AS content FROM r WHERE k = 1 GROUP BY doc_id"""
)
def recommended_markdown(spark, sf_dir):
    pages = semantics.first_described(A.semantics(spark, sf_dir))
    return routing.final_markdown(pages.select("doc_id", "page", routing.clean_recommended(F.col("description")).alias("body")))


OVERLAY_SQL = (
    f"WITH {A.LINES_SQL}, {A.MARKDOWN_SQL}, {A.SEMANTICS_SQL}"
    + r""", answers AS (SELECT doc_id, page, status, description FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY src_file_ord DESC, line_no DESC) AS k FROM semantics) WHERE k = 1),
parts AS (SELECT doc_id, 0 AS ord, NULL AS page, '# Document ' || doc_id || chr(10) || chr(10) AS section FROM documents UNION ALL SELECT doc_id, page, page, section || CASE WHEN page < max(page) OVER (PARTITION BY doc_id) THEN chr(10) ELSE '' END FROM sections),
o AS (SELECT p.doc_id, p.ord, p.page, CASE WHEN p.page IS NULL OR a.status IS NULL THEN 'original' WHEN a.status = 'described' AND trim(description, ' ' || chr(10)) <> '' THEN 'integrated' ELSE 'kept_original' END AS status, a.status AS answer, section, description,
  len(regexp_extract_all(section, '[$¥%]|\d+(?:\.\d+)?')) AS numbers, len(regexp_extract_all(section, '<table|\|')) AS tables FROM parts p LEFT JOIN answers a USING (doc_id, page))"""
)


def _overlay(spark, sf_dir):
    rows = A.semantics(spark, sf_dir)
    last = rows.groupBy("doc_id", "page").agg(F.max_by(F.struct("status", "description"), F.struct("src_file_ord", "line_no")).alias("r")).select("doc_id", "page", "r.status", "r.description")
    return integrate.overlay(A.markdown(spark, sf_dir), last)


@query(OVERLAY_SQL + """ SELECT doc_id, ord::INT AS ord, page::INT AS page, status, CASE WHEN answer IS NOT NULL THEN array_to_string(list_filter([CASE WHEN numbers >= 25 THEN 'many_numeric_values:' || numbers END, CASE WHEN tables >= 2 THEN 'dense_tables' END, CASE WHEN page IN (4, 6, 8) THEN 'sample_review_page' END], lambda x: x IS NOT NULL), ',') END AS flags FROM o""")
def risk_flags(spark, sf_dir):
    return _overlay(spark, sf_dir).select("doc_id", "ord", "page", "status", F.when(F.col("flags").isNotNull(), F.array_join("flags", ",")).alias("flags"))


@query(OVERLAY_SQL + """ SELECT doc_id, rtrim(string_agg(CASE WHEN status = 'integrated' THEN '## Page ' || page || chr(10) || chr(10) || trim(description, ' ' || chr(10)) || chr(10) || chr(10) ELSE section END, '' ORDER BY ord), ' ' || chr(10)) || chr(10) AS content, count(*) FILTER (status = 'integrated') AS integrated_pages FROM o GROUP BY doc_id""")
def integrated_markdown(spark, sf_dir):
    return integrate.integrated(_overlay(spark, sf_dir))


# --- visuals

LOOKUP_SQL = (
    f"{A.ASSETS_SQL}"
    + """, named AS (SELECT *, string_split(relative_path, '/') AS parts, string_split(relative_path, '/')[-1] AS name FROM assets),
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id, name) AS n FROM named),
keyed AS (SELECT doc_id, relative_path AS key, asset_path AS asset, 0 AS turn, relative_path AS path, 0 AS k FROM counted UNION ALL SELECT doc_id, array_to_string(parts[-2:], '/'), asset_path, 0, relative_path, 1 FROM counted WHERE len(parts) >= 2
  UNION ALL SELECT doc_id, name, asset_path, 1, relative_path, 0 FROM counted WHERE n = 1),
lookup AS (SELECT doc_id, key, first(asset ORDER BY turn DESC, path DESC, k DESC) AS asset FROM keyed GROUP BY doc_id, key)"""
)


@query(f"WITH {LOOKUP_SQL} SELECT * FROM lookup")
def asset_lookup(spark, sf_dir):
    return visuals.asset_lookup(A.assets(spark, sf_dir))


LINKS_SQL = (
    f"WITH {A.WITH_VISUALS_SQL}, {LOOKUP_SQL}"
    + """, linked AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n, pos, CASE pos % 3 WHEN 0 THEN 'visual element' WHEN 1 THEN 'chart' ELSE 'lost' END AS alt, CASE pos % 3 WHEN 0 THEN './images/fig.png' WHEN 1 THEN 'auto/images/p3.png#x' ELSE 'gone.png' END AS path,
  CASE pos % 3 WHEN 0 THEN 'images/fig.png' WHEN 1 THEN 'auto/images/p3.png' ELSE 'gone.png' END AS key FROM lines WHERE pos % 4 = 2),
links AS (SELECT l.doc_id, n, pos, alt, path, coalesce(asset, path) AS asset FROM linked l LEFT JOIN lookup USING (doc_id, key))"""
)


def _links(spark, sf_dir):
    return visuals.links(A.with_visuals(spark, sf_dir), A.assets(spark, sf_dir))


def placeholders(spark, sf_dir):
    return visuals.rewrite_links(A.with_visuals(spark, sf_dir), A.assets(spark, sf_dir))


@query(LINKS_SQL + " SELECT doc_id, n::INT AS n, alt, path, asset FROM links")
def image_links(spark, sf_dir):
    return _links(spark, sf_dir)


@query(LINKS_SQL + """, w AS (SELECT doc_id, n, '  - Visual element ' || n || ' requires textual verification: ' || asset AS line FROM links)
SELECT doc_id, count(*) AS n, '- Warnings: ' || count(*) || ' recorded; see `audit.md` for the full list' || chr(10) || string_agg(line, chr(10) ORDER BY n) FILTER (n <= 8) || CASE WHEN count(*) > 8 THEN chr(10) || '  - ... ' || (count(*) - 8) || ' more warnings omitted from summary' ELSE '' END AS lines FROM w GROUP BY doc_id""")
def warning_summary(spark, sf_dir):
    return audit.warning_summary(visuals.warnings(_links(spark, sf_dir)))


REWRITTEN_SQL = (
    LINKS_SQL
    + f""", rewritten AS (SELECT l.doc_id, '# Document ' || l.doc_id || chr(10) || chr(10) || string_agg(CASE WHEN l.pos % 4 = 0 THEN '## Page ' || (l.pos // 4 + 1) || chr(10) || chr(10) || l.line
    WHEN l.pos % 4 = 2 THEN l.line || chr(10) || chr(10) || chr(10) || '**Visual element ' || k.n || ': ' || k.alt || '**' || chr(10) || chr(10) || '- Asset: `' || k.asset || '`' || chr(10) || '{visuals.TODO.replace(chr(10), "' || chr(10) || '")}' || chr(10) ELSE l.line END, chr(10) ORDER BY l.pos) AS content
  FROM lines l LEFT JOIN links k ON k.doc_id = l.doc_id AND k.pos = l.pos GROUP BY l.doc_id)"""
)


@query(REWRITTEN_SQL + " SELECT doc_id, content FROM rewritten")
def rewritten_links(spark, sf_dir):
    return placeholders(spark, sf_dir)


ITEMS_SQL = (
    REWRITTEN_SQL
    + r""", cut AS (SELECT doc_id, content, regexp_split_to_array(content, '\*\*Visual element \d+: [^\n]*\*\*\n\n- Asset: `[^`]+`\n- Textual description: TODO[^\n]*\n- Uncertainty: description not yet verified\.\n') AS parts FROM rewritten),
items AS (SELECT k.doc_id, k.n, k.n AS visual_id, k.alt AS label, k.asset, (k.pos // 4 + 1) AS page, """
    + FEWER("right(c.parts[k.n], 2000)")
    + " AS b, "
    + FEWER("left(c.parts[k.n + 1], 1200)")
    + " AS a FROM links k JOIN cut c USING (doc_id))"
)


@query(ITEMS_SQL + " SELECT doc_id, n::INT AS n, visual_id::INT AS visual_id, label, asset, page::INT AS page, right(b, 1200) AS context_before, right(a, 1200) AS context_after FROM items")
def visual_items(spark, sf_dir):
    return visuals.items(placeholders(spark, sf_dir))


@query(ITEMS_SQL + " SELECT doc_id, n::INT AS n, label, asset FROM items WHERE n <= 3")
def first_visuals(spark, sf_dir):
    """The limit is the feature here."""
    return visuals.first_items(visuals.items(placeholders(spark, sf_dir)), 3).select("doc_id", "n", "label", "asset")


def _rated(spark, sf_dir):
    found = visuals.items(placeholders(spark, sf_dir))
    described = found.where("visual_id % 2 = 0").select("doc_id", "visual_id", F.concat(F.lit("seen "), "label").alias("description"))
    return visuals.statuses(found, A.assets(spark, sf_dir), 2000, described)


STATUS_SQL = ITEMS_SQL + """, rated AS (SELECT i.doc_id, i.n, i.label, i.asset, a.bytes IS NOT NULL AS asset_exists, coalesce(a.bytes, 0) AS asset_bytes, CASE WHEN a.bytes IS NULL THEN 'missing_asset' WHEN a.bytes < 2000 THEN 'skipped_small_asset' WHEN i.n % 2 = 0 THEN 'described' ELSE 'pending' END AS status
  FROM items i LEFT JOIN assets a ON a.doc_id = i.doc_id AND a.asset_path = i.asset)"""


@query(STATUS_SQL + " SELECT doc_id, n::INT AS visual_id, asset, asset_exists, asset_bytes::BIGINT AS asset_bytes, status FROM rated")
def visual_statuses(spark, sf_dir):
    return _rated(spark, sf_dir).select("doc_id", "visual_id", "asset", "asset_exists", F.col("asset_bytes").cast("long").alias("asset_bytes"), "status")


FILLED_SQL = (
    STATUS_SQL
    + f""", notes AS (SELECT k.doc_id, k.pos, '**Visual element ' || k.n || ': ' || k.alt || '**' || chr(10) || chr(10) || '- Asset: `' || k.asset || '`' || chr(10) ||
    CASE r.status WHEN 'described' THEN '- Textual description:' || chr(10) || chr(10) || 'seen ' || k.alt || chr(10) || chr(10) || '- Uncertainty: see description above.' || chr(10)
      WHEN 'skipped_small_asset' THEN '- Textual description: skipped as likely decorative or low-information visual asset (' || r.asset_bytes || ' bytes < min-size-bytes 2000).' || chr(10) || '- Uncertainty: verify manually if this element is semantically important.' || chr(10)
      ELSE '{visuals.TODO.replace(chr(10), "' || chr(10) || '")}' END AS note FROM links k LEFT JOIN rated r ON r.doc_id = k.doc_id AND r.n = k.n)
SELECT l.doc_id, '# Document ' || l.doc_id || chr(10) || chr(10) || string_agg(CASE WHEN l.pos % 4 = 0 THEN '## Page ' || (l.pos // 4 + 1) || chr(10) || chr(10) || l.line
  WHEN l.pos % 4 = 2 THEN l.line || chr(10) || chr(10) || chr(10) || note || chr(10) ELSE l.line END, chr(10) ORDER BY l.pos) AS content FROM lines l LEFT JOIN notes USING (doc_id, pos) GROUP BY l.doc_id"""
)


@query(FILLED_SQL)
def filled_visuals(spark, sf_dir):
    return visuals.fill(placeholders(spark, sf_dir), _rated(spark, sf_dir), 2000)


@query(f"WITH {A.LINES_SQL}, h AS (SELECT doc_id, pos AS off, pos // 4 + 1 AS page FROM lines WHERE pos % 4 = 1), o AS (SELECT doc_id, pos AS off FROM lines WHERE pos % 3 = 0) SELECT o.doc_id, o.off::INT AS off, h.page::INT AS page FROM o ASOF LEFT JOIN h ON o.doc_id = h.doc_id AND o.off >= h.off")
def visual_page_asof(spark, sf_dir):
    rows = A.lines(spark, sf_dir).select("doc_id", F.col("pos").alias("off"))
    headings = rows.where("off % 4 = 1").withColumn("page", (F.floor(F.col("off") / 4) + 1).cast("int"))
    return visuals.as_of_page(headings, rows.where("off % 3 = 0"))


# --- ledger

PLAN_SQL = "planned AS (SELECT doc_id, s::INT AS start_page, (least(s + 20, n) - 1)::INT AS end_page FROM (SELECT doc_id, n, unnest(range(0, n, 20)) AS s FROM (SELECT user_id AS doc_id, count(*) AS n FROM events GROUP BY user_id)))"


def _planned(spark, sf_dir):
    return ledger.plan(A.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("page_count")))


@query(f"WITH {PLAN_SQL} SELECT * FROM planned")
def batch_plan(spark, sf_dir):
    return _planned(spark, sf_dir)


CURRENT_SQL = f"{A.LEDGER_SQL}, current AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, start_page, end_page ORDER BY seq DESC) AS k FROM ledger) WHERE k = 1)"


@query(f"WITH {CURRENT_SQL} SELECT doc_id, start_page::INT AS start_page, end_page::INT AS end_page, seq, status, content_list FROM current")
def ledger_current(spark, sf_dir):
    return ledger.current(A.ledger(spark, sf_dir))


@query(f"WITH {PLAN_SQL}, {CURRENT_SQL} SELECT p.* FROM planned p ANTI JOIN (SELECT * FROM current WHERE status = 'completed' AND seq % 7 <> 0) c USING (doc_id, start_page, end_page)")
def pending_batches(spark, sf_dir):
    records = A.ledger(spark, sf_dir)
    return ledger.pending(_planned(spark, sf_dir), records, records.where("seq % 7 <> 0").select("content_list"))


@query("""WITH a AS (SELECT user_id AS doc_id, event_id AS attempt_no, ['mineru', 'docling', 'markitdown', 'pymupdf', 'pypdf'][event_id % 5 + 1] AS engine, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 124 END AS returncode FROM events)
SELECT doc_id, first(engine ORDER BY attempt_no) AS engine FROM a WHERE returncode = 0 GROUP BY doc_id""")
def first_success(spark, sf_dir):
    e = A.table(spark, sf_dir, "events")
    engine = F.element_at(F.array(*map(F.lit, ledger.ENGINES)), (F.pmod("event_id", F.lit(5)) + 1).cast("int"))
    return ledger.first_success(e.select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("attempt_no"), engine.alias("engine"), F.when(F.pmod("event_id", F.lit(3)) == 0, 0).otherwise(124).alias("returncode")))


# --- packages

@query(f"WITH {A.LINES_SQL}, {A.ASSETS_SQL} SELECT doc_id, CASE WHEN instr(asset_path, '.') > 0 THEN lower(regexp_extract(relative_path, '(\\.[^./]+)$', 1)) ELSE '<none>' END AS extension, count(*) AS n FROM assets GROUP BY ALL")
def asset_extensions(spark, sf_dir):
    return audit.extensions(A.assets(spark, sf_dir))


@query(f"WITH {A.LINES_SQL}, {A.ASSETS_SQL}, c AS (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents), a AS (SELECT doc_id, count(*) AS asset_files FROM assets GROUP BY doc_id) SELECT doc_id, ((n + 3) // 4)::BIGINT AS page_headings, ((n + 1) // 4)::BIGINT AS visual_placeholders, ((n + 3) // 4 + 1)::BIGINT AS chunks, coalesce(asset_files, 0) AS asset_files FROM c LEFT JOIN a USING (doc_id)")
def package_counts(spark, sf_dir):
    docs = placeholders(spark, sf_dir)
    return audit.package_counts(docs, segment.page_chunks(docs), A.assets(spark, sf_dir))


def _entries(spark, sf_dir):
    names = F.array(*map(F.lit, ["content.md", "audit.md", "chunks.jsonl", "assets"]))
    more = F.when(F.pmod("doc_id", F.lit(3)) == 1, F.array(F.lit("report.final.md"))).when(F.pmod("doc_id", F.lit(3)) == 2, F.array(F.lit("content.integrated.md"))).otherwise(F.array().cast("array<string>"))
    return A.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.concat(names, more)).alias("name"))


@query("""WITH e AS (SELECT doc_id, unnest(list_concat(['content.md', 'audit.md', 'chunks.jsonl', 'assets'], CASE doc_id % 3 WHEN 1 THEN ['report.final.md'] WHEN 2 THEN ['content.integrated.md'] ELSE [] END)) AS name FROM documents)
SELECT doc_id, name FROM e WHERE name <> 'chunks.jsonl' AND name <> CASE doc_id % 3 WHEN 1 THEN 'report.final.md' WHEN 2 THEN 'content.integrated.md' ELSE 'content.md' END""")
def clean_package_plan(spark, sf_dir):
    return audit.removals(_entries(spark, sf_dir))


def _sources(spark, sf_dir):
    """Each document as a converted file."""
    path = F.concat(F.lit("in/"), F.col("doc_id").cast("string"), F.element_at(F.array(*map(F.lit, [".pdf", ".pptx", ".png", ".docx"])), (F.pmod("doc_id", F.lit(4)) + 1).cast("int")))
    return A.table(spark, sf_dir, "documents").select("doc_id", path.alias("source"), F.lit("docling").alias("engine"), F.lit("research-archive").alias("mode"), F.lit("auto").alias("ocr"), (F.pmod("doc_id", F.lit(30)) + 1).alias("counted"))


SOURCES_SQL = "sources AS (SELECT doc_id, 'in/' || doc_id || ['.pdf', '.pptx', '.png', '.docx'][doc_id % 4 + 1] AS source, ['pdf', 'slides', 'image', 'document'][doc_id % 4 + 1] AS kind, ['pages', 'slides', 'images', 'units'][doc_id % 4 + 1] AS unit, CASE doc_id % 4 WHEN 2 THEN 1 WHEN 3 THEN NULL ELSE doc_id % 30 + 1 END AS units FROM documents)"


@query(
    LINKS_SQL
    + f""", {SOURCES_SQL}, w AS (SELECT doc_id, n, '  - Visual element ' || n || ' requires textual verification: ' || asset AS line FROM links),
ws AS (SELECT doc_id, '- Warnings: ' || count(*) || ' recorded; see `audit.md` for the full list' || chr(10) || string_agg(line, chr(10) ORDER BY n) FILTER (n <= 8) || CASE WHEN count(*) > 8 THEN chr(10) || '  - ... ' || (count(*) - 8) || ' more warnings omitted from summary' ELSE '' END AS listed FROM w GROUP BY doc_id)
SELECT doc_id, array_to_string(['# ' || string_split(source, '/')[-1], '', '## Conversion Summary', '', '- Source: `' || source || '`', '- Source type: ' || kind, '- Engine: docling', '- Mode: research-archive', '- OCR preference: auto',
  '- Expected ' || unit || ': ' || coalesce(units::VARCHAR, 'unknown'), '- Images embedded: no', '', coalesce(listed, '- Warnings: none recorded'), ''], chr(10)) AS summary FROM sources LEFT JOIN ws USING (doc_id)"""
)
def conversion_summaries(spark, sf_dir):
    return package.conversion_summary(_sources(spark, sf_dir), visuals.warnings(_links(spark, sf_dir)))


@query(
    STATUS_SQL
    + f""", {SOURCES_SQL}, counts AS (SELECT doc_id, status, count(*) AS n FROM rated GROUP BY ALL), told AS (SELECT doc_id, sum(n) AS total, string_agg(status || '=' || n, ',' ORDER BY status) AS statuses FROM counts GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n FROM assets GROUP BY doc_id), l AS (SELECT doc_id, count(*) AS n FROM links GROUP BY doc_id)
SELECT s.doc_id, source, kind AS source_type, unit, units::BIGINT AS units, coalesce(a.n, 0)::INT AS assets, coalesce(l.n, 0)::INT AS warnings, coalesce(total, 0)::BIGINT AS visuals, coalesce(statuses, '') AS statuses
FROM sources s LEFT JOIN told USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN l USING (doc_id)"""
)
def structure_records(spark, sf_dir):
    attempts = _sources(spark, sf_dir).select("doc_id", F.lit(0).alias("attempt_no"), "engine", F.lit(0).alias("returncode"))
    records = package.structure_records(_sources(spark, sf_dir), A.assets(spark, sf_dir), visuals.warnings(_links(spark, sf_dir)), attempts)
    told = package.with_visual_record(records, _rated(spark, sf_dir), "content.visual.md", "visual.jsonl", "visual.md")
    statuses = F.array_join(F.transform(F.map_entries("visual_description.status_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return told.select("doc_id", "source", "source_type", F.col("expected_units.kind").alias("unit"), F.col("expected_units.count").alias("units"), F.size("assets").alias("assets"), F.size("warnings").alias("warnings"), F.col("visual_description.total").alias("visuals"), statuses.alias("statuses"))


@query(
    ROUTED_SQL
    + """, counts AS (SELECT doc_id, status, count(*) AS n FROM finished GROUP BY ALL), told AS (SELECT doc_id, string_agg(status || '=' || n, ', ' ORDER BY status || '=' || n) AS statuses FROM counts GROUP BY doc_id)
SELECT doc_id, '# Routed Markdown Audit' || chr(10) || chr(10) || '- Sensitivity: 100' || chr(10) || '- Risk threshold: 0' || chr(10) || '- Pages: ' || count(*) || chr(10) || '- Statuses: ' || any_value(statuses) || chr(10) || chr(10) || '## Pages' || chr(10) || chr(10)
  || string_agg('- Page ' || page || ': route=' || route || '; status=' || status || '; score=' || score || '; novel_numbers=none', chr(10) ORDER BY page) || chr(10) AS report FROM finished JOIN told USING (doc_id) GROUP BY doc_id"""
)
def routed_reports(spark, sf_dir):
    return package.routed_report(_routed(spark, sf_dir), 100)


@query(
    OVERLAY_SQL
    + """ SELECT doc_id, '# Integrated Markdown Audit' || chr(10) || chr(10) || '- Integrated pages: ' || count(*) FILTER (status = 'integrated') || chr(10) || chr(10) || '## Pages' || chr(10) || chr(10)
  || string_agg('- Page ' || page || ': ' || status || '; risk_flags=' || CASE WHEN answer IS NOT NULL AND (numbers >= 25 OR tables >= 2 OR page IN (4, 6, 8)) THEN array_to_string(list_filter([CASE WHEN numbers >= 25 THEN 'many_numeric_values:' || numbers END, CASE WHEN tables >= 2 THEN 'dense_tables' END, CASE WHEN page IN (4, 6, 8) THEN 'sample_review_page' END], lambda x: x IS NOT NULL), ', ') ELSE 'none' END, chr(10) ORDER BY ord) || chr(10) AS report
FROM o WHERE page IS NOT NULL GROUP BY doc_id"""
)
def integration_reports(spark, sf_dir):
    return package.integration_report(_overlay(spark, sf_dir))
