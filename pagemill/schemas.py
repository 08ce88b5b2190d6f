"""Schemas of the relations, all keyed by doc_id; order is always a column."""

from __future__ import annotations

BLOCKS = (
    "doc_id long, block_pos long, page_idx int, type string, text string, text_level int, bbox array<double>, table_body string, "
    "img_path string, content string, table_caption array<string>, image_caption array<string>, chart_caption array<string>, "
    "image_footnote array<string>, chart_footnote array<string>"
)
PAGE_TEXT = "doc_id long, page int, pdf_text string"
PAGE_SEMANTICS = "doc_id long, src_file_ord int, line_no long, model string, page int, status string, action string, description string, error string"
ASSETS = "doc_id long, relative_path string, asset_path string, kind string, bytes long"
LEDGER = "doc_id long, seq long, start_page int, end_page int, status string, content_list string"
CHUNKS = "doc_id long, chunk_index int, source string, page_or_slide string, type string, text string"
VISUAL_ITEMS = "doc_id long, visual_id int, label string, asset string, page int, context_before string, context_after string"
#: One JSON object a line, as a model run writes them.
SEMANTICS_JSON = "model string, page int, status string, action string, description string, error string, elapsed_seconds double"
#: One element of a parser's content list; captions come as a string or a list.
BLOCK_JSON = (
    "page_idx int, type string, text string, text_level int, bbox array<double>, table_body string, img_path string, content string, "
    "table_caption variant, image_caption variant, chart_caption variant, image_footnote variant, chart_footnote variant"
)
