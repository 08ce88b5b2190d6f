"""Visuals, ledger, audits, files and the streaming ledger."""

import io
import json
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagemill.operators import audit, ledger, visuals
from pagemill.sources import files
from pagemill.streaming import ledger as streaming

from .test_markdown import docs_of

ASSETS = "doc_id long, relative_path string, asset_path string, kind string, bytes long"


def assets_of(spark, *paths):
    return spark.createDataFrame([(0, p, f"assets/{p}", "image", 100 * k) for k, p in enumerate(sorted(paths), 1)], ASSETS)


def plain_lookup(paths):
    """What each key finds: the file of that name if it is the only one, else the last path that is the key or ends in it."""
    names = [p.rsplit("/")[-1] for p in paths]
    ends = {p: {p} | ({"/".join(p.split("/")[-2:])} if "/" in p else set()) for p in paths}
    found = {}
    for key in set(names).union(*ends.values()):
        own = [p for p, n in zip(paths, names) if n == key] if names.count(key) == 1 else [p for p in paths if key in ends[p]]
        if own:
            found[key] = f"assets/{max(own)}"
    return found


@pytest.mark.parametrize("paths", [["a/b/x.png", "c/b/x.png", "y.png"], ["x.png", "a/x.png"], ["b/x.png", "a/b/x.png", "a/b/c.png", "c.html"], ["solo.png"]])
def test_asset_lookup(spark, paths):
    assert {r.key: r.asset for r in visuals.asset_lookup(assets_of(spark, *paths)).collect()} == plain_lookup(paths)


CONTENT = "# t\n![a](./img/x%20y.png)\n## Page 1\ntext ![ ](gone.png#f) and ![b]('solo.png')\n## Page 2\n"


def test_links_become_placeholders_and_items(spark):
    docs, assets = docs_of(spark, CONTENT, "none", ""), assets_of(spark, "img/x y.png", "deep/solo.png")
    found = visuals.links(docs, assets)
    assert sorted((r.n, r.alt, r.asset) for r in found.collect()) == [(1, "a", "assets/img/x y.png"), (2, "visual element", "gone.png#f"), (3, "b", "assets/deep/solo.png")]
    assert sorted(r.message for r in visuals.warnings(found).collect())[1] == "Visual element 2 requires textual verification: gone.png#f"
    written = visuals.rewrite_links(docs, assets)
    texts = {r.doc_id: r.content for r in written.collect()}
    block = lambda n, a, p: f"\n\n**Visual element {n}: {a}**\n\n- Asset: `{p}`\n{visuals.TODO}\n"
    assert texts == {0: f"# t\n{block(1, 'a', 'assets/img/x y.png')}\n## Page 1\ntext {block(2, 'visual element', 'gone.png#f')} and {block(3, 'b', 'assets/deep/solo.png')}\n## Page 2\n", 1: "none", 2: ""}
    assert visuals.rewrite_links(docs, assets, policy="off") is docs
    items = visuals.items(written)
    got = {r.visual_id: r for r in items.collect()}
    assert {k: (r.label, r.asset, r.page) for k, r in got.items()} == {1: ("a", "assets/img/x y.png", None), 2: ("visual element", "gone.png#f", 1), 3: ("b", "assets/deep/solo.png", 1)}
    assert got[2].context_before == "## Page 1\ntext" and got[2].context_after == "and" and got[3].context_after == "## Page 2"
    assert visuals.first_items(items, 2).count() == 2
    described = spark.createDataFrame([(0, 1, "```\nseen\n```"), (0, 3, "small")], "doc_id long, visual_id int, description string")
    rated = visuals.statuses(items, assets, 150, described)
    assert {r.visual_id: (r.status, r.asset_bytes) for r in rated.collect()} == {1: ("described", 200), 2: ("missing_asset", 0), 3: ("skipped_small_asset", 100)}
    filled = {r.doc_id: r.content for r in visuals.fill(written, rated, 150).collect()}
    assert "- Textual description:\n\nseen\n\n- Uncertainty: see description above." in filled[0] and "(100 bytes < min-size-bytes 150)" in filled[0] and filled[0].count("TODO") == 1 and filled[1] == "none"


def test_page_of_an_offset(spark):
    heads = spark.createDataFrame([(1, 5, 1), (1, 20, 2), (2, 0, 9)], "doc_id long, off int, page int")
    spots = spark.createDataFrame([(1, 4), (1, 5), (1, 19), (1, 20), (1, 99)], "doc_id long, off int")
    assert [r.page for r in visuals.as_of_page(heads, spots).orderBy("off").collect()] == [None, 1, 1, 2, 2]


def test_ledger(spark):
    planned = ledger.plan(spark.createDataFrame([(1, 41), (2, 20), (3, 0)], "doc_id long, page_count long"))
    assert sorted(map(tuple, planned.collect())) == [(1, 0, 19), (1, 20, 39), (1, 40, 40), (2, 0, 19)]
    records = spark.createDataFrame([(1, 1, 0, 19, "error", None), (1, 2, 0, 19, "completed", "a"), (1, 3, 20, 39, "completed", "b"), (1, 4, 20, 39, "error", None), (2, 5, 0, 19, "completed", "lost")], "doc_id long, seq long, start_page int, end_page int, status string, content_list string")
    there = spark.createDataFrame([("a",), ("b",)], "content_list string")
    assert sorted((r.doc_id, r.start_page) for r in ledger.pending(planned, records, there).collect()) == [(1, 20), (1, 40), (2, 0)]
    assert sorted((r.doc_id, r.start_page) for r in ledger.pending(planned, records).collect()) == [(1, 20), (1, 40)]
    tries = spark.createDataFrame([(1, 2, "pypdf", 0), (1, 1, "mineru", 0), (1, 0, "docling", 124), (2, 0, "pypdf", 1)], "doc_id long, attempt_no int, engine string, returncode int")
    assert [tuple(r) for r in ledger.first_success(tries).collect()] == [(1, "mineru")]
    pages = spark.createDataFrame([(1, p) for p in (1, 2, 3, 7, 9, 10, 2)], "doc_id long, page int")
    assert sorted((r.first_page, r.last_page) for r in ledger.ranges(pages).collect()) == [(1, 3), (7, 7), (9, 10)]


def test_packages(spark):
    entries = lambda *names: spark.createDataFrame([(1, n) for n in names], "doc_id long, name string")
    gone = lambda e, keep=None: {r.name for r in audit.removals(e, keep).collect()}
    assert gone(entries("content.md", "x.final.md", "chunks.jsonl", "assets")) == {"content.md", "assets"}
    assert gone(entries("content.md", "chunks.jsonl", "audit.md")) == {"audit.md"}
    assert gone(entries("content.md", "x.final.md", "y.final.md"), "content.md") == {"x.final.md", "y.final.md"}
    with pytest.raises(PySparkException):
        gone(entries("x.final.md", "content.integrated.md"))
    assert audit.artifacts("single-md") == ["content.md", "audit.md"] and "chunks.jsonl" in audit.artifacts("rag-lite")
    warned = spark.createDataFrame([(1, k, f"w{k}") for k in range(10)], "doc_id long, ord int, message string")
    lines = audit.warning_summary(warned).first().lines.split("\n")
    assert lines[0].startswith("- Warnings: 10 recorded") and lines[1] == "  - w0" and len(lines) == 10 and lines[-1] == "  - ... 2 more warnings omitted from summary"


def test_reading_and_writing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_bytes(b"x\r\ny\rz\xff")
    assert files.read_texts(spark, str(tmp_path / "in" / "a.md")).first().content == "x\ny\nz�"
    for k, rows in enumerate([[{"page": 2, "status": "described", "description": "one"}], [{"page": 2, "status": "error", "error": "e"}, {"page": 1, "status": "described"}]]):
        (tmp_path / f"s{k}.jsonl").write_text("\n" + "\n\n".join(json.dumps(r) for r in rows) + "\n")
    paths = [str(tmp_path / f"s{k}.jsonl") for k in (1, 0)]
    got = files.read_jsonl(spark, paths).orderBy("src_file_ord", "line_no").collect()
    assert [(r.src_file_ord, r.page, r.status) for r in got] == [(0, 2, "error"), (0, 1, "described"), (1, 2, "described")]
    (tmp_path / "bad.jsonl").write_text("{not json")
    with pytest.raises(Exception, match="Malformed"):
        files.read_jsonl(spark, [str(tmp_path / "bad.jsonl")]).collect()
    listing = json.dumps([{"page_idx": 0, "type": "image", "image_caption": "one", "bbox": [0, 1, 2, 3]}, "no block", {"type": "table", "table_caption": ["a", "b"]}])
    blocks = files.read_content_lists(spark, spark.createDataFrame([(1, listing)], "doc_id long, content string")).orderBy("block_pos").collect()
    assert [(r.block_pos, r.page_idx, r.image_caption, r.table_caption, r.bbox) for r in blocks] == [(0, 0, ["one"], None, [0.0, 1.0, 2.0, 3.0]), (2, None, None, ["a", "b"], None)]
    (tmp_path / "in" / "b.PNG").write_bytes(b"12")
    listed = files.list_files(spark, str(tmp_path / "in"), [".png"])
    assert [(r.path.split("/")[-1], r.size) for r in listed.collect()] == [("b.PNG", 2)]
    assert '"batch_pages":20' in files.file_signature(listed, "pipeline", "auto", 20).first().signature
    slides = io.BytesIO()
    with zipfile.ZipFile(slides, "w") as z:
        for n in ("ppt/slides/slide1.xml", "ppt/slides/slide22.xml", "ppt/slides/_rels/slide1.xml.rels"):
            z.writestr(n, "")
    decks = spark.createDataFrame([(slides.getvalue(),), (b"no zip",), (None,)], "content binary")
    assert [r.n for r in decks.select(files.slide_count("content").alias("n")).collect()] == [2, None, None]
    frame = spark.createDataFrame([(1, "ä", None)], "doc_id long, content string, page int")
    files.write_jsonl(frame, str(tmp_path / "j"))
    files.write_markdown(frame, str(tmp_path / "m"))
    files.write_json(frame, str(tmp_path / "d"))
    only = lambda p: next((tmp_path / p / "doc_id=1").glob("part-*")).read_text()
    assert json.loads(only("j")) == json.loads(only("d")) == {"content": "ä", "page": None} and only("m") == "ä\n"
    with pytest.raises(PySparkException):
        files.write_jsonl(frame, str(tmp_path / "j"))
    prints = audit.fingerprints(frame).first()
    assert prints.bytes == 2 and len(prints.sha256) == 64


def test_the_streaming_ledger_takes_up_what_is_new(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    write = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, seq long, start_page int, end_page int, status string, content_list string").coalesce(1).write.mode("append").json(source)
    write((1, 1, 0, 19, "error", "x"))
    assert [r.status for r in streaming.follow(spark, source, out, mark).collect()] == ["error"]
    write((1, 2, 0, 19, "completed", "y"), (1, 3, 20, 39, "completed", "z"))
    again = streaming.follow(spark, source, out, mark)
    assert sorted((r.start_page, r.status, r.seq) for r in again.collect()) == [(0, "completed", 2), (20, "completed", 3)]
    assert streaming.follow(spark, source, out, mark).count() == 2
