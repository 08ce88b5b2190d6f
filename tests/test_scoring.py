"""Scores and actions at every threshold, against plain Python."""

import itertools

import pytest
from pyspark.sql import functions as F

from pagemill.operators import scoring
from pagemill.schemas import BLOCKS, PAGE_TEXT

COUNTS = ["charts", "images", "tables", "meaningful", "captioned", "short_text", "numeric_tokens"]


def plain_score(f):
    s, why = 0, []

    def add(points, reason):
        nonlocal s
        s += points
        why.append(reason)

    visuals = f["charts"] + f["images"]
    if f["charts"]:
        add(min(55, 32 + 8 * f["charts"]), f"chart_blocks:{f['charts']}")
    if f["images"]:
        add(min(35, 15 + 5 * f["images"]), f"image_blocks:{f['images']}")
    for least, points in ((0.45, 30), (0.25, 20), (0.10, 10)):
        if f["area"] >= least:
            add(points, f"visual_area:{f['area']:.2f}")
            break
    if f["captioned"]:
        add(10, f"captioned_visuals:{f['captioned']}")
    if f["images"] >= 2 and f["area"] >= 0.10:
        add(15, "multi_panel_visual")
    if f["coverage"] < 0.75:
        add(20 if f["coverage"] < 0.45 else 10, f"text_coverage:{f['coverage']:.2f}")
    if visuals and f["text_chars"] < 250:
        add(10, f"low_text:{f['text_chars']}")
    if f["meaningful"] >= 10:
        add(10 if f["meaningful"] >= 16 else 5, f"layout_blocks:{f['meaningful']}")
    if f["short_text"] >= 6 and f["numeric_tokens"] >= 5:
        add(10, "kpi_or_callout_layout")
    if f["tables"] and visuals:
        add(10, "mixed_table_visual")
    return min(100, s), why


def plain_action(f, score, threshold):
    coverage, area = round(f["coverage"], 3), round(f["area"], 3)
    pictures = f["images"] > 0 and not f["tables"]
    hard = pictures and (f["text_chars"] == 0 or coverage < 0.20)
    if threshold > 0 and not f["charts"] and f["images"] and area < 0.10 and not f["captioned"] and coverage >= 0.20:
        return "keep"
    if score < threshold and not hard:
        return "keep"
    if f["tables"] or f["charts"]:
        return "augment"
    return "rewrite" if hard or (f["images"] >= 3 and f["text_chars"] < 300) or f["text_chars"] < 120 else "augment"


def grid():
    base = dict(charts=0, images=0, tables=0, meaningful=1, captioned=0, short_text=0, numeric_tokens=0, area=0.0, coverage=1.0, text_chars=400)
    for change in [dict(charts=c) for c in (1, 2, 3, 4)] + [dict(images=i) for i in (1, 2, 3, 4, 5)]:
        for area, coverage, chars in itertools.product((0.0, 0.0994, 0.0996, 0.10, 0.25, 0.45, 1.0), (0.0, 0.1994, 0.1996, 0.2, 0.449, 0.45, 0.75, 0.125), (0, 119, 120, 249, 250, 299, 300)):
            yield base | change | dict(area=area, coverage=coverage, text_chars=chars)
    for meaningful, short, numeric, tables, images in itertools.product((9, 10, 15, 16), (5, 6), (4, 5), (0, 1), (0, 1)):
        yield base | dict(meaningful=meaningful, short_text=short, numeric_tokens=numeric, tables=tables, images=images, captioned=images)
    yield base | dict(charts=3, images=5, tables=1, captioned=2, area=0.9, coverage=0.1, text_chars=3)
    yield base | dict(meaningful=0, coverage=0.0, text_chars=0)


def test_every_threshold(spark):
    rows = [dict(f, id=k) for k, f in enumerate(grid())]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {'double' if isinstance(v, float) else 'long'}" for k, v in rows[0].items()))
    levels = (0, 30, 50, 70, 100)
    scored = scoring.scored(frame).withColumn("sensitivity", F.explode(F.array(*map(F.lit, levels))))
    found = {(r.id, r.sensitivity): r for r in scoring.routed(scored, F.col("sensitivity")).collect()}
    for r in rows:
        score, why = plain_score(r)
        for level in levels:
            got = found[r["id"], level]
            assert (got.score, got.reasons) == (score, why)
            assert got.action == plain_action(r, score, 100 - level), (r, level)


def block(doc, pos, page, kind, text=None, **more):
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return tuple({"doc_id": doc, "block_pos": pos, "page_idx": page, "type": kind, "text": text, **more}.get(n) for n in names)


def test_features_of_blocks(spark):
    blocks = spark.createDataFrame(
        [
            block(1, 0, 0, "header", "ignored 12"), block(1, 2, 0, "text", "b  5"), block(1, 1, 0, "text", "a <b>1,5%</b>"), block(1, 3, 0, "image", bbox=[0.0, 0.0, 500.0, 200.0], image_caption=["x"]),
            block(1, 4, 0, "image", bbox=[500.0, 200.0, 0.0, 0.0], chart_caption=[""]), block(1, 5, 0, "chart", bbox=[1.0, 2.0, 3.0]), block(1, 6, 0, "table", table_body="t", table_caption=["c", "d"]),
            block(1, 7, None, "text", "no page"), block(1, 8, 0, None, "odd"), block(2, 0, 5, "text", "page that no text layer has"),
        ],
        BLOCKS,
    )
    text = spark.createDataFrame([(1, 1, "a b c"), (1, 2, " 　"), (3, 1, None)], PAGE_TEXT)
    found = {(r.doc_id, r.page): r for r in scoring.features(blocks, text).collect()}
    assert set(found) == {(1, 1), (1, 2), (3, 1)}
    f = found[1, 1]
    assert (f.charts, f.images, f.tables, f.meaningful, f.captioned, f.short_text) == (1, 2, 1, 8, 2, 3)
    assert f.area == pytest.approx(0.1) and f.text_chars == len("a 1,5% b 5 no page") and f.pdf_chars == 3 and f.coverage == 1.0
    evidence = scoring.page_evidence(blocks).where("doc_id = 1").first()
    assert evidence.evidence == "a 1,5% b 5 ['x'] [''] t ['c', 'd'] no page odd" and f.numeric_tokens == 2
    assert scoring.page_evidence(blocks, as_listed=False).where("doc_id = 1").first().captioned == 1
    assert found[1, 2].coverage == 0.0 and found[1, 2].pdf_chars == 0
    blank = {r.doc_id: r.action for r in scoring.routes(blocks, text.where("doc_id = 3"), 100).collect()}
    assert blank == {3: "rewrite"}
    picked = scoring.selection(scoring.routes(blocks, text, 100), 100).where("doc_id = 1").first()
    assert picked.selected_page_spec == "1-2" and picked.expected_pages == 2
    with pytest.raises(ValueError):
        scoring.routed(text, 101)
