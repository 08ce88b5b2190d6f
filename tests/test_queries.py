"""Every registered query of the engine against its SQL, and the entry point."""

import base64
import datetime
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from pagemill.plans import registry

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(os.listdir(SF)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = lambda v: round(v, 9) if isinstance(v, float) and not math.isnan(v) else v.isoformat() if isinstance(v, datetime.datetime) else v
    return sorted(columns), Counter(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    told = duck.execute(ORACLE[name])
    columns = [c[0] for c in told.description]
    assert counted(found.columns, [tuple(r) for r in found.collect()]) == counted(columns, told.fetchall())


PAGES = [
    None, "", " ", "<b>tea</b> &amp; milk", "cut &amp</p>", "cut &quot <i>&copy", "&ampx; &AMP; &nbsp;&#39;&#x41;&eacute;", "&amp;lt;b&amp;gt; &amp;amp;",
    "&am&quot;p; &&lt;i&gt;lt;", "&lt;b&gt;x&middot;&copy;", "<a\nb>c<>d<<e>f<g", "> a < b", "a\u00a0\u00a0 b\u3000", "\u00a0a\u2003", "<p>\u3000x\u00a0</p>",
    "a\x0b\x0bb\x1cc\x85d\u2028", "\ta\r\n\fb ", "\u200bz\u200b", "\x00 q \x00", "&copy;😀<😀>é", "\u00a0" * 30,
]


def test_odd_pages_match_the_sql(spark, duck, tmp_path):
    rows = list(enumerate(PAGES))
    spark.createDataFrame([(i, f"u{i}", h) for i, h in rows], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r.text for r in QUERIES["html_plain_text"](spark, str(tmp_path)).collect()}
    told = duck.cursor().execute(f"WITH pages AS (SELECT * FROM '{tmp_path}/pages.parquet/*.parquet') {ORACLE['html_plain_text']}").fetchall()
    assert found == dict(told) and len(found) == len(PAGES)
    assert found[4] == "cut &amp" and found[0] is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_visual_is_rated_and_filled(spark):
    found = QUERIES
    items = found["visual_items"](spark, SF).select("doc_id", "visual_id")
    rated = found["visual_statuses"](spark, SF)
    assert items.where("visual_id > 3").count() > 0
    assert Counter(map(tuple, rated.select("doc_id", "visual_id").collect())) == Counter(map(tuple, items.collect()))
    told = {(r.doc_id, r.visual_id) for r in rated.where("status = 'described'").collect()}
    filled = {r.doc_id: r.content for r in found["filled_visuals"](spark, SF).collect()}
    assert any(n > 3 for _, n in told)
    assert sum(c.count("- Uncertainty: see description above.") for c in filled.values()) == len(told)


def test_data_urls_hold_whole_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    urls = {r.doc_id: r.url for r in QUERIES["data_urls"](spark, SF).collect()}
    assert max(map(len, texts.values())) > 60
    assert {i: base64.b64decode(u.split(",", 1)[1]).decode() for i, u in urls.items()} == texts
