"""Choices, guards, commands, answers and reading tables."""

import sys
import types

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagemill.operators import runs
from pagemill.sources import parsers, tables


def one(spark, column):
    return spark.range(1).select(column.alias("out")).first().out


@pytest.mark.parametrize("asked, want", [("auto", "pipeline"), ("pipeline", "pipeline")])
def test_accepted_backends(spark, asked, want):
    assert one(spark, runs.backend(F.lit(asked))) == want


@pytest.mark.parametrize("asked", ["hybrid-engine", "vlm-engine", "vlm-http-client", "", None])
def test_other_backends_are_refused(spark, asked):
    with pytest.raises(PySparkException, match="unsupported backend"):
        one(spark, runs.backend(F.lit(asked).cast("string")))


def test_commands_run_once_and_say_what_came_of_them(spark):
    rows = [(1, ["sh", "-c", "printf 0123456789; echo bad >&2; exit 3"]), (2, ["no-such-program"]), (3, ["sleep", "5"])]
    found = {r.doc_id: r for r in runs.run_parser(spark.createDataFrame(rows, "doc_id long, command array<string>"), timeout=1, kept=4).collect()}
    assert (found[1].returncode, found[1].stdout, found[1].stderr) == (3, "6789", "bad\n")
    assert found[2].returncode == runs.NOT_FOUND and found[3].returncode == runs.TIMED_OUT


@pytest.mark.parametrize("response, text", [
    ('{"choices":[{"message":{"content":" a \\n"}},{"message":{"content":"b"}}]}', "a"),
    ('{"choices":[{"message":{"content":[{"text":"a"},{"text":""},{"image":1},{"text":"b"}]}}]}', "a\nb"),
    ('{"choices":[{"message":{"content":" "}}]}', None), ('{"choices":[]}', None), ('{"choices":[{"message":{"content":[]}}]}', None), ("no json", None), (None, None),
])
def test_chat_text(spark, response, text):
    assert one(spark, runs.chat_text(F.try_parse_json(F.lit(response).cast("string")))) == text


def test_removal_stays_below_the_root(spark):
    may = lambda path, root="/w/p": one(spark, runs.may_remove(F.lit(path), F.lit(root)))
    assert [may("/w/p/x"), may("/w/p/./x/.."), may("/w/p"), may("/w/px"), may("/w/p/../q"), may("/w/p/a/../../p/b"), may("/x", "/"), may("/", "/")] == [True, False, False, False, False, True, True, False]


def test_a_small_file_is_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(100).coalesce(1).write.parquet(path)
    part = next((tmp_path / "t.parquet").glob("part-*")).as_posix()
    assert tables.read_table(spark, part).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert tables.read_table(spark, path).rdd.getNumPartitions() == 1  # a folder is read as it lies
    monkeypatch.setattr(tables, "SMALL", 1)
    assert tables.read_table(spark, part).rdd.getNumPartitions() == 1 and tables.read_table(spark, part).count() == 100


class _Page:
    def __init__(self, text):
        self.text = text

    def extract_text(self):
        return self.text


def test_pdf_pages_by_whichever_library_is_there(spark, monkeypatch):
    monkeypatch.setitem(sys.modules, "pypdf", None)
    monkeypatch.setitem(sys.modules, "fitz", None)
    assert parsers.count_of(b"x") is None
    reader = type("Reader", (), {"__init__": lambda self, data: setattr(self, "pages", [_Page("one"), _Page(None)])})
    monkeypatch.setitem(sys.modules, "pypdf", types.SimpleNamespace(PdfReader=reader))
    assert parsers.count_of(b"x") == 2 and parsers.texts_of(b"x") == ["one", ""]
    files = spark.createDataFrame([(1, b"no pdf"), (2, None)], "doc_id long, content binary")
    assert [r.n for r in files.select(parsers.page_count("content").alias("n")).collect()] == [None, None]  # workers have none, or can't read it
    told = parsers.page_texts(files).collect()
    assert len(told) == 2 and all(r.page is None and r.error for r in told)
