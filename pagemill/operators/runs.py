"""What a run may do, how its outside calls look and what their answers say.  Column expressions throughout."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, tail

#: Backends that are accepted, what recognition is called, hosts that need no proxy.
BACKENDS = ("auto", "pipeline")
METHODS = {"auto": "auto", "on": "ocr", "off": "txt"}
LOOPBACK = ("127.0.0.1", "localhost", "::1")
#: Exit codes.
TIMED_OUT, NOT_FOUND = 124, 127


def backend(requested: Column) -> Column:
    """The parser's backend; any that isn't accepted is an error."""
    refused = F.raise_error(F.concat(F.lit("unsupported backend: "), F.coalesce(requested, F.lit("none")))).cast("string")
    return F.when(F.coalesce(requested.isin(*BACKENDS), F.lit(False)), F.lit("pipeline")).otherwise(refused)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parser_command(program: Column, source: Column, output: Column, chosen: Column, ocr: Column, first: Column, last: Column) -> Column:
    """The words of a parser's command line; a page range is given where ``first`` is no null.

    Programs of the older name take their method always, others for PDF files only.
    """
    legacy = F.lower(file_name(program)).startswith("magic-pdf")
    method = F.element_at(F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair]), ocr)
    some = lambda when, *words: F.when(when, F.array(*words)).otherwise(F.array().cast("array<string>"))
    return F.concat(
        F.array(program, F.lit("-p"), source, F.lit("-o"), output), some(legacy, F.lit("-m"), F.lit("auto")), F.array(F.lit("-b"), chosen),
        some(~legacy & F.lower(source).endswith(".pdf"), F.lit("-m"), method), some(first.isNotNull(), F.lit("-s"), first.cast("string"), F.lit("-e"), last.cast("string")),
    )


def run_parser(files: DataFrame, timeout: int = 1800, kept: int = 4000) -> DataFrame:
    """doc_id, returncode and the ends of what was printed, for files (doc_id, command); each command runs once in the task that has its row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import subprocess

        for frame in batches:
            found = []
            for command in frame["command"]:
                try:
                    done = subprocess.run(list(command), capture_output=True, text=True, errors="replace", timeout=timeout or None)
                    found.append((done.returncode, done.stdout, done.stderr))
                except subprocess.TimeoutExpired:
                    found.append((TIMED_OUT, "", f"hard timeout after {timeout}s"))
                except FileNotFoundError as error:
                    found.append((NOT_FOUND, "", str(error)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "returncode": [f[0] for f in found], "stdout": [f[1] for f in found], "stderr": [f[2] for f in found]})

    ran = files.select("doc_id", "command").mapInPandas(run, "doc_id long, returncode int, stdout string, stderr string")
    return ran.select("doc_id", "returncode", tail(F.col("stdout"), kept).alias("stdout"), tail(F.col("stderr"), kept).alias("stderr"))


def page_run_complaint(pages: Column, selection: Column, provider: Column, allowed: Column, has_key: Column, models: Column, sensitivity: Column) -> Column:
    """Why a run over pages must not begin; null if it may.  The first reason counts."""
    given = lambda c: F.coalesce(c != "", F.lit(False))
    outside = provider == "openai"
    named = F.filter(F.transform(F.split(models, ","), strip), lambda m: m != "")
    return (
        F.when(~sensitivity.between(0, 100), "sensitivity must lie between 0 and 100")
        .when(outside & ~allowed, "external calls are not allowed")
        .when(outside & ~has_key, "the key is not set")
        .when(given(pages) == given(selection), "give either pages or a selection")
        .when(F.size(named) == 0, "no models")
    )


def conversion_complaint(resume: Column, overwrite: Column, batch_pages: Column) -> Column:
    """Why a conversion must not begin; null if it may."""
    return F.when(resume & overwrite, "resume and overwrite exclude each other").when(resume & (batch_pages <= 0), "resume needs batches")


def exit_code(complaint: Column, engine: Column, markdown: Column, strict: Column, warnings: Column) -> Column:
    """0, or the first of: 2 arguments, 3 no engine, 4 no Markdown, 5 warnings where none are allowed."""
    return F.when(complaint.isNotNull(), 2).when(~engine, 3).when(~markdown, 4).when(strict & (warnings > 0), 5).otherwise(0)


def output_name(name: Column, exists: Column, overwrite: Column, resume: Column, stamp: Column) -> Column:
    """The folder that a run writes: its own, or a stamped one beside it where that is there and neither kept up nor replaced."""
    return F.when(exists & ~overwrite & ~resume, F.concat(name, F.lit("_"), stamp)).otherwise(name)


def no_proxy(value: Column) -> Column:
    """A list of hosts without proxy, with the loopback ones."""
    given = F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), ","), strip), lambda h: h != "")
    return F.array_join(F.concat(given, F.filter(F.array(*map(F.lit, LOOPBACK)), lambda h: ~F.array_contains(given, h))), ",")


def resolved(path: Column) -> Column:
    """An absolute path without ``.`` and ``..``."""
    step = lambda done, part: F.when(part.isin("", "."), done).when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(part)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/"))


def may_remove(path: Column, root: Column) -> Column:
    """Whether a path lies below a root, and is not the root itself."""
    return F.startswith(resolved(path), F.concat(F.rtrim(resolved(root), F.lit("/")), F.lit("/"))) & (resolved(path) != resolved(root))


def readiness(checks: DataFrame) -> DataFrame:
    """environment, ready, missing: whether all checks of an environment hold, and which don't.  checks: environment, name, expected, installed."""
    ok = F.col("expected").eqNullSafe(F.col("installed"))
    return checks.groupBy("environment").agg(F.bool_and(ok).alias("ready"), F.array_sort(F.collect_list(F.when(~ok, F.col("name")))).alias("missing"))


def raw_output(files: DataFrame) -> DataFrame:
    """doc_id, source, target: where a parser's raw files are kept in the package.  files: doc_id, relative_path."""
    return files.select("doc_id", F.col("relative_path").alias("source"), F.concat(F.lit("engine_output/"), "relative_path").alias("target"))


def _texts(parts: Column) -> Column:
    """The texts of a list of content parts, those that have any."""
    found = F.transform(parts, lambda p: F.try_variant_get(p, "$.text", "string"))
    return F.filter(found, lambda t: t.isNotNull() & (t != ""))


def _told(text: Column) -> Column:
    bare = strip(text)
    return F.when(bare != "", bare)


def chat_text(response: Column) -> Column:
    """What the first choice of a chat response says: a string, or the texts of its parts; null if it says nothing."""
    content = F.try_variant_get(response, "$.choices[0].message.content", "variant")
    kind = F.schema_of_variant(content)
    return F.when(kind == "STRING", _told(F.try_variant_get(content, "$", "string"))).when(kind.startswith("ARRAY"), _told(F.array_join(_texts(F.try_variant_get(content, "$", "array<variant>")), "\n")))


def responses_text(response: Column) -> Column:
    """What a response object says: its output text, or the texts of its outputs' parts; null if it says nothing."""
    outputs = F.coalesce(F.try_variant_get(response, "$.output", "array<variant>"), F.array().cast("array<variant>"))
    parts = F.flatten(F.transform(outputs, lambda o: F.coalesce(F.try_variant_get(o, "$.content", "array<variant>"), F.array().cast("array<variant>"))))
    whole = F.try_variant_get(response, "$.output_text", "string")
    return F.when(F.coalesce(whole, F.lit("")) != "", strip(whole)).otherwise(_told(F.array_join(_texts(parts), "\n")))


def answer(responses: Column, chat: Column, mode: Column) -> Column:
    """(text, api_mode, error): ``responses`` before ``chat`` where the mode is auto; both are JSON text, null where a call failed."""
    by = {"responses": responses_text(F.try_parse_json(responses)), "chat": chat_text(F.try_parse_json(chat))}
    first = F.when(mode.isin("auto", "responses"), by["responses"])
    second = F.when(mode.isin("auto", "chat"), by["chat"])
    text = F.coalesce(first, second)
    return F.struct(
        text.alias("text"), F.when(first.isNotNull(), "responses").when(second.isNotNull(), "chat").alias("api_mode"),
        F.when(text.isNull(), F.concat(mode, F.lit(": no text"))).alias("error"),
    )
