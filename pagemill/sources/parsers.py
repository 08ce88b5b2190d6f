"""Page counts, texts and pictures of PDF files, by whichever of two libraries a worker has.  None of them comes with this package."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def count_of(data: bytes | None) -> int | None:
    """Pages of a file's bytes; None where no library can read it."""
    try:
        from pypdf import PdfReader

        return len(PdfReader(io.BytesIO(data)).pages)
    except Exception:  # missing, or a file that it can't read: the other one may
        pass
    try:
        import fitz

        with fitz.open(stream=data, filetype="pdf") as doc:
            return doc.page_count
    except Exception:
        return None


def texts_of(data: bytes) -> list[str]:
    """The text of each page."""
    try:
        import fitz

        with fitz.open(stream=data, filetype="pdf") as doc:
            return [page.get_text("text") or "" for page in doc]
    except ImportError:
        from pypdf import PdfReader

        return [page.extract_text() or "" for page in PdfReader(io.BytesIO(data)).pages]


def picture_of(data: bytes, page: int, dpi: int) -> bytes:
    import fitz

    with fitz.open(stream=data, filetype="pdf") as doc:
        if not 1 <= page <= doc.page_count:
            raise ValueError(f"page {page} out of range 1..{doc.page_count}")
        return doc.load_page(page - 1).get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72), alpha=False).tobytes("png")


@F.pandas_udf(LongType())
def page_count(content: pd.Series) -> pd.Series:
    """Pages of a PDF file's bytes; null where no library can tell."""
    return content.map(count_of).astype("Int64")


def page_texts(files: DataFrame) -> DataFrame:
    """doc_id, page, pdf_text, error, of files (doc_id, content): one row a page, or one with the error of a file that can't be read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for doc_id, data in zip(frame["doc_id"], frame["content"], strict=True):
                try:
                    rows = [(doc_id, k, text, None) for k, text in enumerate(texts_of(data), 1)]
                except Exception as error:
                    rows = [(doc_id, None, None, str(error))]
                yield pd.DataFrame(rows, columns=["doc_id", "page", "pdf_text", "error"]).astype({"page": "Int32"})

    return files.select("doc_id", "content").mapInPandas(read, "doc_id long, page int, pdf_text string, error string")


def page_pictures(files: DataFrame, pages: DataFrame, dpi: int = 180) -> DataFrame:
    """doc_id, page, image of the given pages (doc_id, page); a page that a file hasn't got is an error."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            frame["image"] = [picture_of(data, int(page), dpi) for data, page in zip(frame["content"], frame["page"], strict=True)]
            yield frame[["doc_id", "page", "image"]]

    return files.select("doc_id", "content").join(pages.select("doc_id", "page"), "doc_id").mapInPandas(draw, "doc_id long, page int, image binary")
