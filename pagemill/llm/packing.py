"""Packing: concatenate and cut.

All token streams are taken as one, in the order in which they are read, and cut every ``seq_len`` ids.
Only the last sequence can be short.  Two passes:

1. each task encodes its documents and writes their ids with the number of ids before them in the task;
2. prefix sums over the tasks' totals (one row a task) turn those into global offsets; fixed windows cut
   each document where it crosses a multiple of ``seq_len``.  The cuts are the boundary records: a
   document's pieces, each with its sequence and its place there.

Nothing is shuffled but one total a task.  The encoded table is written once to the shared folder, so a
task that is run again writes the same offsets and the passes can't disagree.

Defined results: a null or empty text is its end id alone; null doc_ids are packed like others; repeated
rows are packed each; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize
from .tokens import default_path, encoder, text_parts

SEQ_LEN = 2048
END_ID = 1


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", specials_as_text: bool = False) -> DataFrame:
    """part, before (ids before it in its part), doc_id, n_tokens, ids (little-endian, 2 bytes each if they all fit, else 4)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(tokenizer, specials_as_text), TaskContext.get().partitionId(), 0
        kind = "<u2" if max(enc.vocab - 1, end_id) < 1 << 16 else "<u4"
        for batch in batches:
            for _, rows, texts in text_parts(batch):
                ids = enc.encode([t or "" for t in texts], end_id)
                count = np.fromiter(map(len, ids), np.int64, len(ids))
                starts = before + np.cumsum(count) - count
                before += int(count.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int64)), pa.array(starts), rows.column(0), pa.array(count), pa.array([i.astype(kind).tobytes() for i in ids], pa.binary())],
                    ["part", "before", "doc_id", "n_tokens", "ids"],
                )

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(encode, "part long, before long, doc_id long, n_tokens long, ids binary")


def pack(
    docs: DataFrame,
    seq_len: int = SEQ_LEN,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    specials_as_text: bool = False,
) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and its ids, if asked)."""
    written = materialize(encoded(docs, tokenizer or default_path(), end_id, id_col, text_col, specials_as_text), "encoded")
    totals = written.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    # one row a task of the first pass
    based = written.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("position"), "n_tokens", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc_id, position, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(position + start, seq_len)
                    length = min(n - start, seq_len - offset)
                    piece = ids[start : start + length].tobytes()
                    for column, value in zip(out, (doc_id, start, length, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None), strict=True):
                        column.append(value)
                    start += length
            arrays = [pa.array(c, pa.int64()) for c in out[:7]] + [pa.array(out[7], pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(arrays))])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return based.mapInArrow(cut, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row a sequence: sequence_id, n_tokens, ids, and its boundary records.  At most ``seq_len`` pieces meet."""
    records = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), records.alias("records"))
    joined = F.aggregate("records", F.lit(b""), lambda a, r: F.concat(a, r["ids"]))
    bounds = F.transform("records", lambda r: F.struct(r["offset"].alias("offset"), r["length"].alias("length"), r["doc_id"].alias("doc_id"), r["start"].alias("start")))
    return whole.select("sequence_id", "n_tokens", joined.alias("ids"), bounds.alias("boundaries"))
