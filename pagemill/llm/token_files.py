"""Token-id files in the Arrow stream-file format, and reading them back.

Documents are dealt by ranges of doc_id, so the files in the order of their numbers hold all ids in
ascending doc_id order.  A part's ids stand one after the other in sequences of ``seq_len``; only a part's
last sequence is padded.  A part is two files:

* ``*.tokens.arrow``: batches of ``BATCH`` rows, ``ids: fixed_size_list<uint16|uint32>[seq_len]`` and
  ``mask: fixed_size_list<bool>[seq_len]`` (false: padding).  Row k is row ``k % BATCH`` of batch
  ``k // BATCH``; mapped into memory, nothing is copied or decoded on the way to it;
* ``*.docs.arrow``: doc_id, start (ids before it in this part) and n_tokens.

Files are written through ``pyarrow.fs`` to the shared folder's own file system, under names that no other
attempt of a task uses.  The manifest has a row for each part that a successful task has reported; files of
lost attempts are in no manifest and so are never read.

Defined results: a null or empty text is its end id alone; null doc_ids come first; documents of one
doc_id stand in an order of their texts' hashes; an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, new_path
from .tokens import default_path, encoder, text_parts

SEQ_LEN = 2048
END_ID = 2
BATCH = 256


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that ``pyarrow.fs`` opens."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = str(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(jpath).toString())
    scheme, _, rest = uri.partition(":")
    return {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ("://" + rest if not rest.startswith("//") else ":" + rest)


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Appends ids to a tokens file."""

    def __init__(self, sink, seq_len: int, wide: bool):
        self.seq_len, self.kind = seq_len, np.dtype("<u4" if wide else "<u2")
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.kind), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.room = np.zeros(BATCH * seq_len, self.kind)
        self.held = self.n_tokens = self.n_sequences = 0

    def append(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, len(self.room) - self.held)
            self.room[self.held : self.held + n] = ids[at : at + n]
            self.held, at, self.n_tokens = self.held + n, at + n, self.n_tokens + n
            if self.held == len(self.room):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.held // self.seq_len)
        if not rows:
            return
        ids, mask = self.room[: rows * self.seq_len], np.ones(rows * self.seq_len, bool)
        ids[self.held :], mask[self.held :] = 0, False
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        self.n_sequences, self.held = self.n_sequences + rows, 0

    def close(self) -> None:
        self._flush()
        self.writer.close()


class Sequences:
    """Random access to a tokens file."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def batch(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self._at, self._batch = k, self.reader.get_batch(k)
        return self._batch

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``k``: its ids, a view into the file, and its mask."""
        row = self.batch(k // BATCH).slice(k % BATCH, 1)
        return row.column(0).flatten().to_numpy(), row.column(1).flatten().to_numpy(zero_copy_only=False)

    def chunks(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids from ``start`` on, ``n`` of them, in runs that don't cross a batch."""
        size = BATCH * self.seq_len
        while n > 0:
            k, at = divmod(start, size)
            run = self.batch(k).column(0).flatten().to_numpy()[at : at + n]
            yield run
            start, n = start + len(run), n - len(run)


def write_token_files(
    docs: DataFrame,
    path: str | None = None,
    seq_len: int = SEQ_LEN,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    specials_as_text: bool = False,
) -> DataFrame:
    """Writes all documents; the manifest: part, tokens_file, docs_file, n_docs, n_tokens, n_sequences, base."""
    spark = docs.sparkSession
    folder, tokenizer = qualified(spark, path or new_path(spark, "token-files")), tokenizer or default_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        enc, part = encoder(tokenizer, specials_as_text), TaskContext.get().partitionId()
        fs, root = file_system(folder)
        fs.create_dir(root)
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        index = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        n_docs = 0
        with fs.open_output_stream(f"{root}/{name}.tokens.arrow") as tokens, fs.open_output_stream(f"{root}/{name}.docs.arrow") as listed:
            out = SequenceWriter(tokens, seq_len, wide=max(enc.vocab - 1, end_id) >= 1 << 16)
            with pa.ipc.new_file(listed, index) as documents:
                for batch in _chain(first, batches):
                    for _, rows, texts in text_parts(batch):
                        ids = enc.encode([t or "" for t in texts], end_id)
                        count = np.fromiter(map(len, ids), np.int64, len(ids))
                        documents.write_batch(pa.RecordBatch.from_arrays([rows.column(0), pa.array(out.n_tokens + np.cumsum(count) - count), pa.array(count)], schema=index))
                        for i in ids:
                            out.append(i)
                        n_docs += len(texts)
            out.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "tokens_file": [f"{folder}/{name}.tokens.arrow"], "docs_file": [f"{folder}/{name}.docs.arrow"], "n_docs": [n_docs], "n_tokens": [out.n_tokens], "n_sequences": [out.n_sequences]})

    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # the hash parts documents that share a doc_id, and the last key rows that share their text, too
    keys = ["doc_id", "h", "m"]
    ordered = rows.withColumns({"h": F.xxhash64("text"), "m": F.monotonically_increasing_id()}).repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    reported = materialize(ordered.mapInArrow(write, "part long, tokens_file string, docs_file string, n_docs long, n_tokens long, n_sequences long"), "token-manifest")
    # one row a file
    return reported.withColumn("base", F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                tokens = Sequences(part["tokens_file"])
                fs, path = file_system(part["docs_file"])
                with fs.open_input_file(path) as f:
                    index = pa.ipc.open_file(f)
                    for k in range(index.num_record_batches):
                        docs = index.get_batch(k)
                        crc = []
                        for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist(), strict=True):
                            c = 0
                            for run in tokens.chunks(start, n):
                                c = zlib.crc32(run.astype("<u4").tobytes(), c)
                            crc.append(c)
                        start = pa.array(docs.column(1).to_numpy() + part["base"])
                        yield pa.RecordBatch.from_arrays([docs.column(0), start, docs.column(2), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _chain(first, rest):
    yield first
    yield from rest
