"""Documents gathered into chunks of a few MB of text, stored once, and an exchange of packed word
or window hashes between chunks and hash buckets.

Row-by-row shuffles of every word of a corpus cost tens of bytes a word. A chunk instead sends each
bucket one row: its distinct hashes in ascending order, packed. What the bucket answers goes back by
chunk id in the same way. Inside a chunk repeats are merged before the shuffle, so a passage or word
that a third of all documents share adds one entry per chunk, not one per occurrence.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .textmath import expand, squeeze

#: Stands for a null id inside packed arrays; smaller than any other id.
NULL_ID = -(1 << 63)
CHUNK_SCHEMA = "chunk_id long, n_docs int, ids binary, sizes binary, n_bytes long, data binary"
_ARROW = pa.schema([("chunk_id", pa.int64()), ("n_docs", pa.int32()), ("ids", pa.binary()), ("sizes", pa.binary()), ("n_bytes", pa.int64()), ("data", pa.binary())])


def _gather(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = [int.from_bytes(os.urandom(7), "little"), len(ids), np.array(ids, np.int64).tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(), size, squeeze(b"".join(texts))]
            ids.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if ids and size + len(text) > chunk_bytes:
                        yield close()
                        size = 0
                    ids.append(NULL_ID if i is None else i)
                    texts.append(text)
                    size += len(text)
        if ids:
            yield close()
    return run


def gather(docs: DataFrame, chunk_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store ``docs`` as chunks of whole documents, ``chunk_bytes`` of text each (one document if longer).

    The random chunk ids are part of the stored rows, so later retries see the same ids."""
    from .common import utf8

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("data"))
    return scratch(rows.mapInArrow(_gather(chunk_bytes), CHUNK_SCHEMA), "chunks")


def texts_of(row: dict) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a chunk's row."""
    ids, sizes, data = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64), expand(row["data"])
    at = np.concatenate([[0], np.cumsum(sizes)])
    return ids, [data[a:b] for a, b in zip(at[:-1], at[1:])]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, so one chunk is in memory unpacked."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def with_answers(chunks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Chunks with ``name``: the list of (bucket, blob) that the buckets sent to this chunk."""
    got = answers.groupBy("chunk_id").agg(F.collect_list(F.struct("bucket", "blob")).alias(name))
    return chunks.join(got, "chunk_id", "left")


def buckets_for(chunks: DataFrame, bytes_per_bucket: int = 12 << 20) -> int:
    """Number of buckets: one for each ``bytes_per_bucket`` of text, from the stored chunk sizes."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, -(-int(total) // bytes_per_bucket))
