"""Substring deduplication with fixed-block anchors.

A repeat of ``window`` words contains, wherever it lies, a whole block of the reference document's
grid of non-overlapping blocks if a block has at most (window + 1) / 2 words. So:

1. anchors: every rolling window of ``block`` words probes the index of grid blocks. Chunks of
   documents send their distinct window hashes (32 bits inside the bucket, packed) with two flags: on the grid,
   in several documents of the chunk. A bucket answers which hashes are on some grid and in two places.
2. extension: around each anchor hit, all ``window``-word windows that hold the hit are compared by
   96 bits and more of hash over all documents: the smallest doc_id that starts the same words owns them.
   Consecutive windows with a smaller owner make up the maximal exact repeat; its words go.

A wrong hit of step 1 only adds work in step 2. No pairs of documents are made at any point: a passage
shared by m documents costs m entries, merged inside each chunk first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import NULL_ID, buckets_for, gather, rows_of, texts_of, with_answers
from .common import scratch
from .textmath import STEP_A, STEP_B, U, Words, bucket_of, pack, pack_sorted, rest_of, rolling, slices, unpack, unpack_sorted, window_starts

ON_GRID, IN_MANY = 1, 2
_SENT = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("keys", pa.binary()), ("more", pa.binary())])
SENT_SCHEMA = "bucket long, chunk_id long, keys binary, more binary"
ANSWER_SCHEMA = "chunk_id long, bucket long, blob binary"


def _low(h: np.ndarray, buckets: int) -> np.ndarray:
    """32 bits of the hash beyond the bucket, ascending with the hash."""
    return (rest_of(h, buckets) >> U(32)).astype(np.uint32)


def _anchor_probes(block: int, buckets: int):
    def run(batches):
        for row in rows_of(batches):
            _, texts = texts_of(row)
            w = Words(texts)
            at = window_starts(w.first, block)
            if not len(at):
                continue
            h, doc = rolling(w.hash, block, STEP_A)[at], w.doc[at]
            grid = (at - w.first[doc]) % block == 0
            order = np.lexsort((doc, h))
            h, doc, grid = h[order], doc[order], grid[order]
            head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            flags = np.maximum.reduceat(grid, head) * ON_GRID + (np.maximum.reduceat(doc, head) != doc[head]) * IN_MANY
            h, flags = h[head], flags.astype(np.uint8)
            cols = [[], [], [], []]
            for b, lo, hi in slices(h, buckets):
                for col, v in zip(cols, (b, row["chunk_id"], pack_sorted(_low(h[lo:hi], buckets)), pack(flags[lo:hi]))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SENT)], schema=_SENT)
    return run


def _low_sorted(blob: bytes) -> np.ndarray:
    return unpack_sorted(blob, np.uint32)


def _anchor_answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """Hashes that lie on some grid and occur in two documents, for each chunk that sent them."""
    keys, flags = [_low_sorted(x) for x in pdf["keys"]], [unpack(x, np.uint8) for x in pdf["more"]]
    chunk = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
    key, flag = np.concatenate(keys), np.concatenate(flags)
    order = np.argsort(key, kind="stable")
    key, flag, chunk = key[order], flag[order], chunk[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(head, append=len(key))
    flags = np.bitwise_or.reduceat(flag, head)
    hit = np.repeat(((flags & ON_GRID) > 0) & ((size > 1) | ((flags & IN_MANY) > 0)), size)
    key, chunk = key[hit], chunk[hit]
    order = np.argsort(chunk, kind="stable")
    key, chunk = key[order], chunk[order]
    which, at = np.unique(chunk, return_index=True)
    blobs = [pack_sorted(key[a:b]) for a, b in zip(at, [*at[1:], len(key)])]
    return pd.DataFrame({"chunk_id": pdf["chunk_id"].to_numpy()[which], "bucket": pdf["bucket"].iloc[0], "blob": blobs})


class _Candidates:
    """The windows of a chunk that hold an anchor hit: position, two hashes, document."""

    def __init__(self, row: dict, window: int, block: int, buckets: int):
        self.ids, texts = texts_of(row)
        self.texts, self.words = texts, Words(texts)
        self.at = np.zeros(0, np.int64)
        hits = row["anchors"] or []
        if not hits:
            return
        known = np.sort(np.concatenate([(U(x["bucket"]) << U(32)) | _low_sorted(x["blob"]).astype(np.uint64) for x in hits]))
        w, wh = self.words, self.words.hash
        starts = window_starts(w.first, block)
        h = rolling(wh, block, STEP_A)[starts]
        key = (bucket_of(h, buckets) << U(32)) | _low(h, buckets).astype(np.uint64)
        hit = np.zeros(len(w) + 1, np.int64)
        found = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
        hit[starts[found] + 1] = 1
        hits_before = np.cumsum(hit)  # hits at positions below the index
        at = window_starts(w.first, window)
        at = at[hits_before[at + window - block + 1] > hits_before[at]] if len(at) else at
        self.at, self.doc = at, w.doc[at]
        self.h1, self.h2 = (rolling(wh, window, s)[at] for s in (STEP_A, STEP_B))
        order = np.lexsort((self.ids[self.doc], self.h2, self.h1))
        h1, h2 = self.h1[order], self.h2[order]
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]) if len(at) else np.zeros(0, bool)
        head = np.flatnonzero(new)
        self.group = np.empty(len(at), np.int64)  # of each window, its distinct pair of hashes
        self.group[order] = np.cumsum(new) - 1
        self.g1, self.g2 = h1[head], h2[head]
        ids = np.where(self.ids == NULL_ID, np.iinfo(np.int64).max, self.ids)[self.doc[order]]
        self.owner = np.minimum.reduceat(ids, head) if len(head) else np.zeros(0, np.int64)


def _window_probes(window: int, block: int, buckets: int):
    def run(batches):
        for row in rows_of(batches):
            c = _Candidates(row, window, block, buckets)
            if not len(c.at):
                continue
            cols = [[], [], [], []]
            for b, lo, hi in slices(c.g1, buckets):
                low = _low(c.g1[lo:hi], buckets)
                more = pack(c.g2[lo:hi]), pack(c.owner[lo:hi])
                for col, v in zip(cols, (b, row["chunk_id"], pack_sorted(low), len(more[0]).to_bytes(8, "little") + more[0] + more[1])):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, _SENT)], schema=_SENT)
    return run


def _window_answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk: the places in its list of windows whose owner is smaller elsewhere, and that owner."""
    low, high, owner = [], [], []
    for keys, more in zip(pdf["keys"], pdf["more"]):
        n = int.from_bytes(more[:8], "little")
        low.append(_low_sorted(keys))
        high.append(unpack(more[8:8 + n], np.uint64))
        owner.append(unpack(more[8 + n:], np.int64))
    size = [len(x) for x in low]
    chunk, place = np.repeat(np.arange(len(low)), size), np.concatenate([np.arange(n) for n in size])
    low, high, owner = np.concatenate(low), np.concatenate(high), np.concatenate(owner)
    order = np.lexsort((high, low))
    l, h = low[order], high[order]
    head = np.flatnonzero(np.concatenate([[True], (l[1:] != l[:-1]) | (h[1:] != h[:-1])]))
    least = np.repeat(np.minimum.reduceat(owner[order], head), np.diff(head, append=len(l)))
    best = np.empty_like(owner)
    best[order] = least
    less = np.flatnonzero(best < owner)
    chunk, place, best = chunk[less], place[less], best[less]
    which, at = np.unique(chunk, return_index=True)
    blobs = []
    for a, b in zip(at, [*at[1:], len(chunk)]):
        places = pack_sorted(place[a:b].astype(np.uint32))
        blobs.append(len(places).to_bytes(8, "little") + places + pack(best[a:b]))
    return pd.DataFrame({"chunk_id": pdf["chunk_id"].to_numpy()[which], "bucket": pdf["bucket"].iloc[0], "blob": blobs})


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept_text", pa.string())])
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept_text string"


def _cut(window: int, block: int, buckets: int):
    def run(batches):
        for row in rows_of(batches):
            c = _Candidates(row, window, block, buckets)
            gone = np.zeros(len(c.words) + 1, np.int64)
            if len(c.at):
                owner = c.owner.copy()
                first = {b: lo for b, lo, _ in slices(c.g1, buckets)}
                for x in row["owners"] or []:
                    n = int.from_bytes(x["blob"][:8], "little")
                    owner[first[x["bucket"]] + unpack_sorted(x["blob"][8:8 + n], np.uint32).astype(np.int64)] = unpack(x["blob"][8 + n:], np.int64)
                mine = c.ids[c.doc]
                repeat = c.at[(owner[c.group] < mine) & (mine != NULL_ID)]
                np.add.at(gone, repeat, 1)
                np.add.at(gone, repeat + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            out = [[], [], [], [], []]
            for k, (i, text) in enumerate(zip(c.ids, c.texts)):
                cut = gone[c.words.first[k]:c.words.first[k + 1]]
                words, spans = text.split(), []
                if cut.any():
                    words = [x for x, g in zip(words, cut) if not g]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
                    spans = edge.reshape(-1, 2).tolist()
                for col, v in zip(out, (None if i == NULL_ID else int(i), len(cut), int(cut.sum()), spans, b" ".join(words).decode("utf-8", "replace"))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _OUT)], schema=_OUT)
    return run


def substring_dedup(docs: DataFrame, window: int = 50, block: int = 25, chunk_bytes: int = 4 << 20, bytes_per_bucket: int = 12 << 20) -> DataFrame:
    """Remove each word covered by a window whose words also start in a document with a smaller doc_id.

    ``docs``: doc_id, text (other columns are ignored). Words are runs of other bytes than space and
    0x09-0x0D, unchanged; windows are judged on the input and lie in one document. Result, one row per
    document: doc_id, n_words, n_removed, spans (word ranges [from, to) removed), kept_text (kept words
    joined by one space). A null text has no words. A document without an id neither loses words nor owns any.
    Rows that repeat a doc_id count as one document's id: neither is smaller, so neither loses words to the other.
    Very long texts form a chunk of their own; fewer than ``window`` words are kept whole."""
    if not 1 <= block <= (window + 1) // 2:
        raise ValueError("a block may have at most (window + 1) / 2 words, else a repeat can miss the grid")
    chunks = gather(docs, chunk_bytes)
    buckets = buckets_for(chunks, bytes_per_bucket)
    sent = chunks.mapInArrow(_anchor_probes(block, buckets), SENT_SCHEMA)
    anchors = scratch(sent.groupBy("bucket").applyInPandas(_anchor_answers, ANSWER_SCHEMA), "anchors")
    found = with_answers(chunks, anchors, "anchors")
    sent = found.where(F.col("anchors").isNotNull()).mapInArrow(_window_probes(window, block, buckets), SENT_SCHEMA)
    owners = scratch(sent.groupBy("bucket").applyInPandas(_window_answers, ANSWER_SCHEMA), "owners")
    return with_answers(found, owners, "owners").mapInArrow(_cut(window, block, buckets), OUT_SCHEMA)
