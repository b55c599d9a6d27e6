"""Exact deduplication against a history of digests held behind a minimal perfect hash.

History: the distinct SHA-256 digests of texts seen earlier, dealt to buckets by digest. Each bucket
stores a minimal perfect hash (levels of bit vectors: a key takes the first level at which it alone
hits its bit; its slot is the number of bits set before) and, slot by slot, the full digest and the
locator of the winner (its doc_id) with the number of copies. A lookup goes to one slot and compares all 32 bytes:
members are repeats of the historical text; nonmembers are grouped among themselves.

Copies are merged (map side first) before any of this, so a text that fills a third of the rows is
one row per task. The table of decisions is joined back with `join_groups`, which stands hot digests.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import NULL_ID
from .common import join_groups, scratch, utf8
from .textmath import MIX1, U, mix

GAMMA = 2  # bits of a level for each key that is left


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the 32-byte digest of each text; null counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(utf8(text_col), 256)).alias("digest"))


def _positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = np.full(len(keys), level + 1, np.uint64) * MIX1
    for k in range(4):
        h = mix(h ^ keys[:, k])
    return (h % U(size)).astype(np.int64)


def build_mph(keys: np.ndarray) -> list[np.ndarray]:
    """Levels (bit arrays) of a minimal perfect hash over distinct 32-byte keys, as uint64 (n, 4)."""
    levels, left = [], np.arange(len(keys))
    while len(left):
        size = -(-max(GAMMA * len(left), 64) // 8) * 8
        at = _positions(keys[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def find_slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot each key would have; -1 if it hits no bit. Only a byte check tells members."""
    slot, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
    for k, bits in enumerate(levels):
        at = _positions(keys[left], k, len(bits))
        hit = bits[at]
        slot[left[hit]] = base + (np.cumsum(bits) - 1)[at[hit]]
        left, base = left[~hit], base + int(bits.sum())
    return slot


def _keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, 4)


def _ids(column: pd.Series) -> np.ndarray:
    return column.fillna(NULL_ID).to_numpy(np.int64) if column.isna().any() else column.to_numpy(np.int64)


INDEX_SCHEMA = "bucket long, levels array<binary>, digests binary, winners binary, copies binary"


def _index(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = _keys(pdf["digest"])
    levels = build_mph(keys)
    slot = find_slots(levels, keys)
    table, winners, copies = np.empty_like(keys), np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    table[slot], winners[slot], copies[slot] = keys, _ids(pdf["winner"]), pdf["copies"].to_numpy(np.int64)
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "levels": [[np.packbits(x).tobytes() for x in levels]], "digests": [table.tobytes()],
                         "winners": [winners.tobytes()], "copies": [copies.tobytes()]})


def _merged(rows: DataFrame, buckets: int) -> DataFrame:
    return (rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("copies"))
            .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("long")))


def history_index(rows: DataFrame, buckets: int) -> DataFrame:
    """The index over (doc_id, digest) rows: one stored row per bucket."""
    return _merged(rows, buckets).groupBy("bucket").applyInPandas(_index, INDEX_SCHEMA)


def _decide(index: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    """All digests of a bucket, historical or new: who stays and how many copies there are."""
    if len(index):
        row = index.iloc[0]
        table, levels = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4), [np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in row["levels"]]
        winners, copies = np.frombuffer(row["winners"], np.int64).copy(), np.frombuffer(row["copies"], np.int64).copy()
    else:
        table, levels, winners, copies = np.zeros((0, 4), np.uint64), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = _keys(batch["digest"]) if len(batch) else np.zeros((0, 4), np.uint64)
    slot = find_slots(levels, keys)
    member = slot >= 0
    member[member] = (table[slot[member]] == keys[member]).all(axis=1)
    new_winners, new_copies = (_ids(batch["winner"]), batch["copies"].to_numpy(np.int64)) if len(batch) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    at = slot[member]
    winners[at] = np.maximum(winners[at], new_winners[member])
    copies[at] += new_copies[member]
    raw = table.tobytes() + keys[~member].tobytes()
    ids = pd.Series(np.concatenate([winners, new_winners[~member]]), dtype="Int64")
    return pd.DataFrame({"digest": [raw[k:k + 32] for k in range(0, len(raw), 32)], "keep_id": ids.mask(ids == NULL_ID),
                         "group_size": np.concatenate([copies, new_copies[~member]]), "in_history": np.arange(len(ids)) < len(table)})


def exact_dedup(history: DataFrame, batch: DataFrame, digests_per_bucket: int = 1 << 15) -> DataFrame:
    """Decide every row of ``history`` and ``batch`` (both doc_id, digest).

    Of rows with equal digests the largest doc_id stays. Result: doc_id, digest, keep_id, group_size,
    kept, in_history. doc_id is a row's identity: rows that repeat both id and text share one
    decision. Rows without an id never win; a group of such rows only has a null keep_id and all its rows kept.
    Empty tables give an empty result. Buckets follow the row counts, so a bucket's arrays stay small."""
    n = max(history.count(), batch.count())
    buckets = max(1, -(-n // digests_per_bucket))
    index = scratch(history_index(history, buckets), "mph")
    decided = index.groupBy("bucket").cogroup(_merged(batch, buckets).groupBy("bucket")).applyInPandas(
        _decide, "digest binary, keep_id long, group_size long, in_history boolean")
    rows = history.unionByName(batch)
    return join_groups(rows, scratch(decided, "decided"), "digest", "group_size").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
