"""Sharding by longest-processing-time scheduling of groups that must stay together.

Groups are the documents of equal text. The scheduler's list must not grow with the corpus: groups
of at least 1/4096 of all bytes (fewer than 4096 by counting) are items of their own, all others
fall by digest into a fixed number of bundles, each an item. Items sorted by size, largest first, go to the
least-loaded shard through a heap. Every row then finds its shard in two small broadcast tables, without a
shuffle; only digests, sizes and ids are ever moved.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, scratch, utf8

BUNDLES = 1 << 14
HEAVY = 4096


def schedule(items: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Shard of each (size, name): longest first, to the least-loaded shard (the lowest of several)."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, s = heapq.heappop(heap)
        out[name] = s
        heapq.heappush(heap, (load + size, s))
    return out


def sized(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with _digest (of the text), _size (UTF-8 bytes + 1) and _bundle."""
    raw = utf8("text")
    out = docs.withColumn("_digest", F.unhex(F.sha2(raw, 256))).withColumn("_size", (F.length(raw) + 1).cast("long"))
    return out.withColumn("_bundle", F.pmod(F.xxhash64("_digest"), F.lit(BUNDLES)).cast("int"))


def assign(rows: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` to ``rows`` (of ``sized``); ``sizes`` holds the _digest, _size, _bundle of all rows, stored."""
    spark = rows.sparkSession
    groups = scratch(sizes.groupBy("_digest", "_bundle").agg(F.sum("_size").alias("_total")), "groups")
    total = groups.agg(F.sum("_total")).first()[0] or 0
    heavy = F.col("_total") * HEAVY >= F.lit(int(total))
    big = [(r["_total"], bytes(r["_digest"])) for r in groups.where(heavy).collect()]  # at most HEAVY rows
    light = [(r["t"], int(r["_bundle"])) for r in groups.where(~heavy).groupBy("_bundle").agg(F.sum("_total").alias("t")).collect()]  # at most BUNDLES rows
    place = schedule([*big, *light], shards)
    own = spark.createDataFrame([(bytearray(k), s) for k, s in place.items() if isinstance(k, bytes)], "_digest binary, _own int")
    rest = spark.createDataFrame([(k, s) for k, s in place.items() if isinstance(k, int)], "_bundle int, _rest int")
    return (rows.join(F.broadcast(own), "_digest", "left").join(F.broadcast(rest), "_bundle", "left")
            .withColumn("shard", F.coalesce("_own", "_rest")).drop("_own", "_rest"))


def shard_table(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document; equal texts share a shard, shard sizes are near equal.

    size: UTF-8 bytes + 1; a null text counts as empty. slot runs from 0 without gaps in each shard, by id inside hash buckets.
    Repeated rows and null ids are rows like others. Empty tables give no rows. Other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = sized(rows).withColumn("text_crc32", F.crc32(utf8("text"))).drop("text")
    rows = scratch(rows, "sizes")
    out = assign(rows, rows, shards)
    return numbered(out, "shard", ["doc_id", "_digest"], "slot", rows.count()).select("doc_id", F.col("_size").alias("size"), "text_crc32", "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """All columns of ``docs`` with ``shard`` (a column of that name gives way), without a shuffle of the texts."""
    rows = sized(docs)
    sizes = scratch(rows.select("_digest", "_size", "_bundle"), "sizes")
    out = assign(rows, sizes, shards)
    return out.select(*(c for c in docs.columns if c != "shard"), "shard")
