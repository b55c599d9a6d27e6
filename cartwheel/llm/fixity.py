"""Merkle fixity audit of WARC replicas.

Records lie in volumes, ordered by offset. A leaf hashes a record's offset, length and the digest of its bytes; sixteen
neighbours make a node, which covers the offset range of its children, up to one root per volume, then
sixteen volumes a node, up to one root of the archive. Two replicas are compared from the root down: a level is read only below
nodes that differ, so sound branches cost nothing. All levels are stored tables; each node is an aggregation of
at most sixteen rows, merged by sorting on position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, utf8

FANOUT = 16
VOLUME_PAGES = 1024


def record_bytes(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC response record: header, payload, two line ends."""
    body = utf8(html)
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "utf-8"), body, F.encode(F.lit("\r\n\r\n"), "utf-8"))


def replica(pages: DataFrame, volume_pages: int = VOLUME_PAGES) -> DataFrame:
    """volume, page_id, record: the records of a page table; volumes of consecutive ids.

    Pages without an id go to volumes of their own (from 2^40), dealt by content."""
    record = record_bytes(F.col("page_id"), F.col("url"), F.col("html"))
    loose = (1 << 40) + F.pmod(F.xxhash64("url", "html"), F.lit(1024))
    volume = F.coalesce(F.expr(f"cast(floor(page_id / {volume_pages}) AS bigint)"), loose)
    return pages.select(volume.alias("volume"), F.col("page_id").cast("long").alias("page_id"), record.alias("record"))


def manifest(records: DataFrame, *carry: str) -> DataFrame:
    """volume, place, page_id, offset, length, digest of each record (and the ``carry`` columns); records of a volume in the
    order of page_id, then digest. Only fingerprints are moved, not records."""
    rows = records.select("volume", "page_id", F.length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"), *carry)
    order = Window.partitionBy("volume").orderBy("page_id", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("volume", (F.row_number().over(order) - 1).cast("long").alias("place"), "page_id",
                       F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "digest", *carry)


def seen_by(listed: DataFrame, records: DataFrame) -> DataFrame:
    """The manifest's places with the lengths and digests that a replica (volume, offset, record) has there.

    A lost or unreadable record (absent or null) has neither."""
    real = records.select("volume", "offset", F.length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    return listed.select("volume", "place", "offset").join(real, ["volume", "offset"], "left")


class Tree:
    """Stored levels of one replica, leaves first: volume, node, lo, hi, hash; ``up[k]``: the parent's volume and node from those of level k."""

    def __init__(self, listed: DataFrame, label: str):
        leaf = F.sha2(F.concat_ws("|", "offset", F.coalesce(F.col("length").cast("string"), F.lit("-")), F.coalesce("digest", F.lit("-"))), 256)
        level = listed.select("volume", F.col("place").alias("node"), F.col("offset").alias("lo"), (F.col("offset") + F.coalesce("length", F.lit(0))).alias("hi"), leaf.alias("hash"))
        self.levels, self.up = [scratch(level, f"{label}-0")], []
        while True:
            last_node, far_volume, count = self.levels[-1].agg(F.max("node"), F.max(F.abs("volume")), F.count(F.lit(1))).first()
            if count <= 1:
                break
            if last_node > 0:
                rule = ("volume", f"node div {FANOUT}")
            else:
                rule = (f"cast(floor(volume / {FANOUT}) as bigint)" if far_volume > FANOUT else "0L", "0L")
            self.up.append(rule)
            child = F.struct("volume", "node", "lo", "hi", "hash")
            grouped = self.levels[-1].select(F.expr(rule[0]).alias("v"), F.expr(rule[1]).alias("p"), child.alias("c")).groupBy("v", "p").agg(F.sort_array(F.collect_list("c")).alias("c"))
            text = F.expr("array_join(transform(c, x -> concat_ws('|', x.lo, x.hi, x.hash)), ';')")
            top = grouped.select(F.col("v").alias("volume"), F.col("p").alias("node"), F.array_min("c.lo").alias("lo"), F.array_max("c.hi").alias("hi"), F.sha2(text, 256).alias("hash"))
            self.levels.append(scratch(top, f"{label}-{len(self.levels)}"))


def audit(one: Tree, other: Tree) -> DataFrame:
    """volume, place of the leaves that differ, found from the roots down; only children of differing nodes are compared.

    Both trees must be of one manifest (same volumes and places), as replicas are. Equal roots give no rows; so do empty archives."""
    bad = None
    for k in range(len(one.levels) - 1, -1, -1):
        sides = [t.levels[k].select("volume", "node", F.col("hash").alias(name)) for t, name in ((one, "ha"), (other, "hb"))]
        if bad is not None:
            v, p = one.up[k]
            sides = [x.join(bad, (F.expr(v) == F.col("_v")) & (F.expr(p) == F.col("_p")), "left_semi") for x in sides]
        both = sides[0].join(sides[1], ["volume", "node"], "full_outer").where(~F.col("ha").eqNullSafe(F.col("hb")))
        found = scratch(both.select("volume", "node"), "bad")
        bad = found.select(F.col("volume").alias("_v"), F.col("node").alias("_p"))
    return found.withColumnRenamed("node", "place")
