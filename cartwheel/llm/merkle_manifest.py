"""Merkle manifest of a dataset: a tree over its rows, one subtree for each language.

While a parent's hash is built, the hash state before each child slot is copied and kept. To fold a replaced child
into its parent, the state before its slot is resumed with the replacement and the siblings to its right; what stands to the
left is already in the state and is not hashed again.

Leaves are put in order by ranges, numbered without gaps inside their language, and cut into blocks of ``fan ** depth``
consecutive leaves. A task builds the subtree of one block; the blocks' roots are the nodes of the next round, so a
language with a third of all rows is as many blocks as it needs, and a round has 1/1024 of the nodes of the one before. What a block needs of the
tree above it (the siblings on its way to the root) comes back by joins, and its leaves are folded in one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import NULL_ID, rows_of
from .common import id_crc, join_groups, scratch

FAN, DEPTH = 2, 10  # children of a node; levels that one task builds
STEPS = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(n_chars: Column) -> Column:
    """Digest of a row of ``documents`` with this ``n_chars``."""
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return F.sha2(F.concat(*map(_field, fields)), 256)


def leaves(docs: DataFrame, tamper_mod: int = 7) -> DataFrame:
    """key (orders by language, null first), doc_id, leaf, changed (leaf of the tampered row; null where nothing is tampered with)."""
    n = F.col("n_chars").cast("long")
    more = (n.cast("decimal(20,0)") + 1).cast("string")  # one more than the largest long, too
    hit = (id_crc("doc_id") % tamper_mod == 0) & n.isNotNull()
    key = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    return docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), leaf(n).alias("leaf"), F.when(hit, leaf(more)).alias("changed"))


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Stored ``rows`` with place (0, 1, ... inside each ``key`` by ``order``, without gaps) and n (rows of the key)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = rows.repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order).withColumn("_at", F.monotonically_increasing_id())
    run = scratch(run, label).withColumn("_part", F.shiftright("_at", 33))
    # one row for each key in each range; a key's rows of one range are consecutive
    ranges = run.groupBy(F.col("key").alias("_key"), F.col("_part").alias("_range")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy("_key")
    before = F.coalesce(F.sum("_rows").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("_before", before).withColumn("n", F.sum("_rows").over(own))
    out = run.join(ranges, (F.col("key") == F.col("_key")) & (F.col("_part") == F.col("_range")))
    return out.withColumn("place", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_key", "_range", "_first", "_rows", "_before")


def levels_to_root(n: int, fan: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // fan), out + 1
    return out


class Block:
    """Subtree over consecutive nodes. ``levels[k]``: the nodes k levels up (hex digests as bytes); ``states[k][i]``: the hash
    state of node i's parent just before node i was added."""

    def __init__(self, nodes: list[bytes], levels: int, fan: int):
        self.fan, self.levels, self.states = fan, [nodes], []
        for _ in range(levels):
            up, kept = [], []
            for at in range(0, len(nodes), fan):
                h = hashlib.sha256()
                for child in nodes[at:at + fan]:
                    kept.append(h.copy())
                    h.update(child)
                up.append(h.hexdigest().encode())
            nodes = up
            self.levels.append(up)
            self.states.append(kept)

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def steps(self, i: int):
        """(siblings to the left, siblings to the right) of node i and of each node above it, joined."""
        for nodes in self.levels[:-1]:
            run = i - i % self.fan
            yield b"".join(nodes[run:i]), b"".join(nodes[i + 1:run + self.fan])
            i //= self.fan

    def fold(self, i: int, digest: bytes) -> bytes:
        """The subtree's root if node i were ``digest``."""
        for nodes, kept in zip(self.levels, self.states):
            h = kept[i].copy()
            h.update(digest)
            for right in nodes[i + 1:i - i % self.fan + self.fan]:
                h.update(right)
            digest, i = h.hexdigest().encode(), i // self.fan
        return digest


def _digests(column) -> list[bytes]:
    return [x.encode() for x in column.to_pylist()]


def _pack(fan: int, depth: int):
    """One row for a block of leaves."""
    schema = pa.schema([("key", pa.string()), ("place", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("ids", pa.list_(pa.int64())), ("leaves", pa.list_(pa.string())), ("changed", pa.list_(pa.string()))])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n, place = table["n"][0].as_py(), table["place"][0].as_py() // fan ** depth
        block = Block(_digests(table["leaf"]), min(depth, levels_to_root(n, fan)), fan)
        row = {"key": table["key"][0].as_py(), "place": place, "n": n, "digest": block.root.decode(), "ids": table["doc_id"].to_pylist(), "leaves": table["leaf"].to_pylist(), "changed": table["changed"].to_pylist()}
        return pa.Table.from_pylist([row], schema=schema)
    return run


PACKED = "key string, place long, n long, digest string, ids array<long>, leaves array<string>, changed array<string>"


def _paths(fan: int, depth: int):
    """The nodes of a block with their ways to its root."""
    schema = pa.schema([("key", pa.string()), ("place", pa.int64()), ("n", pa.int64()), ("steps", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))), ("root", pa.string())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n = table["n"][0].as_py()
        block = Block(_digests(table["digest"]), min(depth, levels_to_root(n, fan)), fan)
        steps = [[{"left": a.decode(), "right": b.decode()} for a, b in block.steps(i)] for i in range(table.num_rows)]
        return pa.table([table["key"], table["place"], table["n"], pa.array(steps, schema.field("steps").type), pa.array([block.root.decode()] * table.num_rows)], schema=schema)
    return run


def climb(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """key, place, steps (siblings on the way to the key's root, nearest first), root for ``nodes`` (stored; key, place, n, digest).

    Each round builds ``depth`` levels; there are log n / (depth * log fan) rounds."""
    done = nodes.where("n <= 1").select("key", "place", F.array().cast(STEPS).alias("steps"), F.col("digest").alias("root"))
    many = nodes.where("n > 1")
    if many.isEmpty():
        return done
    up = F.expr(f"place div {fan ** depth}")
    own = scratch(many.groupBy("key", up.alias("_block")).applyInArrow(_paths(fan, depth), f"key string, place long, n long, steps {STEPS}, root string"), "paths")
    above = own.groupBy("key", up.alias("place")).agg(F.expr(f"first((n + {fan ** depth - 1}) div {fan ** depth})").alias("n"), F.first("root").alias("digest"))
    above = climb(scratch(above, "nodes"), fan, depth).select("key", F.col("place").alias("_up"), F.col("steps").alias("_more"), F.col("root").alias("_root"))
    own = own.withColumn("_up", up).join(above, ["key", "_up"]).select("key", "place", F.concat("steps", "_more").alias("steps"), F.col("_root").alias("root"))
    return own.unionByName(done)


_OUT = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])
OUT_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _fold(fan: int, depth: int):
    def run(batches):
        for row in rows_of(batches):
            nodes = [x.encode() for x in row["leaves"]]
            block = Block(nodes, min(depth, levels_to_root(row["n"], fan)), fan)
            above = []
            for step in row["steps"]:
                h = hashlib.sha256()
                h.update(step["left"].encode())
                above.append((h, step["right"].encode()))  # the state before the slot that leads to this block
            tail = "".join(s["left"] + s["right"] for s in row["steps"]).encode()
            tops: dict[bytes, str] = {}
            proofs, roots = [], []
            for i, changed in enumerate(row["changed"]):
                proof = hashlib.sha256()
                for left, right in block.steps(i):
                    proof.update(left)
                    proof.update(right)
                proof.update(tail)
                proofs.append(proof.hexdigest())
                top = block.fold(i, nodes[i] if changed is None else changed.encode())
                if top not in tops:
                    digest = top
                    for state, right in above:
                        h = state.copy()
                        h.update(digest)
                        h.update(right)
                        digest = h.hexdigest().encode()
                    tops[top] = digest.decode()
                roots.append(tops[top])
            k = len(nodes)
            cols = (row["ids"], row["leaves"], [row["subroot"]] * k, [row["root"]] * k, proofs, roots, [x == row["root"] for x in roots])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)
    return run


def merkle_manifest(docs: DataFrame, fan: int = FAN, depth: int = DEPTH, tamper_mod: int = 7) -> DataFrame:
    """Tree over all rows of ``docs`` (doc_id, source, lang, n_chars, text), with a proof and a folding check for each row.

    A leaf is the digest of a row's fields. Inside a language leaves stand by doc_id (null first), rows that repeat an id by
    their leaf; every ``fan`` consecutive nodes have a parent until one is left, the subroot. Subroots, by language (null first), make
    the root in the same way. Result, one row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256 (digest of all siblings on the way to
    the root; of nothing if there are none), folded_root, verified (folded_root is root). Rows whose crc32(doc_id as text) is
    divisible by ``tamper_mod`` are folded with n_chars + 1 in place of n_chars, all others as they are; a null id or a null
    n_chars is never tampered with. Empty and very long texts are hashed whole, in the scan; equal rows are leaves of their own. An empty
    table has no rows. Other columns are ignored."""
    rows = placed(scratch(leaves(docs, tamper_mod), "leaves"), ["doc_id", "leaf"], "ordered")
    span = F.expr(f"place div {fan ** depth}")
    blocks = scratch(rows.groupBy("key", span.alias("_block")).applyInArrow(_pack(fan, depth), PACKED), "blocks")
    width = fan ** depth
    nodes = blocks.select("key", "place", F.expr(f"(n + {width - 1}) div {width}").alias("n"), "digest")
    paths = scratch(climb(nodes, fan, depth), "ways")
    subroots = paths.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first("root").alias("digest"))
    tops = placed(subroots.select(F.lit("").alias("key"), F.col("key").alias("lang_key"), "digest", "size"), ["lang_key"], "subroots")
    tops = scratch(tops, "tops")
    whole = climb(tops.select("key", "place", "n", "digest"), fan, depth).select("place", F.col("steps").alias("top_steps"), F.col("root").alias("whole"))
    tops = scratch(tops.join(whole, "place").select(F.col("lang_key").alias("key"), "size", "top_steps", "whole"), "languages")
    ways = join_groups(paths, tops, "key", "size").select(
        F.col("key").alias("_key"), F.col("place").alias("_place"), F.concat("steps", "top_steps").alias("steps"), F.col("root").alias("subroot"), F.col("whole").alias("root"))
    found = blocks.drop("digest").join(ways, (F.col("key") == F.col("_key")) & (F.col("place") == F.col("_place")))
    return found.select("n", "ids", "leaves", "changed", "steps", "subroot", "root").mapInArrow(_fold(fan, depth), OUT_SCHEMA)
