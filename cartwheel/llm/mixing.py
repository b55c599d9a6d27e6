"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations.

Each source is a task with weight a / A (integer parts of the target). Its j-th block is released at floor(j A / a)
and due by ceil((j + 1) A / a); earliest deadline first among the released blocks meets all deadlines on one
output, so after any number of slots every source is less than one block from its share. Release times and
deadlines repeat after A slots. The driver therefore makes the schedule of one period only (A is
bounded, whatever the corpus); the slot of a block follows by arithmetic. Documents are numbered inside
their source in hash buckets, so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered

MAX_PARTS = 100_000


def period(parts: dict[str, int]) -> list[tuple[str, int]]:
    """(source, number of its block in the period) of each slot of one period."""
    total = sum(parts.values())
    releases: list[list[tuple[int, str, int]]] = [[] for _ in range(total)]
    for source, a in parts.items():
        for j in range(a):
            releases[j * total // a].append((-(-(j + 1) * total // a), source, j))
    ready: list[tuple[int, str, int]] = []
    out = []
    for due in releases:
        for block in due:
            heapq.heappush(ready, block)
        _, source, j = heapq.heappop(ready)
        out.append((source, j))
    return out


def smoothed_parts(counts: dict[str, int], power: float = 0.9, total: int = 10_000) -> dict[str, int]:
    """Integer parts near count ** power, at least 1 each: large sources give way to small ones."""
    raw = {s: n ** power for s, n in counts.items()}
    whole = sum(raw.values())
    parts = {s: max(1, round(total * x / whole)) for s, x in raw.items()}
    shared = math.gcd(*parts.values()) if parts else 1
    return {s: a // shared for s, a in parts.items()}


PLACED = ("block", "epoch", "slot", "place")


def mix(docs: DataFrame, parts: dict[str, int] | None = None, block_rows: int = 32, power: float = 0.9) -> DataFrame:
    """Interleave whole blocks of the sources in the proportion of ``parts`` (source -> integer weight).

    Without ``parts`` the weights are ``smoothed_parts`` of the row counts. The mix ends when every source has
    been read through once; a source that ends earlier starts again (``epoch`` 1, 2, ...), so no row is dropped and
    the proportions hold to the end. Result: all columns of ``docs`` with block, epoch, slot (of the block), place (in
    the block). A null source counts as the empty name. Each source present needs a weight; weights of absent
    sources are ignored. Repeated rows are rows like others. An empty table gives no rows.
    The number of sources is bounded by the weights' sum (at most 100,000)."""
    out = _placed(docs, parts, block_rows, power)
    return out.select(*(c for c in docs.columns if c not in PLACED), *(F.col(f"_{c}").alias(c) for c in PLACED))


def mixed_documents(docs: DataFrame, parts: dict[str, int] | None = None, block_rows: int = 32, power: float = 0.9) -> DataFrame:
    """The columns of ``docs`` only, rows in the order of the mix (see ``mix``): written files follow the schedule."""
    out = _placed(docs, parts, block_rows, power)
    return out.repartitionByRange("_slot").sortWithinPartitions("_slot", "_place").select(*docs.columns)


def _placed(docs: DataFrame, parts: dict[str, int] | None, block_rows: int, power: float) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.withColumn("_source", F.coalesce(F.col("source"), F.lit("")))
    found = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).limit(MAX_PARTS + 1).collect()
    counts = {r["_source"]: r["n"] for r in found}
    weights = smoothed_parts(counts, power) if parts is None else {s: parts[s] for s in counts if parts.get(s, 0) > 0}
    if missing := sorted(set(counts) - set(weights)):
        raise ValueError(f"sources without a positive weight: {missing[:5]}")
    if sum(weights.values()) > MAX_PARTS or len(counts) > MAX_PARTS:
        raise ValueError(f"weights may sum to {MAX_PARTS} at most")
    cycle = sum(weights.values())
    plan = period(weights)
    slot_of = {key: t for t, key in enumerate(plan)}
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    end = max(((b - 1) // weights[s] * cycle + slot_of[s, (b - 1) % weights[s]] + 1 for s, b in blocks.items()), default=0)
    # the period as a table: one string, taken apart by Spark
    names = sorted(counts)
    code = {s: k for k, s in enumerate(names)}
    text = ",".join(f"{code[s]}:{j}:{t}" for t, (s, j) in enumerate(plan))
    cell = F.split(F.col("cell"), ":")
    table = spark.range(1 if plan else 0).select(F.explode(F.split(F.lit(text), ",")).alias("cell")).select(
        cell[0].cast("int").alias("_code"), cell[1].cast("long").alias("_j"), cell[2].cast("long").alias("_t"))
    facts = spark.range(1 if names else 0).select(F.explode(F.from_json(F.lit(_facts(names, blocks, weights)), "array<struct<s:string,c:int,b:long,a:long>>")).alias("f")).select("f.*")
    facts = facts.select(F.col("s").alias("_source"), F.col("c").alias("_code"), F.col("b").alias("_blocks"), F.col("a").alias("_a"))
    n_rows = sum(counts.values())
    placed = numbered(rows, "_source", ["doc_id"], "_i", n_rows)
    placed = placed.join(F.broadcast(facts), "_source")
    placed = placed.withColumn("_block", F.expr(f"_i div {block_rows}")).withColumn("_place", F.col("_i") % block_rows)
    rounds = F.expr(f"cast(({end} div {max(cycle, 1)} + 1) * _a div _blocks + 1 as int)")  # no less than its epochs
    placed = placed.withColumn("_epoch", F.explode(F.sequence(F.lit(0), rounds))).withColumn("_q", F.col("_block") + F.col("_epoch") * F.col("_blocks"))
    placed = placed.withColumn("_j", F.expr("_q % _a")).join(F.broadcast(table), ["_code", "_j"])
    placed = placed.withColumn("_slot", F.expr(f"(_q div _a) * {cycle}L + _t")).where(F.col("_slot") < end)
    return placed


def _facts(names: list[str], blocks: dict[str, int], weights: dict[str, int]) -> str:
    import json

    return json.dumps([{"s": s, "c": k, "b": blocks[s], "a": weights[s]} for k, s in enumerate(names)])
