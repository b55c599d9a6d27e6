"""Item-item collaborative filtering (Sarwar et al. 2001; Deshpande and Karypis 2004).

similarity   sim(i, j) = sum_u w_ui w_uj / (||i|| ||j||)      (cosine; binary w gives c_ij / sqrt(d_i d_j))
neighbours   the K most similar items of every item
score(u, i)  = sum over items j owned by u with i among the K neighbours of j of w_uj * sim(j, i)

Neighbours at scale
-------------------
Items are dealt to groups by hash. A user's list of (item, weight) goes once to each group that one of the user's items is in; there all
similarities of the group's items are summed and only the K best of each are kept. What is shuffled are lists, no table of item pairs,
and nothing is sorted but the products of some items at a time. A user with more than ``block`` items is sent in
hash blocks, and an item with more than ``ITEM_ROWS`` buyers is summed in parts, user by user hash, whose sums are added.
Lists are sent for some groups at a time (waves), so the shuffle files of all groups never lie on disk together.

Co-occurrence at scale
----------------------
The dot products come from a self-join of the matrix on the user. A user with m items contributes
m(m-1)/2 products, so a single hot user could otherwise swamp one task. The items of a user with more than
``block`` of them are split into ``ceil(m / block)`` hash blocks; both copies are expanded to the block pairs they take part
in, and the join key is (user, block_a, block_b) with block_a <= block_b, so one join key never holds
more than about ``block`` x ``block`` products and the work of a hot user spreads over many tasks. Products are summed per item pair with map-side
partial aggregation before the shuffle on the pair. Nothing is capped or sampled: every
co-occurrence counts.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import SCORE_DECIMALS, top_n
from ..functions.skew import salted_join
from ..session import stored

# Fixed value: largest number of a user's items in one block of the co-occurrence join.
DEFAULT_BLOCK = 512


# Products of a group of items, and of the items whose products are sorted at a time.
GROUP_PRODUCTS, CHUNK_PRODUCTS = 4_000_000, 2_000_000
# Rows of an item that are summed in one group; an item with more is summed in parts.
ITEM_ROWS = 50_000
# Groups of a small matrix, for several tasks to share.
LEAST_GROUPS = 32

# A wave sends about this many copies of the matrix; its shuffle files are gone before the next.
WAVE_COPIES = 8

# Products of owned items and neighbours in a wave of users, and the most waves.
WAVE_ROWS, MOST_WAVES = 50_000_000, 8
# Hash of users to waves beside the hash that deals rows to tasks.
WAVE_SEED = 7

# Items of a user whose products one task may sum; with longer histories the pairs are dealt by user and item.
OWNED_ROWS = 20_000

# Heavy-user tables up to this many rows are broadcast; larger ones are shuffle-joined.
HEAVY_BROADCAST_ROWS = 1_000_000


def _blocked(mat: DataFrame, key: str, other: str, block: int) -> DataFrame:
    """Add ``_nb`` (block count of the row's key) and ``_blk`` (its block).

    Only keys with more than ``block`` items need splitting. Their count is bounded by
    rows / block; it is checked, and the table is broadcast when small, so the matrix itself is
    not shuffled for this step.
    """
    deg = mat.groupBy(key).agg(F.count(F.lit(1)).alias("_deg"))
    heavy = deg.filter(F.col("_deg") > block).select(
        key, F.ceil(F.col("_deg") / F.lit(block)).cast("int").alias("_hb"))
    n_heavy = heavy.count()
    if n_heavy == 0:
        return mat.withColumn("_nb", F.lit(1)).withColumn("_blk", F.lit(0))  # no column _heavy: nothing to split
    heavy = F.broadcast(heavy) if n_heavy <= HEAVY_BROADCAST_ROWS else heavy
    m = mat.join(heavy, key, "left").withColumn("_nb", F.coalesce("_hb", F.lit(1))).drop("_hb")
    return m.withColumn("_blk", F.pmod(F.xxhash64(other), F.col("_nb")).cast("int")).withColumn("_heavy", F.lit(True))


def blocked_pairs(mat: DataFrame, key: str = "user_id", other: str = "item_id",
                  weight: str = "weight", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``a, b, p`` with a < b: one product weight_a * weight_b for each ``key`` they share.

    Keys of up to ``block`` rows are joined on the key alone; only the rows of heavier keys are copied
    to the block pairs they take part in."""
    m = _blocked(mat.select(key, other, weight), key, other, block)
    left = m.select(key, F.col(other).alias("a"), F.col(weight).alias("wa"), "_nb", "_blk")
    right = m.select(key, F.col(other).alias("b"), F.col(weight).alias("wb"), "_nb", "_blk")
    product = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("wa") * F.col("wb")).alias("p"))
    light = left.filter("_nb = 1").join(right.filter("_nb = 1").select(key, "b", "wb"), key).filter(F.col("a") < F.col("b")).select(*product)
    if "_heavy" not in m.columns:
        return light
    # left copy: an item of block x meets every block y >= x; right copy: an item of block y meets every x <= y
    x = left.filter("_nb > 1").withColumn("by", F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1))).withColumnRenamed("_blk", "bx")
    y = right.filter("_nb > 1").withColumn("bx", F.explode(F.sequence(F.lit(0), F.col("_blk")))).withColumnRenamed("_blk", "by")
    # same block: keep a < b once; different blocks: each unordered pair meets exactly once
    heavy = x.join(y.select(key, "b", "wb", "bx", "by"), [key, "bx", "by"]).filter((F.col("bx") < F.col("by")) | (F.col("a") < F.col("b")))
    return light.unionByName(heavy.select(*product))


def cooccurrence(mat: DataFrame, key: str = "user_id", other: str = "item_id",
                 weight: str = "weight", block: int = DEFAULT_BLOCK) -> DataFrame:
    """``a, b, dot`` with a < b: sum over shared ``key`` of weight_a * weight_b."""
    return blocked_pairs(mat, key, other, weight, block).groupBy("a", "b").agg(F.sum("p").alias("dot"))


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position and length of each row's list, and the values of all of them."""
    arr = column.combine_chunks()
    arr = arr.chunk(0) if isinstance(arr, pa.ChunkedArray) else arr
    offsets = arr.offsets.to_numpy()
    return offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64), arr.values.to_numpy(zero_copy_only=False)


def _group_sims(k: int | None):
    """Similarities of a group's items with all items of their owners' lists: the ``k`` best of each, or all sums (None)."""
    def run(table: pa.Table) -> pa.Table:
        own_at, own_n, own_ids = _lists(table["own"])
        own_w = _lists(table["own_w"])[2]
        at, n, ids = _lists(table["ids"])
        ws = _lists(table["ws"])[2]
        row = np.repeat(np.arange(len(own_n)), own_n)  # lists of a table are packed: values lie in row order
        first = int(own_at[0]) if len(own_at) else 0
        a_all, wa_all = own_ids[first:first + len(row)], own_w[first:first + len(row)]
        order = np.argsort(a_all, kind="stable")
        a_all, wa_all, row = a_all[order], wa_all[order], row[order]
        names, start = np.unique(a_all, return_index=True)
        code = np.repeat(np.arange(len(names)), np.diff(np.append(start, len(a_all))))
        upto = np.append(0, np.cumsum(n[row]))
        outs, lo = [], 0
        while lo < len(names):  # whole items, some CHUNK_PRODUCTS at a time
            ends = upto[np.append(start[lo + 1:], len(a_all))]
            hi = lo + max(1, int(np.searchsorted(ends, upto[start[lo]] + CHUNK_PRODUCTS, "right")))
            e = slice(start[lo], start[hi] if hi < len(names) else len(a_all))
            lens, r = n[row[e]], row[e]
            total = int(lens.sum())
            pick = np.repeat(at[r] - (np.cumsum(lens) - lens), lens) + np.arange(total)
            b, c = ids[pick], np.repeat(code[e] - lo, lens)
            p = ws[pick] * np.repeat(wa_all[e], lens)
            keep = b != names[lo + c]
            b, c, p = b[keep], c[keep], p[keep]
            base, lo = names[lo:hi], hi
            if not len(b):
                continue
            least, span = int(b.min()), int(b.max()) - int(b.min()) + 1
            if span * (int(c.max()) + 1) < 2 ** 62:
                key = c * span + (b - least)
            else:
                span = len(uniq := np.unique(b))
                key = c * span + np.searchsorted(uniq, b)
            by = np.argsort(key)
            key = key[by]
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            b, c, s = b[by][cut], c[by][cut], np.add.reduceat(p[by], cut)
            if k is not None:
                best = np.lexsort((b, -np.round(s, SCORE_DECIMALS), c))
                place = np.arange(len(best)) - np.searchsorted(c[best], c[best])
                best = best[place < k]
                b, c, s = b[best], c[best], s[best]
            outs.append((base[c], b, s))
        cols = [np.concatenate([o[i] for o in outs]) if outs else np.zeros(0, t) for i, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table({"a": cols[0], "b": cols[1], "sim": cols[2]})
    return run


def cosine_neighbours(mat: DataFrame, k: int, key: str = "user_id", other: str = "item_id",
                      weight: str = "weight", block: int = DEFAULT_BLOCK,
                      out_id: str = "item_id", out_nb: str = "neighbour_id",
                      group_products: int = GROUP_PRODUCTS, item_rows: int = ITEM_ROWS, waves: int | None = None) -> DataFrame:
    """Top-k cosine neighbours of every ``other`` over the shared ``key``:
    ``<out_id>, <out_nb>, rank, sim``.

    Weights are divided by their column norm first (one join at matrix size), so the sums of
    products are the cosines. ``group_products``: products of a group; ``item_rows``: rows of an ``other`` summed in one part.
    ``waves``: parts of the groups whose lists are sent one after the other; by default each sends about ``WAVE_COPIES`` copies of the
    matrix and has ``LEAST_GROUPS`` groups or more. The driver gets counts only.
    """
    norms = mat.groupBy(other).agg(F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias("_norm"), F.count(F.lit(1)).alias("_rows"))
    unit = (mat.join(norms, other)
            .select(key, F.col(other).cast("long").alias("_i"), (F.col(weight) / F.col("_norm")).cast("double").alias("_w"), "_rows")
            .where(F.col(key).isNotNull()))
    size = F.col("_n").cast("double")
    stats = (mat.where(F.col(key).isNotNull() & F.col(other).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
             .agg(F.sum(size * size).alias("products"), F.sum(size).alias("rows"), F.max("_n").alias("longest")).first())
    hot = norms.where(F.col(other).isNotNull()).agg(F.max("_rows")).first()[0] or 0
    products = stats["products"] or 0.0
    groups = int(max(1, math.ceil(products / group_products), min(LEAST_GROUPS, products // 10_000)))
    if waves is None:
        waves = max(1, min(math.ceil(products / (WAVE_COPIES * max(stats["rows"] or 0.0, 1.0))), groups // LEAST_GROUPS))
    # groups of items that are summed in parts have negative numbers
    part = F.pmod(F.xxhash64(key), F.ceil(F.col("_rows") / F.lit(item_rows)).cast("long"))
    group = F.pmod(F.xxhash64("_i"), F.lit(groups)).cast("int")
    if hot > item_rows:
        group = F.when(F.col("_rows") > item_rows, -1 - F.pmod(F.xxhash64("_i", part), F.lit(groups)).cast("int")).otherwise(group)
    unit = unit.select(key, group.alias("_g"), "_i", "_w")
    entry = F.array_sort(F.collect_list(F.struct("_g", "_i", "_w")))
    runs = F.arrays_zip(F.col("_d").alias("g"), F.col("_s").alias("s"), F.concat(F.slice("_s", 2, F.size("_s")), F.array(F.size("_l") + 1)).alias("e"))

    def packed(rows: DataFrame) -> DataFrame:
        """A row for each group a list has items in, with the list's part ``own`` in that group."""
        rows = rows.withColumn("_gs", F.transform("_l", lambda x: x["_g"])).withColumn("_d", F.array_distinct("_gs"))
        rows = rows.withColumn("_s", F.transform("_d", lambda g: F.array_position("_gs", g).cast("int")))
        return rows.withColumn("_run", F.explode(runs)).withColumn("_own", F.slice("_l", F.col("_run.s"), F.col("_run.e") - F.col("_run.s")))

    ids, ws = (lambda c: F.transform(c, lambda x: x["_i"])), (lambda c: F.transform(c, lambda x: x["_w"]))
    columns = (F.col("_run.g").alias("_g"), ids("_own").alias("own"), ws("_own").alias("own_w"))
    keep = stored if waves > 1 else lambda df: df  # each wave reads the lists
    if (stats["longest"] or 0) <= block:
        sent = packed(keep(unit.groupBy(key).agg(entry.alias("_l")))).select(*columns, ids("_l").alias("ids"), ws("_l").alias("ws"))
    else:
        # blocks of a user's list meet the blocks of the same user
        m = _blocked(unit, key, "_i", block)
        lists = keep(m.groupBy(key, "_blk", "_nb").agg(entry.alias("_l")))
        to = packed(lists).withColumn("_to", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))).select(key, F.col("_to").alias("_blk"), *columns)
        sent = to.join(lists.select(key, "_blk", ids("_l").alias("ids"), ws("_l").alias("ws")), [key, "_blk"]).select("_g", "own", "own_w", "ids", "ws")
    dealt, few = math.ceil(groups / waves), int(mat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = lambda df: df.repartition(dealt, "_g") if dealt > few else df
    schema = "a long, b long, sim double"
    wave = lambda w: F.col("_g").between(w * dealt, (w + 1) * dealt - 1)
    some = [spread(sent.where(wave(w))).groupBy("_g").applyInArrow(_group_sims(k), schema) for w in range(waves)]
    sims = reduce(DataFrame.unionByName, [stored(s) for s in some] if waves > 1 else some)
    if hot > item_rows:
        parts = spread(sent.where("_g < 0")).groupBy("_g").applyInArrow(_group_sims(None), schema)
        sims = sims.unionByName(parts.groupBy("a", "b").agg(F.sum("sim").alias("sim")))
    typ = mat.schema[other].dataType
    return top_n(sims, k, by="a", score="sim", tie="b").select(F.col("a").cast(typ).alias(out_id), F.col("b").cast(typ).alias(out_nb), "rank", "sim")


def item_item_neighbours(weights: DataFrame, k: int = 20, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``item_id, neighbour_id, rank, sim`` from a ``user_id, item_id, weight`` matrix."""
    return cosine_neighbours(weights, k, "user_id", "item_id", "weight", block)


def item_item_scores(weights: DataFrame, neighbours: DataFrame, users: DataFrame | None = None,
                     exclude_seen: bool = True, restrict_to: DataFrame | None = None) -> DataFrame:
    """All candidate scores ``user_id, item_id, score`` (owned items x their neighbour lists).

    The owned side is joined to at most K neighbour rows per item, so the output is linear in the
    matrix size. A best-selling item is a hot join key: its rows are dealt to several tasks by user and
    its K neighbours copied to them (``salted_join``).
    """
    owned = weights.select("user_id", F.col("item_id").alias("src"), F.col("weight").alias("w"))
    if users is not None:
        owned = owned.join(users.select("user_id").distinct(), "user_id", "left_semi")
    nb = neighbours.select(F.col("item_id").alias("src"), F.col("neighbour_id").alias("item_id"), "sim")
    if restrict_to is not None:
        # only recommend items of the given set (e.g. the top popular items)
        nb = nb.join(restrict_to.select("item_id").distinct(), "item_id", "left_semi")
    rows = salted_join(owned, nb, "src", "user_id").select("user_id", "item_id", (F.col("w") * F.col("sim")).alias("_p"), F.lit(0).alias("_seen"))
    if exclude_seen:
        # bought items go the same way as the products and mark their pair
        seen = owned.select("user_id", F.col("src").alias("item_id"), F.lit(0.0).alias("_p"), F.lit(1).alias("_seen"))
        rows = rows.unionByName(seen.where("user_id IS NOT NULL AND item_id IS NOT NULL"))
    longest = owned.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if longest <= OWNED_ROWS:
        rows = rows.repartition("user_id")  # the sums and the lists of a user come out of one shuffle
    scores = rows.groupBy("user_id", "item_id").agg(F.sum("_p").alias("score"), F.max("_seen").alias("_seen"))
    return scores.where("_seen = 0").select("user_id", "item_id", "score")


def item_item_recs(weights: DataFrame, neighbours: DataFrame, n: int, users: DataFrame | None = None,
                   exclude_seen: bool = True, restrict_to: DataFrame | None = None, wave_rows: int = WAVE_ROWS) -> DataFrame:
    """Top-n item-item recommendations: ``user_id, item_id, rank, score``.

    Where lists are short beside the products they are chosen from (``owned items x K``), users are served in waves of about
    ``wave_rows`` products: only the lists of a wave stay on disk."""
    def lists(who: DataFrame | None, matrix: DataFrame) -> DataFrame:
        return top_n(item_item_scores(matrix, neighbours, who, exclude_seen, restrict_to), n).select("user_id", "item_id", "rank", "score")

    asked = weights if users is None else weights.join(users.select("user_id").distinct(), "user_id", "left_semi")
    waves, owned = 1, asked.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("users")).first()
    if (owned["rows"] or 0) > wave_rows // 100:
        per_item = neighbours.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        products = owned["rows"] * (per_item + 1)
        waves = max(1, min(MOST_WAVES, products // max(1, 4 * n * owned["users"]), math.ceil(products / wave_rows)))
    if waves == 1:
        return lists(users, weights)
    wave = F.pmod(F.xxhash64("user_id", F.lit(WAVE_SEED)), F.lit(waves))
    return reduce(DataFrame.unionByName, [stored(lists(users, weights.where(wave == w))) for w in range(waves)])
