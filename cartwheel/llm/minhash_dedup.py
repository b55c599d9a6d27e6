"""Near-duplicate components by MinHash with tensored banding, confirmed on full shingle sets.

Tensored banding: two small collections of groups of minhashes, U and V. A table key is a pair
(u_i, v_j), so g + g groups give g * g tables; ordinary banding would compute 2 * r * g * g minhashes, here
2 * r * g are enough. Two sets of Jaccard similarity s share a key with 1 - (1 - s^r)^g, squared;
``groups_for`` takes as many groups as bring the loss at the threshold under a bound (1e-5).
Pairing happens only between groups that occur in two different sets, which few do.

Sets, not documents, are compared: documents with equal sets are one class. In each key the classes
are linked through pivots, not all with all: the member with most company is compared with all
others; who proves similar joins its component. A key whose members are in one component is
done. For classes in keys left with several components a sketch is counted: by hash bin, the shingles that another
open class has, too. The lesser counts of all bins bound what two sets can have in common; members of a key are
compared by these bounds in blocks, and only pairs that can be similar come out. So no link is lost by the
pivots. Links are confirmed exactly (integers: 100 * common >= percent * united) on the full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, scratch, shuffled, utf8
from .textmath import MIX1, STEP_A, STEP_B, U, Words, mix

PIECE = 2 << 20  # bytes of text worked on at once


def groups_for(similarity: float, rows: int, loss: float = 1e-5) -> int:
    """Groups in each collection so that a pair at the threshold is missed with at most ``loss``."""
    return math.ceil(math.log(loss / 2) / math.log(1 - similarity ** rows))


def _sequence_hash(h: np.ndarray) -> np.ndarray:
    out = np.full(1, len(h), np.uint64)
    for x in h:
        out = out * STEP_B + x
    return mix(out)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, in one array, and where each text's begin."""
    w = Words(texts, lower=True)
    n = np.diff(w.first)
    h = w.hash
    whole = (n > 0) & (n < k)
    at = np.flatnonzero(np.repeat(n, n) - (np.arange(len(h)) - np.repeat(w.first[:-1], n)) >= k)
    s = np.zeros(len(at), np.uint64)
    for j in range(k):
        s = s * STEP_A + h[at + j]
    doc, s = w.doc[at], mix(s)
    if whole.any():  # fewer than k words: the whole sequence is one shingle
        short = np.flatnonzero(whole)
        one = np.concatenate([_sequence_hash(h[w.first[d]:w.first[d + 1]]) for d in short])
        doc, s = np.concatenate([doc, short]), np.concatenate([s, one])
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])]) if len(s) else np.zeros(0, bool)
    doc, s = doc[new], s[new]
    return s, np.searchsorted(doc, np.arange(len(texts) + 1))


def _minhashes(s: np.ndarray, first: np.ndarray, count: int, seed: int) -> np.ndarray:
    """(count, sets): the least value of each set under each of ``count`` hash functions; sets must not be empty."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.empty((count, len(first) - 1), np.uint64)
    for j, (a, b) in enumerate(rng.integers(0, 2**64, (count, 2), dtype=np.uint64)):
        out[j] = np.minimum.reduceat((s ^ b) * (a | U(1)), first[:-1])
    return out


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("halves", pa.list_(pa.int64()))])
SIGNED_SCHEMA = "doc_id long, n_shingles long, set_key binary, halves array<long>"
SET_SCHEMA = "doc_id long, set_key binary, shingles array<long>"
_SET = pa.schema([("doc_id", pa.int64()), ("set_key", pa.binary()), ("shingles", pa.list_(pa.int64()))])


def pieces(batches, piece: int = PIECE):
    """Bounded lists of (ids, texts)."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if ids and size + len(t) > piece:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield ids, texts


def _set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sign(k: int, rows: int, groups: int, seed: int):
    def run(batches):
        for ids, texts in pieces(batches):
            s, first = shingle_sets(texts, k)
            size = np.diff(first)
            full = np.flatnonzero(size)
            halves = np.zeros((2 * groups, len(ids)), np.uint64)
            if len(full):
                m = _minhashes(s, np.append(first[:-1][full], len(s)), 2 * groups * rows, seed)
                for j in range(2 * groups):
                    v = np.full(len(full), j + 1, np.uint64) * MIX1
                    for x in m[j * rows:(j + 1) * rows]:
                        v = mix(v ^ x)
                    halves[j, full] = v
            keys = [_set_key(s[a:b]) if b > a else None for a, b in zip(first[:-1], first[1:])]
            lists = [x if n else None for x, n in zip(halves.T.copy().view(np.int64).tolist(), size)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, size, keys, lists), _SIGNED)], schema=_SIGNED)
    return run


def _sets(k: int):
    def run(batches):
        for ids, texts in pieces(batches):
            s, first = shingle_sets(texts, k)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(s.view(np.int64)))
            keys = [_set_key(s[a:b]) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), lists.cast(_SET[2].type)], schema=_SET)
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each other node of the edges (a, b) is connected with (the least itself is not listed).

    Large-star and small-star steps until nothing changes. Each is an aggregation, merged before its
    shuffle, and a join; a node with very many neighbours is a skewed join key, which AQE splits."""
    e = scratch(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(shuffled(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(shuffled(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        e = scratch(small.where("a <> b").distinct(), "star")
    return e.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node")


class Linker:
    """Finds the components of classes (ck, of size n) that share keys: ``members`` holds key, ck, n.

    ``fits(n, m)`` is a bound from the sizes; ``similar(pairs)`` keeps the pairs (a, b) that are truly linked. Optional:
    ``sketch(classes)`` gives (ck, s, x) for the classes left open by the first pivots, and ``promising(rows)`` from them the pairs
    (a, b) of different labels that can be linked at all; ``hopeful`` tells which classes can be linked with any other.
    ``coarse`` (key, ck, n) are keys of which two classes share one whenever they share one of ``members``, but fewer: the
    sketches are compared in these, so that a pair meets a few times, not in each of its many common keys."""

    def __init__(self, members: DataFrame, fits: Callable, similar: Callable[[DataFrame], DataFrame], sketch: Callable[[DataFrame], DataFrame] | None = None,
                 promising: Callable[[DataFrame], DataFrame] | None = None, hopeful: str = "true", coarse: DataFrame | None = None):
        self.members, self.fits, self.similar = members, fits, similar
        self.sketch, self.promising, self.hopeful, self.coarse = sketch, promising, hopeful, coarse
        self.sketched = False
        self.edges: list[DataFrame] = []
        self.labels: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.labels is None:
            return rows.withColumn("label", F.col("ck"))
        known = self.labels.select(F.col("node").alias("ck"), "label")
        return rows.join(shuffled(known), "ck", "left").withColumn("label", F.coalesce("label", "ck"))

    def open_rows(self) -> DataFrame:
        """Members of the keys that still hold several components."""
        rows = self.labelled(self.members)
        keys = rows.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key")
        return rows.join(shuffled(keys), "key", "left_semi")

    def verify(self, pairs: DataFrame) -> None:
        """Take over the pairs that are linked."""
        self.edges.append(scratch(self.similar(pairs), "links"))
        every = self.edges[0]
        for e in self.edges[1:]:
            every = every.unionByName(e)
        self.labels = scratch(components(every), "labels")

    def run(self, pairs_per_row: int = 4) -> None:
        """Link until no key holds two components that could still be joined. First each key's pivot meets its other members;
        then the sketches tell which pairs are worth a look. Without sketches there are further pivots until at most
        ``pairs_per_row`` pairs are left for each row of ``members``, which are then all compared."""
        n = self.members.count()
        while True:
            rows = scratch(self.open_rows(), "open")
            sizes = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("q"))
            left = sizes.agg(F.sum((F.col("t") * F.col("t") - F.col("q")) / 2)).first()[0] or 0
            if not left:
                return
            if self.sketched:
                return self.verify(self.promising(rows))
            if self.sketch is None and left <= pairs_per_row * n:
                return self.verify(self.between(rows))
            pivots = scratch(self.pivots(rows), "pivots")
            pairs = rows.join(shuffled(pivots), "key").where((F.col("ck") != F.col("b")) & (F.col("label") != F.col("lb")) & self.fits(F.col("n"), F.col("m")))
            self.verify(pairs.select(F.least("ck", "b").alias("a"), F.greatest("ck", "b").alias("b")).distinct())
            # a pivot has met all others of its key; it has no more to find there
            rest = rows.select("key", "ck", "n").join(shuffled(pivots.select("key", F.col("b").alias("ck"))), ["key", "ck"], "left_anti")
            self.members = scratch(rest, "members")
            if self.sketch is not None:
                own = scratch(self.sketch(self.open_rows().select("ck").distinct()), "sketches")
                self.members = scratch(self.coarse.join(shuffled(own), "ck").where(self.hopeful), "members")
                self.sketched = True

    def pivots(self, rows: DataFrame) -> DataFrame:
        """Of each key, the member with most company in all its keys."""
        company = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
        weight = rows.join(shuffled(company), "key").groupBy("ck").agg(F.sum("c").alias("w"))
        best = rows.join(shuffled(weight), "ck").groupBy("key").agg(F.max(F.struct("w", "ck", "n", "label")).alias("p"))
        return best.select("key", F.col("p.ck").alias("b"), F.col("p.n").alias("m"), F.col("p.label").alias("lb"))

    def between(self, rows: DataFrame) -> DataFrame:
        """The pairs of a key in different components that the sizes leave."""
        other = rows.select("key", F.col("ck").alias("b"), F.col("n").alias("m"), F.col("label").alias("lb"))
        pairs = rows.join(shuffled(other), "key").where((F.col("ck") < F.col("b")) & (F.col("label") != F.col("lb")) & self.fits(F.col("n"), F.col("m")))
        return pairs.select(F.col("ck").alias("a"), "b").distinct()


BINS = 48
BLOCK = 1024  # members of a key that are compared with as many others in one step


def _bins(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """ck, s, x: number of those shingles of each of the classes that any other of them has, too, in all and by hash bin (packed)."""
    shingles = sets.join(shuffled(classes), "ck", "left_semi").select("ck", F.explode("shingles").alias("s"))
    once = shingles.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("ck").alias("ck")).where("c = 1")
    signed = shingles.withColumn("w", F.lit(1)).unionByName(once.select("ck", "s", F.lit(-1).alias("w"))).withColumn("bin", F.pmod("s", F.lit(BINS)))
    counts = [F.coalesce(F.sum(F.when(F.col("bin") == k, F.col("w"))), F.lit(0)).alias(f"b{k}") for k in range(BINS)]
    digits = F.concat(*(F.lpad(F.hex(f"b{k}"), 8, "0") for k in range(BINS)))
    return signed.groupBy("ck").agg(F.sum("w").alias("s"), *counts).select("ck", "s", F.unhex(digits).alias("x"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with the group they are compared in: small keys many to a group, a key of more than BLOCK members split into
    blocks, each pair of blocks a group. ``side`` is -1 where all members of a key meet, else the block."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    small = F.pmod(F.xxhash64("key"), F.lit(rows.count() // (16 * BLOCK) + 1))
    n = rows.join(shuffled(sizes), "key").withColumn("nb", F.expr(f"cast((c + {BLOCK} - 1) div {BLOCK} as int)")).withColumn("side", F.pmod(F.xxhash64("ck"), F.col("nb")).cast("int"))
    single = n.where("nb = 1").select(small.cast("string").alias("g"), F.lit(0).alias("p"), F.lit(0).alias("q"), "key", F.lit(-1).alias("side"), "ck", "n", "label", "s", "x")
    split = n.where("nb > 1").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    split = split.select(F.concat(F.lit("k"), F.col("key").cast("string")).alias("g"), F.least("side", "o").alias("p"), F.greatest("side", "o").alias("q"), "key", "side", "ck", "n", "label", "s", "x")
    return single.unionByName(split)


def pairs_in_blocks(rows: DataFrame, quick: Callable, close: Callable, bins: int) -> DataFrame:
    """Distinct pairs (a, b) of ``rows`` (key, ck, n, label, s, x) that share a key, differ in label and pass two bounds.

    ``quick(n, s, m, t)`` is given whole rows against columns of numbers, ``close(n, x, m, y)`` the pairs that pass it, with
    their sketches of ``bins`` counts."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        ck, label = pdf["ck"].to_numpy(), pd.factorize(pdf["label"])[0]
        n, s, side = (pdf[c].to_numpy(np.int64) for c in ("n", "s", "side"))
        x = np.frombuffer(b"".join(pdf["x"]), ">u4").reshape(-1, bins).astype(np.int64)
        mixed = pdf["p"].iloc[0] != pdf["q"].iloc[0]
        at = np.flatnonzero(np.concatenate([[True], np.diff(pdf["key"].to_numpy()) != 0]))
        found = set()
        for lo, hi in zip(at, [*at[1:], len(pdf)]):
            for a in range(lo, hi, 256):
                i, j = np.arange(a, min(a + 256, hi)), np.arange(lo, hi)
                ok = (label[i][:, None] != label[j]) & quick(n[i][:, None], s[i][:, None], n[j], s[j])
                ok &= side[i][:, None] < side[j] if mixed else i[:, None] < j
                u, v = np.nonzero(ok)
                u, v = i[u], j[v]
                for part in np.array_split(np.arange(len(u)), len(u) // 65536 + 1):
                    k, m = u[part], v[part]
                    hit = close(n[k], x[k], n[m], x[m])
                    found.update((min(ck[y], ck[z]), max(ck[y], ck[z])) for y, z in zip(k[hit], m[hit]))
        return pd.DataFrame(list(found), columns=["a", "b"])

    kind = rows.schema["ck"].dataType.simpleString()
    return _blocks(rows).groupBy("g", "p", "q").applyInPandas(run, f"a {kind}, b {kind}").distinct()


def _can_share(percent: int):
    """Bounds of two sets: at most the lesser count of their shared elements, and of each bin, can be common."""
    def quick(n, s, m, t):
        common = np.minimum(s, t)
        return 100 * common >= percent * (n + m - common)

    def close(n, x, m, y):
        common = np.minimum(x, y).sum(1)
        return 100 * common >= percent * (n + m - common)
    return quick, close


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    left = sets.select(F.col("ck").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("ck").alias("b"), F.col("shingles").alias("sb"))
    tested = pairs.join(shuffled(left), "a").join(shuffled(right), "b").withColumn("c", F.size(F.array_intersect("sa", "sb")))
    return tested.where(100 * F.col("c") >= percent * (F.size("sa") + F.size("sb") - F.col("c"))).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, rows: int = 2, groups: int | None = None, seed: int = 7) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    Words are lower-cased (A-Z); a set holds the distinct ``shingle``-word shingles, of fewer words the
    whole sequence as one. Result, one row per document: doc_id, n_shingles, component_id (least doc_id
    reachable, itself included), kept (doc_id = component_id). Null, empty and blank texts have no
    shingles and are linked with nothing; neither are rows without an id (component null, kept).
    Rows that repeat an id and a text share their result. Columns beyond doc_id and text are ignored."""
    groups = groups or groups_for(percent / 100, rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("data"))
    signed = scratch(texts.mapInArrow(_sign(shingle, rows, groups, seed), SIGNED_SCHEMA), "signed")
    grouped = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch(grouped.groupBy(F.col("set_key").alias("ck")).agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("size")), "classes")
    half = classes.select("ck", "n", F.posexplode("halves").alias("slot", "half"))
    shared = half.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    sides = scratch(half.join(shuffled(shared), "half", "left_semi").groupBy("ck", "n").agg(
        F.collect_list(F.when(F.col("slot") < groups, F.col("half"))).alias("u"), F.collect_list(F.when(F.col("slot") >= groups, F.col("half"))).alias("v")), "halves")
    coarse = sides.select("ck", "n", F.explode("u").alias("key"), "v")
    keyed = coarse.select("ck", "n", F.col("key").alias("u"), F.explode("v").alias("v")).select(F.xxhash64("u", "v").alias("key"), "ck", "n")
    pairable = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    members = scratch(keyed.join(shuffled(pairable), "key", "left_semi"), "members")
    wanted = members.select("ck").distinct().join(shuffled(classes.select("ck", "rep")), "ck")
    wanted = scratch(wanted, "wanted")
    mine = texts.join(shuffled(wanted.select(F.col("rep").alias("doc_id")).distinct()), "doc_id", "left_semi").mapInArrow(_sets(shingle), SET_SCHEMA)
    sets = mine.join(shuffled(wanted.select(F.col("ck").alias("set_key"), F.col("rep").alias("doc_id"))), ["set_key", "doc_id"], "left_semi")
    sets = scratch(sets.dropDuplicates(["set_key"]).select(F.col("set_key").alias("ck"), "shingles"), "sets")
    linker = Linker(members, lambda n, m: 100 * F.least(n, m) >= percent * F.greatest(n, m), lambda pairs: _similar(pairs, sets, percent), lambda classes: _bins(classes, sets),
                    lambda rows: pairs_in_blocks(rows, *_can_share(percent), BINS), f"100 * s >= {percent} * n", coarse.select("key", "ck", "n"))
    linker.run()
    labelled = linker.labelled(classes.select("ck", "rep", "size"))
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    decided = scratch(labelled.join(shuffled(least), "label").select(F.col("ck").alias("set_key"), "component_id", "size"), "components")
    linked = join_groups(grouped.select("doc_id", "n_shingles", "set_key"), decided, "set_key", "size").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """All columns of the documents that stay, one of each component (see ``near_duplicates``)."""
    gone = near_duplicates(docs, **options).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(shuffled(gone), docs["doc_id"] == gone["_gone"], "left_anti")
