"""Near-duplicate lines by a segment-partition edit-distance join.

A line within ``edits`` edits of another keeps at least one of the other's ``edits`` + 1 segments unchanged, shifted by few
places. So each distinct line is split into edits + 1 segments (the index) and probes, for each possible length
of the other line and each segment, the few substrings that the length difference and the number of errors left and
right of the segment allow. Index and probe keys of a piece of text go, packed, to hash buckets; a bucket
gives out only the keys that two different lines share. Candidates are verified by a banded
bit-parallel edit distance. Links make classes of lines through pivots, as in the near-duplicate operator; lines left
in keys of several classes are compared by counts of character pairs in blocks first, and only pairs whose counts
differ by no more than the edits explain are verified. The first line of each class stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, scratch, utf8
from .minhash_dedup import Linker, pairs_in_blocks, pieces
from .textmath import U, mix, pack, pack_sorted, rest_of, slices, unpack, unpack_sorted

MIN_CHARS = 20  # shorter lines are compared for equality only


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance of two strings is at most ``edits``.

    Common ends are cut off; then a bit vector holds the differences of vertical neighbours in the
    band of 2 * edits + 1 diagonals, and moves along the diagonal with each character of ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    lo, hi = 0, len(b)
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    cut = 0
    while cut < hi - lo and a[len(a) - 1 - cut] == b[hi - 1 - cut]:
        cut += 1
    a, b = a[lo:len(a) - cut], b[lo:hi - cut]
    m, n = len(a), len(b)
    if not n:
        return m <= edits
    if m <= edits:
        return True
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    # bit i of a vector in column j stands for row j + edits - (width - 1) + i: the top bit is the band's lowest diagonal
    width = 2 * edits + 2
    mask = (1 << width) - 1
    plus, minus, value = ((1 << (edits + 1)) - 1) << (width - edits - 1), 0, edits
    for j in range(1, n + 1):
        shift = j + edits - width
        eq = at.get(b[j - 1], 0)
        eq = (eq >> shift if shift >= 0 else eq << -shift) & mask
        same = ((((eq & plus) + plus) ^ plus) | eq | minus) & mask  # diagonal neighbours are equal
        right_plus, right_minus = (minus | ~(same | plus)) & mask, same & plus
        if j <= m - edits:
            value += not same >> (width - 1)
        else:
            row = width - 1 - (j - (m - edits))
            value += (right_plus >> row & 1) - (right_minus >> row & 1)
        plus, minus = (right_minus | ~(same >> 1 | right_plus)) & mask, same >> 1 & right_plus
    return value <= edits


STEP = U(0xD6E8FEB86659FD93)  # fixed odd multiplier of the substring hash
BACK = U(pow(int(STEP), -1, 1 << 64))
INDEX, PROBE = 1, 2


def line_id(line: bytes) -> int:
    """60 bits of the MD5 digest, as `LINE_ID` has them."""
    return int(hashlib.md5(line).hexdigest()[:15], 16)


LINE_ID = "cast(conv(substring(md5(encode(line, 'utf-8')), 1, 15), 16, 10) as bigint)"


def _segment(length: np.ndarray, edits: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment k (from 0): sizes differ by one at most, the last ones are longer."""
    size, longer = np.divmod(length, edits + 1)
    short = edits + 1 - longer
    return k * size + np.maximum(k - short, 0), size + (k >= short)


def segment_keys(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, role) of all index segments and probe substrings of lines of at least MIN_CHARS characters."""
    code = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter((len(x) for x in lines), np.int64, len(lines))
    first = np.cumsum(size) - size
    ones = np.ones(len(code) + 1, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = STEP, BACK
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(code + U(1)) * up[:-1], dtype=np.uint64)])
    keys, owners, roles = [], [], []

    def add(which, at, length, part, of_length, role) -> None:
        a, b = first[which] + at, first[which] + at + length
        tag = mix((of_length * (edits + 1) + part).astype(np.uint64))
        keys.append(mix((total[b] - total[a]) * down[a] ^ tag))
        owners.append(which)
        roles.append(np.full(len(which), role, np.uint8))

    every = np.arange(len(lines))
    for k in range(edits + 1):
        at, length = _segment(size, edits, k)
        add(every, at, length, k, size, INDEX)
        for less in range(edits + 1):  # the indexed line is so much shorter
            other = size - less
            at, length = _segment(other, edits, k)
            for shift in range(-k, k + 1):
                if abs(shift - less) <= edits - k:
                    ok = np.flatnonzero((at + shift >= 0) & (at + shift + length <= size) & (other >= MIN_CHARS))
                    add(ok, (at + shift)[ok], length[ok], k, other[ok], PROBE)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(roles)


_SENT = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("lines", pa.binary()), ("sizes", pa.binary()), ("roles", pa.binary())])
SENT_SCHEMA = "bucket long, keys binary, lines binary, sizes binary, roles binary"


def _send(edits: int, buckets: int):
    def run(batches):
        for _, texts in pieces(batches):
            distinct = {}
            for t in texts:
                for line in t.split(b"\n"):
                    if len(line) >= MIN_CHARS and line not in distinct:
                        distinct[line] = line.decode("utf-8", "replace")
            lines = [(line_id(raw), x) for raw, x in distinct.items() if len(x) >= MIN_CHARS]
            if not lines:
                continue
            ids, size = np.array([i for i, _ in lines], np.int64), np.array([len(x) for _, x in lines], np.int64)
            key, owner, role = segment_keys([x for _, x in lines], edits)
            order = np.lexsort((owner, key))
            key, owner, role = key[order], owner[order], role[order]
            head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]))
            key, owner, role = key[head], owner[head], np.bitwise_or.reduceat(role, head)
            cols = [[], [], [], [], []]
            for b, lo, hi in slices(key, buckets):
                low = (rest_of(key[lo:hi], buckets) >> U(32)).astype(np.uint32)
                for col, v in zip(cols, (b, pack_sorted(low), ids[owner[lo:hi]].tobytes(), pack(size[owner[lo:hi]].astype(np.uint32)), pack(role[lo:hi]))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SENT)], schema=_SENT)
    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """The lines of each key that one line indexes and another probes."""
    key = np.concatenate([unpack_sorted(x, np.uint32) for x in pdf["keys"]])
    line = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["lines"]])
    size, role = (np.concatenate([unpack(x, t) for x in pdf[c]]) for c, t in (("sizes", np.uint32), ("roles", np.uint8)))
    order = np.lexsort((line, key))
    key, line, size, role = key[order], line[order], size[order], role[order]
    head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (line[1:] != line[:-1])]))
    role = np.bitwise_or.reduceat(role, head)
    key, line, size = key[head], line[head], size[head]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    many = np.diff(head, append=len(key))
    hit = np.repeat((many > 1) & (np.bitwise_or.reduceat(role, head) == INDEX | PROBE), many)
    return pd.DataFrame({"key": (pdf["bucket"].iloc[0] << 32) + key[hit].astype(np.int64), "ck": line[hit], "n": size[hit].astype(np.int64)})


def _verify(edits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            ok = [k for k in range(len(a)) if within(x[k], y[k], edits)]
            yield pa.RecordBatch.from_arrays([pa.array([c[k] for k in ok], pa.int64()) for c in (a, b)], schema=schema)
    return run


BINS = 32


def _count_pairs(batches):
    """Packed counts, by hash bin, of the pairs of neighbouring characters of each line."""
    schema = pa.schema([("ck", pa.int64()), ("s", pa.int64()), ("x", pa.binary())])
    for batch in batches:
        ids, lines = (c.to_pylist() for c in batch.columns)
        out = []
        for line in lines:
            c = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
            out.append(np.bincount((mix(c[:-1] * STEP + c[1:]) % U(BINS)).astype(np.int64), minlength=BINS).astype(">u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([0] * len(ids), pa.int64()), pa.array(out, pa.binary())], schema=schema)


def _may_be_within(edits: int):
    """Bounds of two lines: lengths differ by an edit each, counts of character pairs by four (two go, two come)."""
    return (lambda n, s, m, t: np.abs(n - m) <= edits), (lambda n, x, m, y: np.abs(x - y).sum(1) <= 4 * edits)


def numbered_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and line of every line; an empty text has none."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''")
    return rows.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def line_dedup(docs: DataFrame, edits: int = 2, bytes_per_bucket: int = 12 << 20) -> DataFrame:
    """Keep the first line (by doc_id, line number) of each class of near-equal lines.

    Lines are split at line feeds. Two lines are linked if they are equal or, both of at least 20 characters, within ``edits``
    edits (code points inserted, deleted or replaced); classes are connected components. Blank lines stay and are in no
    class. Result, one row per row of ``docs``: doc_id, n_lines, n_removed, removed_lines (ascending). Null
    and empty texts have no lines. Rows without an id come last in the order. Rows that repeat an id are the same
    document: line k of one equals line k of the other, so they keep and lose alike. Other columns are ignored."""
    rows = numbered_lines(docs).where("trim(line) <> ''")
    lines = scratch(rows.select("doc_id", "line_no", F.expr(LINE_ID).alias("lid")), "lines")
    total = docs.agg(F.sum(F.length(utf8("text")))).first()[0] or 0
    buckets = max(1, -(-int(total) // bytes_per_bucket))
    raw = docs.select(F.lit(None).cast("long").alias("id"), utf8("text").alias("data"))
    sent = raw.mapInArrow(_send(edits, buckets), SENT_SCHEMA)
    members = scratch(sent.groupBy("bucket").applyInPandas(_shared, "key long, ck long, n long"), "members")
    wanted = members.select("ck").distinct()
    texts = rows.select(F.expr(LINE_ID).alias("ck"), "line").join(wanted, "ck", "left_semi").groupBy("ck").agg(F.min("line").alias("line"))
    texts = scratch(texts, "texts")

    def similar(pairs: DataFrame) -> DataFrame:
        left, right = (texts.select(F.col("ck").alias(c), F.col("line").alias(f"line_{c}")) for c in "ab")
        return pairs.join(left, "a").join(right, "b").select("a", "b", "line_a", "line_b").mapInArrow(_verify(edits), "a long, b long")

    def sketch(classes: DataFrame) -> DataFrame:
        return texts.join(classes, "ck", "left_semi").mapInArrow(_count_pairs, "ck long, s long, x binary")

    linker = Linker(members, lambda n, m: F.abs(n - m) <= edits, similar, sketch, lambda found: pairs_in_blocks(found, *_may_be_within(edits), BINS), "true", members)
    linker.run()
    where = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), F.col("line_no").alias("l"))
    distinct = lines.groupBy(F.col("lid").alias("ck")).agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("size"))
    labelled = linker.labelled(distinct)
    least = labelled.groupBy("label").agg(F.min("first").alias("stays"))
    decided = scratch(labelled.join(least, "label").select(F.col("ck").alias("lid"), "stays", "size"), "decided")
    marked = join_groups(lines, decided, "lid", "size").withColumn("gone", where != F.col("stays"))
    gone = marked.where("gone").groupBy(F.col("doc_id").alias("id")).agg(F.sort_array(F.collect_set("line_no")).alias("removed_lines"))
    count = F.when(F.coalesce("text", F.lit("")) != "", F.size(F.split("text", "\n", -1))).otherwise(0).cast("long")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), count.alias("n_lines"))
    out = out.join(gone, out["doc_id"].eqNullSafe(gone["id"]), "left").drop("id")
    removed = F.coalesce("removed_lines", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed_lines"))


def drop_lines(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` with the removed lines cut from the texts (doc_id must be unique)."""
    cut = F.expr("array_join(transform(filter(transform(split(text, '\n', -1), (x, i) -> struct(x AS x, i AS i)), s -> NOT array_contains(removed_lines, s.i)), s -> s.x), '\n')")
    gone = decisions.where("n_removed > 0").select(F.col("doc_id").alias("_id"), "removed_lines")
    out = docs.join(gone, docs["doc_id"] == gone["_id"], "left")
    return out.withColumn("text", F.when(F.col("removed_lines").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
