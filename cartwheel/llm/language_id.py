"""Language identification by cross-parsing entropy (Ziv and Merhav 1993).

A text is parsed against the labelled text of each language: each phrase is the longest stretch that occurs anywhere in it, or
one byte if not even that does. A phrase costs the logarithm of the labelled text's length (a pointer into it), and the language
with the lowest cost wins. A suffix automaton accepts exactly the substrings of its text, so a phrase is read byte by
byte from the start state until no transition is left.

Labelled text is a bounded sample; each Python worker builds its automata from it once. Texts are parsed where they are
read, without a shuffle.
"""

from __future__ import annotations

import math
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_crc, scratch, utf8
from .minhash_dedup import pieces

TRAIN_BYTES = 1 << 16  # labelled text of one language
ALL_BYTES = 1 << 19  # of all languages together: with more than 8 of them, each has less
TRAIN_ROWS = 4096  # distinct texts of one language
UNKNOWN = "und"
BETWEEN = b"\n"  # stands between labelled texts and in no text, so no phrase runs from one into the next


def letters(text: Column) -> Column:
    """Lower-cased text; whatever is no letter or mark is one space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " ")


class Automaton:
    """Suffix automaton of ``text``: ``next[state + letter]`` is the state after one more byte, 0 if there is none.

    A state is the place of its first transition; the start state is 0, into which no transition leads."""

    def __init__(self, text: bytes):
        alphabet = sorted(set(text))
        width = len(alphabet) + 1  # the last letter stands for bytes that the text lacks
        self.code = bytes(alphabet.index(c) if c in alphabet else width - 1 for c in range(256))
        self.cost = math.log2(len(text) + 1)
        nxt = array("i", bytes(4 * width * 2 * max(1, len(text))))
        length, link = [0], [-1]  # by state / width
        last = 0
        for c in text.translate(self.code):
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and not nxt[p * width + c]:
                nxt[p * width + c] = new * width
                p = link[p]
            if p >= 0:
                q = nxt[p * width + c] // width
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    nxt[twin * width:(twin + 1) * width] = nxt[q * width:(q + 1) * width]
                    while p >= 0 and nxt[p * width + c] == q * width:
                        nxt[p * width + c] = twin * width
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.next = nxt[:len(length) * width]

    def phrases(self, text: bytes) -> int:
        """Number of phrases of ``text``."""
        nxt, at, count = self.next, 0, 0
        for c in text.translate(self.code):
            to = nxt[at + c]
            if to:
                at = to
            else:
                if at:
                    count += 1  # the phrase ends before c
                at = nxt[c]
                if not at:
                    count += 1  # c is a phrase of its own
        return count + (at > 0)


@lru_cache(maxsize=1)
def automata(labelled: tuple[tuple[str, bytes], ...]) -> list[tuple[str, Automaton]]:
    """One automaton for each language; kept for the next tasks of this worker."""
    return [(lang, Automaton(text)) for lang, text in labelled]


def predict(text: bytes, models: list[tuple[str, Automaton]]) -> tuple[str, float]:
    """Cheapest language (ties: the first) and its share under 2 ** -cost."""
    costs = [m.phrases(text) * m.cost for _, m in models]
    best = min(costs)
    return models[costs.index(best)][0], 1 / sum(2.0 ** max(best - c, -1000.0) for c in costs)


def labelled_sample(docs: DataFrame, folds: int = 5, train_bytes: int = TRAIN_BYTES, train_rows: int = TRAIN_ROWS, all_bytes: int = ALL_BYTES) -> list[tuple[str, bytes]]:
    """Labelled text of each language, from rows with a language whose crc32(doc_id as text) mod ``folds`` is not 0.

    For each language at most ``train_rows`` distinct texts in the order of their hashes, whole, until ``train_bytes`` (or the language's share of
    ``all_bytes``) are reached; a language whose texts are all longer gives the beginning of its shortest one. The driver gets no more than
    ``all_bytes`` of text. Languages without a letter in the sample are not learnt."""
    known = docs.where(F.col("lang").isNotNull() & (id_crc(F.col("doc_id").cast("long")) % folds != 0) & (F.octet_length("text") > 0))
    known = known.select("lang", F.col("text"), F.xxhash64("text").alias("hash"), F.octet_length("text").cast("long").alias("size"))
    sizes = known.groupBy("lang").agg(F.min(F.struct("size", "hash")).alias("least"))
    langs = sizes.count()
    if not langs:
        return []
    share = max(1, min(train_bytes, all_bytes // langs))
    texts = scratch(known.where(F.col("size") <= share).groupBy("lang", "hash").agg(F.min("size").alias("size")), "texts")
    # hashes are even: of n texts, those in the lowest 4 * need / n of all hashes hold the need lowest, however many there are
    need = F.least(F.lit(float(train_rows)), F.lit(float(share)) * F.count(F.lit(1)) / F.sum("size")) + 64
    part = texts.groupBy("lang").agg((F.lit(2.0 ** 66) * need / F.count(F.lit(1)) - 2.0 ** 63).alias("_below"))
    texts = texts.join(F.broadcast(part), "lang").where(F.col("hash") < F.col("_below"))
    order = Window.partitionBy("lang").orderBy("hash")
    picks = texts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= train_rows)
    picks = picks.withColumn("_sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_sum") <= share).select("lang", "hash")
    picks = picks.unionByName(sizes.where(F.col("least.size") > share).select("lang", F.col("least.hash").alias("hash")))
    picks = F.broadcast(picks)  # at most train_rows rows a language
    rows = known.join(picks, ["lang", "hash"], "left_semi").groupBy("lang", "hash").agg(F.min(F.substring(letters(F.col("text")), 1, share)).alias("text"))
    found: dict[str, list[bytes]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["lang"], r["hash"])):
        if r["text"].strip():
            found.setdefault(r["lang"], []).append(r["text"].encode()[:share])
    return [(lang, BETWEEN.join(parts)) for lang, parts in sorted(found.items(), key=lambda x: x[0].encode())]


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _predict(sample):
    def run(batches):
        models = automata(sample.value)
        for ids, rows in pieces(_pairs(batches)):
            out = [predict(t, models) if has else (UNKNOWN, 0.0) for t, has in ((r[1:], r[:1] == b"1") for r in rows)]
            cols = ([i["doc_id"] for i in ids], [i["held_out"] for i in ids], [x for x, _ in out], [s for _, s in out])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)
    return run


def _pairs(batches):
    """Batches of (struct of id and fold, text) for ``pieces``."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(b.columns[:2], ["doc_id", "held_out"]), b.column(2)], ["key", "data"])


def language_ids(docs: DataFrame, folds: int = 5, train_bytes: int = TRAIN_BYTES, train_rows: int = TRAIN_ROWS, all_bytes: int = ALL_BYTES) -> DataFrame:
    """Predict the language of every whole text of ``docs`` (doc_id, text, lang); learns from ``labelled_sample``.

    Result, one row per document: doc_id, held_out (crc32(doc_id as text) mod ``folds`` is 0), lang_pred, score. A text that is null or has no letter
    is `und` with score 0, and so is every text if nothing could be learnt. Ties go to the first language in the order of bytes. Rows
    without an id are predicted, never learnt from, and have held_out null. Repeated rows count once in the
    sample. Texts of any length are read whole, in one pass. An empty table has no rows. Other columns are ignored."""
    sample = tuple(labelled_sample(docs, folds, train_bytes, train_rows, all_bytes))
    has = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}") & F.lit(bool(sample))
    mark = F.when(has, F.concat(F.lit("1"), letters(F.col("text")))).otherwise(F.lit("0"))
    ids = F.col("doc_id").cast("long")
    rows = docs.select(ids.alias("doc_id"), (id_crc(ids) % folds == 0).alias("held_out"), utf8(mark).alias("data"))
    shared = docs.sparkSession.sparkContext.broadcast(sample)  # at most all_bytes
    return rows.mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")
