"""Quality classifier: regularised quadratic discriminant on transformed document statistics.

Each text becomes a short vector of byte, word and line statistics (vectorised per piece of text),
shares through asin(sqrt(x)), counts through log(1 + x). Values are fixed-point integers, so the
class sums over all training rows are exact and do not depend on the order of tasks. Class covariances are
shrunk towards the pooled one and towards its diagonal; their Cholesky factors are computed once and sent
with the scoring tasks. The score is the posterior from the Mahalanobis log-density difference.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, scratch, utf8
from .minhash_dedup import pieces
from .textmath import IS_SPACE, MIX1, U, Words, mix

ONE = 1 << 12  # fixed-point unit of a feature
PIECE = 1 << 18  # bytes of text worked on at once (more if one text is longer): a worker holds about forty times as much


def _byte_set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_CLASSES = {
    "upper": _byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digit": _byte_set("0123456789"), "stop": _byte_set(".?"), "comma": _byte_set(",;:"), "bang": _byte_set("!"),
    "bar": _byte_set("|"), "mark": _byte_set("#$%&*+<=>@\\^_`{}~[]/\""), "space": IS_SPACE, "high": np.arange(256) >= 0xC0,
}
FEATURES = (*(f"{c}_share" for c in _CLASSES), "words", "word_length", "line_words", "distinct_words", "distinct_pairs", "top_word", "repeats", "short_words", "marked_words", "first_stop")


def features(texts: list[bytes]) -> np.ndarray:
    """(texts, len(FEATURES)) transformed statistics; an empty text has zeros."""
    w = Words(texts)
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    at = np.cumsum(size + 1) - size - 1
    chars = np.maximum(size, 1)
    n = np.diff(w.first)
    words = np.maximum(n, 1)
    cols = []
    for member in _CLASSES.values():
        hit = member[w.buf]
        count = np.add.reduceat(hit, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
        cols.append(np.arcsin(np.sqrt(np.minimum((count - member[10]) / chars, 1))))  # without the newline put between texts
    lines = np.add.reduceat(w.buf == 10, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
    length = w.end - w.start
    h = w.hash

    def per_text(values) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[w.first[1:]] - total[w.first[:-1]]

    def distinct(x, doc) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((x, doc))
        x, doc = x[order], doc[order]
        head = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])])) if len(x) else np.zeros(0, np.int64)
        top = np.zeros(len(texts), np.int64)
        np.maximum.at(top, doc[head], np.diff(head, append=len(x)))
        return np.bincount(doc[head], minlength=len(texts)), top

    cols.append(np.log1p(n))
    cols.append(np.log1p(per_text(length) / words))
    cols.append(np.log1p(n / np.maximum(lines, 1)))
    kinds, top = distinct(h, w.doc)
    inner = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    pair_kinds, _ = distinct(mix(h[inner] * MIX1 + h[inner + 1]), w.doc[inner])
    share = lambda x: np.arcsin(np.sqrt(np.clip(x, 0, 1)))
    cols.append(share(kinds / words))
    cols.append(share(pair_kinds / np.maximum(n - 1, 1)))
    cols.append(share(top / words))
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    cols.append(share(per_text(same) / words))
    cols.append(share(per_text(length <= 3) / words))
    odd = np.concatenate([[0], np.cumsum((_CLASSES["mark"] | _CLASSES["bar"] | _CLASSES["bang"])[w.buf])])
    cols.append(share(per_text(odd[w.end] > odd[w.start]) / words))
    ends = _CLASSES["stop"][w.buf[w.end - 1]] if len(h) else np.zeros(0, bool)
    cols.append(share(per_text(ends) / words))
    out = np.stack(cols, axis=1) if len(texts) else np.zeros((0, len(FEATURES)))
    out[size == 0] = 0
    return out


_FEATS = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.int64()))])


def _featurise(batches):
    for ids, texts in pieces(batches, PIECE):
        x = np.rint(features(texts) * ONE).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(x.tolist(), _FEATS[1].type)], schema=_FEATS)


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id and x: the fixed-point features of each whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("data")).mapInArrow(_featurise, "doc_id long, x array<long>")


_SUMS = pa.schema([("label", pa.int32()), ("place", pa.int32()), ("total", pa.int64())])


def _sums(batches):
    """Exact class sums of 1, x and x x' of a batch."""
    for batch in batches:
        label = np.array(batch.column(1).to_pylist(), np.int64)
        x = np.array(batch.column(0).to_pylist(), np.int64).reshape(len(label), -1)
        for k in np.unique(label):
            v = x[label == k]
            total = np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), k), pa.int32()), pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], schema=_SUMS)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of the two classes; prior log odds.

    Without two rows of either class there are no factors and every score is ``constant``."""

    constant: float
    odds: float = 0.0
    means: np.ndarray | None = None
    whiten: np.ndarray | None = None
    log_det: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.constant)
        dens = [-0.5 * np.square((x - self.means[k]) @ self.whiten[k].T).sum(1) - self.log_det[k] for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(dens[1] - dens[0] + self.odds, -500, 500)))


def fit(train: DataFrame, pooled: float = 0.1, diagonal: float = 0.02) -> Discriminant:
    """``train``: x, label (0 or 1). All rows count; the driver gets 2 * (1 + d + d * d) sums."""
    sums = train.select("x", F.col("label").cast("int").alias("label")).mapInArrow(_sums, "label int, place int, total long")
    got = sums.groupBy("label", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for r in got:
        total[r["label"], r["place"]] = float(r["total"])
    n = total[:, 0]
    if n.min() < 2:
        return Discriminant(float(n[1] / n.sum()) if n.sum() else 0.5)
    means = total[:, 1:1 + d] / n[:, None] / ONE
    own = total[:, 1 + d:].reshape(2, d, d) / n[:, None, None] / ONE ** 2 - means[:, :, None] * means[:, None, :]
    both = (own * n[:, None, None]).sum(0) / n.sum()
    spread = np.diag(np.maximum(np.diag(both), 1e-6))
    factor = np.linalg.cholesky((1 - pooled) * own + pooled * both + diagonal * spread)
    return Discriminant(float(n[1] / n.sum()), float(np.log(n[1] / n[0])), means, np.linalg.inv(factor), np.log(np.diagonal(factor, axis1=1, axis2=2)).sum(1))


def _score(model: Discriminant, threshold: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), np.float64).reshape(batch.num_rows, -1) / ONE
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], schema=schema)
    return run


def train(docs: DataFrame, labels: DataFrame, folds: int, pooled: float, diagonal: float) -> tuple[DataFrame, Discriminant]:
    """The stored feature table of ``docs`` and the model learnt from its labelled rows outside the held-out fold."""
    table = scratch(feature_table(docs).withColumn("held_out", id_crc("doc_id") % folds == 0), "features")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")).where("label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    return table, fit(table.where("NOT held_out").join(known, "doc_id"), pooled, diagonal)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, pooled: float = 0.1, diagonal: float = 0.02) -> DataFrame:
    """All columns of the rows of ``docs`` whose text scores ``threshold`` or more; learns as ``quality_scores`` does.

    Each row is judged by its own text, so null ids and repeated rows need no special case. Texts are
    scored where they are read, without a shuffle."""
    _, model = train(docs, labels, folds, pooled, diagonal)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        out = [model.score(np.rint(features(part) * ONE) / ONE) for part in _parts(text)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.where(score(utf8("text")) >= threshold)


def _parts(texts: pd.Series):
    """Bounded lists of the texts."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > PIECE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, pooled: float = 0.1, diagonal: float = 0.02) -> DataFrame:
    """Score every whole text; learn from labelled rows whose crc32(doc_id as text) mod ``folds`` is not 0.

    ``docs``: doc_id, text; ``labels``: doc_id, quality (1 good). Result, one row per document: doc_id,
    held_out, score (0 to 1), predicted (1 if score >= threshold). A null or empty text is scored as a vector of
    zeros. Rows without an id are scored and never learnt from (held_out null). Of several labels of one document the
    largest counts; null labels are ignored. With no usable labels every score is 0.5. Other columns are ignored."""
    table, model = train(docs, labels, folds, pooled, diagonal)
    return table.select("doc_id", "held_out", "x").mapInArrow(_score(model, threshold), "doc_id long, held_out boolean, score double, predicted int")
