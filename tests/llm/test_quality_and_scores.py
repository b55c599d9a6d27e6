import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm.hmm import Hmm, _expected, _maximise, hmm_scores, initial, log_likelihoods
from cartwheel.llm.quality import FEATURES, features, good_documents, quality_scores

SF = "/root/testdata/sf0.01"


def test_features_do_not_depend_on_the_batch():
    texts = ["", "A B. a b a", "é ! 12 | x\ny", "   ", "word"]
    raw = [t.encode() for t in texts]
    together = features(raw)
    assert together.shape == (5, len(FEATURES)) and np.isfinite(together).all()
    for k, t in enumerate(raw):
        assert np.array_equal(features([t])[0], together[k])
    assert not together[0].any()


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_scores(spark.read.parquet(f"{SF}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.95
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_of_odd_rows_and_labels(spark, documents, odd_rows):
    docs = documents(odd_rows)
    some = spark.createDataFrame([(4, 1), (5, 0), (6, None), (7, 1), (7, 0), (8, 0), (100, 1), (101, 0), (None, 1)], "doc_id long, quality int")
    for labels in (some, some.limit(0)):
        got = quality_scores(docs, labels).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
        assert all((r.held_out is None) == (r.doc_id is None) for r in got)
    assert {r.score for r in got} == {0.5}
    assert quality_scores(documents([]), some).count() == 0
    assert good_documents(docs, some.limit(0)).columns == docs.columns
    assert good_documents(docs, some.limit(0)).count() == len(odd_rows)


def test_scores_ignore_other_columns_and_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(300).cache(), spark.read.parquet(f"{SF}/labels.parquet")
    one = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(F.expr("crc32(encode(cast(doc_id as string), 'utf-8')) % 5 = 0"), 1 - F.col("quality")).otherwise(F.col("quality")))
    two = {r.doc_id: r.score for r in quality_scores(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), flipped).collect()}
    assert one == two


def brute_likelihood(model, seq):
    """Sum over all state paths."""
    import itertools

    total = 0.0
    for path in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[path[0], seq[0]]
        for a, b, x in zip(path, path[1:], seq[1:]):
            p *= model.move[a, b] * model.emit[b, x]
        total += p
    return math.log10(total)


def some_model(states=3, classes=4, seed=0):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states)
    return Hmm(start, move, emit, np.full(classes, 1 / classes))


def test_forward_recursion_sums_all_paths():
    model, size = some_model(), np.array([1, 5, 3, 6])
    seq = np.random.default_rng(1).integers(0, 4, size.sum())
    want = [brute_likelihood(model, part) for part in np.split(seq, np.cumsum(size)[:-1])]
    assert np.allclose(log_likelihoods(model, seq, size), want)


def test_expected_counts_equal_path_posteriors_and_training_gains():
    import itertools

    import pyarrow as pa

    from cartwheel.llm.textmath import pack

    model, size = some_model(), np.array([4, 1, 5])
    seq = np.random.default_rng(2).integers(0, 4, size.sum())
    row = pa.RecordBatch.from_arrays([pa.array([pack(seq.astype(np.uint16))]), pa.array([size.tobytes()]), pa.array([np.ones(3, bool).tobytes()])], ["classes", "sizes", "learn"])
    total = np.zeros(3 + 9 + 12)
    for batch in _expected(model)(iter([row])):
        total[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    want = np.zeros_like(total)
    for part in np.split(seq, np.cumsum(size)[:-1]):
        whole = 10 ** brute_likelihood(model, part)
        for path in itertools.product(range(3), repeat=len(part)):
            p = model.start[path[0]] * model.emit[path[0], part[0]]
            for a, b, x in zip(path, path[1:], part[1:]):
                p *= model.move[a, b] * model.emit[b, x]
            want[path[0]] += p / whole
            for a, b in zip(path, path[1:]):
                want[3 + 3 * a + b] += p / whole
            for a, x in zip(path, part):
                want[12 + 4 * a + x] += p / whole
    assert np.allclose(total, want)
    better = _maximise(model, total, smooth=0)
    assert log_likelihoods(better, seq, size).sum() >= log_likelihoods(model, seq, size).sum()


def tokens(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "").replace("\xa0", "_")).split() + [None]


def test_base_scores_and_counts_equal_brute_force(documents, odd_rows):
    rng = random.Random(3)
    rows = [*odd_rows, *((k, " ".join(f"W{min(rng.randint(0, 40), rng.randint(0, 40))}" for _ in range(rng.randint(0, 60)))) for k in range(1000, 1080))]
    got = sorted(hmm_scores(documents(rows), states=3, top=10, rounds=2, chunk_bytes=3000).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(x for i, t in rows if i is not None and not held(i) for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = [(i, held(i), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t))) for i, t in rows]
    want.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5]
        assert r.base_score == pytest.approx(w[5]) and r.score < 0


def test_model_sums_to_one_and_beats_the_base_on_held_out_texts(spark):
    got = hmm_scores(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    mass = np.random.default_rng(0).dirichlet(np.ones(30))
    model = initial(mass, 4, 1)
    assert np.allclose(model.emit.sum(1), 1) and np.allclose(model.move.sum(1), 1)


def test_one_state_is_the_base(documents):
    rows = [(k, f"a b c{k % 3} d" * (k % 4)) for k in range(40)]
    for r in hmm_scores(documents(rows), states=1).collect():
        assert r.score == pytest.approx(r.base_score)
    assert hmm_scores(documents([])).count() == 0
