"""Hidden Markov language model over whole documents.

Every token is a word of the corpus vocabulary or the end of a text. Emissions are tied by word class, so that the
model has a bounded size whatever the vocabulary: the ``top`` most frequent words are classes of their own, all others fall
into classes by count range, non-ASCII bytes and last byte. P(word | state) = P(class | state) * P(word | class), where
P(word | class) is the word's add-one probability within its class, from exact counts over the whole
training part. With one state the model is the unigram base.

Counts: chunks of documents send each hash bucket their distinct words (packed 64-bit hashes) with counts; the
buckets answer the corpus counts, so a word in a third of all texts is one entry per chunk. Training: Baum-Welch;
tasks run forward-backward over runs of 64 tokens and send expected counts, which Spark sums across
partitions; the driver gets states * classes sums. Scoring: the scaled forward recursion over the whole
text, all documents of a chunk side by side, gives the exact log-likelihood.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import NULL_ID, buckets_for, gather, rows_of, texts_of, with_answers
from .common import scratch
from .textmath import U, Words, bucket_of, mix, pack, pack_sorted, rest_of, slices, unpack, unpack_sorted

END = mix(np.array([0xE0F], np.uint64))[0]  # stands for the end of a text; no word hashes are made from it
RUN = 64  # tokens of a training run
COUNT_BITS, KINDS = 24, 8  # rare classes: 24 count ranges, each with 8 kinds of word


def _crc_mod(ids: np.ndarray, folds: int) -> np.ndarray:
    return np.array([0 if i == NULL_ID else zlib.crc32(str(i).encode()) % folds for i in ids.tolist()], np.int64)


class Tokens:
    """Tokens of a chunk: word hashes with an end after each text, the kind of word, and its distinct tokens."""

    def __init__(self, row: dict, folds: int, held: int):
        self.ids, texts = texts_of(row)
        w = Words(texts, lower=True)
        n = np.diff(w.first)
        self.size = n + 1
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.held_out = (_crc_mod(self.ids, folds) == held) & (self.ids != NULL_ID)
        self.learn = ~self.held_out & (self.ids != NULL_ID)
        place = np.arange(len(w)) + w.doc
        self.hash = np.full(self.first[-1], END, np.uint64)
        self.hash[place] = w.hash
        self.kind = np.zeros(self.first[-1], np.int64)
        if len(w):
            high = np.concatenate([[0], np.cumsum(w.buf >= 0x80)])
            last = w.buf[w.end - 1]
            mark = np.select([(last >= 97) & (last <= 122), last == 46, last == 44], [0, 1, 2], 3)
            self.kind[place] = (high[w.end] > high[w.start]) * 4 + mark
        self.doc = np.repeat(np.arange(len(texts)), self.size)
        self.words, self.which = np.unique(self.hash, return_inverse=True)
        self.word_kind = np.zeros(len(self.words), np.int64)
        self.word_kind[self.which] = self.kind


def count_bits(counts: np.ndarray) -> np.ndarray:
    """Count range of a known word: 1 for 1, 2 for 2 and 3, 3 for 4 to 7, and so on."""
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, COUNT_BITS - 1)


_SENT = pa.schema([("bucket", pa.int64()), ("chunk_id", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("kinds", pa.binary())])
SENT_SCHEMA = "bucket long, chunk_id long, keys binary, counts binary, kinds binary"


def _send(folds: int, held: int, buckets: int):
    def run(batches):
        for row in rows_of(batches):
            t = Tokens(row, folds, held)
            counts = np.bincount(t.which[t.learn[t.doc]], minlength=len(t.words))
            cols = [[], [], [], [], []]
            for b, lo, hi in slices(t.words, buckets):
                for col, v in zip(cols, (b, row["chunk_id"], pack_sorted(rest_of(t.words[lo:hi], buckets)), pack(counts[lo:hi].astype(np.int64)), pack(t.word_kind[lo:hi].astype(np.uint8)))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SENT)], schema=_SENT)
    return run


def _answer(top: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Corpus counts for each chunk, in the order it sent its words; one more row has the bucket's own sums."""
        keys, counts = [unpack_sorted(x, np.uint64) for x in pdf["keys"]], [unpack(x, np.int64) for x in pdf["counts"]]
        words, which = np.unique(np.concatenate(keys), return_inverse=True)
        total, kind = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        np.add.at(total, which, np.concatenate(counts))
        kind[which] = np.concatenate([unpack(x, np.uint8) for x in pdf["kinds"]])
        parts = np.split(total[which], np.cumsum([len(k) for k in keys])[:-1])
        out = pd.DataFrame({"chunk_id": pdf["chunk_id"], "bucket": pdf["bucket"], "blob": [pack(x) for x in parts], "tokens": 0, "words": 0, "masses": None, "top": None})
        known = np.flatnonzero(total)
        masses = np.zeros(COUNT_BITS * KINDS, np.int64)
        np.add.at(masses, count_bits(total[known]) * KINDS + kind[known], total[known] + 1)
        best = known[np.lexsort((words[known], -total[known]))[:top]]
        rows = [{"key": int(k), "n": int(n), "kind": int(x)} for k, n, x in zip(words[best].view(np.int64), total[best], kind[best])]
        own = pd.DataFrame({"chunk_id": [-1], "bucket": [pdf["bucket"].iloc[0]], "blob": [b""], "tokens": [int(total.sum())], "words": [len(known)], "masses": [masses.tolist()], "top": [rows]})
        return pd.concat([out, own], ignore_index=True)
    return run


ANSWER_SCHEMA = "chunk_id long, bucket long, blob binary, tokens long, words long, masses array<long>, top array<struct<key:long,n:long,kind:int>>"


@dataclass
class Vocabulary:
    """Training tokens and distinct words; the frequent words (bucket and rest of the hash, sorted) with their counts."""

    tokens: int
    words: int
    buckets: int
    top_bucket: np.ndarray
    top_rest: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.top_rest) + COUNT_BITS * KINDS

    def class_of(self, words: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Class of distinct words, given their corpus counts and kinds; all unknown words are one."""
        base = len(self.top_rest)
        out = base + np.where(counts > 0, count_bits(counts) * KINDS + kinds, 0)
        if base:
            bucket, rest = bucket_of(words, self.buckets), rest_of(words, self.buckets)
            known = {(int(b), int(r)): k for k, (b, r) in enumerate(zip(self.top_bucket, self.top_rest))}
            for k in np.flatnonzero(np.isin(rest, self.top_rest)):
                out[k] = known.get((int(bucket[k]), int(rest[k])), out[k])
        return out


_SEQ = pa.schema([("n_docs", pa.int32()), ("ids", pa.binary()), ("held", pa.binary()), ("learn", pa.binary()), ("sizes", pa.binary()), ("known", pa.binary()), ("base", pa.binary()), ("classes", pa.binary())])
SEQ_SCHEMA = "n_docs int, ids binary, held binary, learn binary, sizes binary, known binary, base binary, classes binary"


def _sequences(vocab: Vocabulary, folds: int, held: int):
    def run(batches):
        for row in rows_of(batches):
            t = Tokens(row, folds, held)
            counts = np.zeros(len(t.words), np.int64)
            first = {b: lo for b, lo, _ in slices(t.words, vocab.buckets)}
            for x in row["counts"] or []:
                got = unpack(x["blob"], np.int64)
                counts[first[x["bucket"]]:first[x["bucket"]] + len(got)] = got
            classes = vocab.class_of(t.words, counts, t.word_kind)
            log_p = np.log10((counts + 1) / (vocab.tokens + vocab.words + 1))
            base, known = np.add.reduceat(log_p[t.which], t.first[:-1]), np.add.reduceat((counts > 0)[t.which].astype(np.int64), t.first[:-1])
            values = (len(t.ids), t.ids.tobytes(), t.held_out.tobytes(), t.learn.tobytes(), t.size.tobytes(), known.tobytes(), base.tobytes(), pack(classes[t.which].astype(np.uint16)))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SEQ)], schema=_SEQ)
    return run


@dataclass
class Hmm:
    """start (states), move (states, states), emit (states, classes), and the mass of each class under the base."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    mass: np.ndarray


def _expected(model: Hmm):
    """Expected counts of starts, moves and emissions over the training runs of each row."""
    schema = pa.schema([("place", pa.int64()), ("total", pa.float64())])

    def run(batches):
        states, classes = model.emit.shape
        emit = model.emit.T.copy()
        total = np.zeros(states + states * states + states * classes)
        for row in rows_of(batches):
            seq, size, learn = unpack(row["classes"], np.uint16).astype(np.int64), np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["learn"], bool)
            first = np.concatenate([[0], np.cumsum(size)])[:-1]
            runs = -(-size // RUN)
            begin = np.repeat(first, runs) + (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)) * RUN
            length = np.minimum(RUN, np.repeat(first + size, runs) - begin)
            keep = np.repeat(learn, runs)
            begin, length = begin[keep], length[keep]
            order = np.argsort(-length, kind="stable")
            for part in np.array_split(order, max(1, len(order) // 4096)):
                if len(part):
                    _forward_backward(model, emit, seq, begin[part], length[part], first, total)
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[places])], schema=schema)
    return run


def _forward_backward(model: Hmm, emit: np.ndarray, seq, begin, length, doc_first, total) -> None:
    """Add the expected counts of runs, longest first, to ``total``. A run inside a text starts from the stationary shares."""
    states, classes = model.emit.shape
    steps, n = int(length[0]), len(begin)
    active = [int(np.searchsorted(-length, -s, side="left")) for s in range(steps)]  # runs longer than s
    at_start = np.isin(begin, doc_first)
    prior = np.where(at_start[:, None], model.start, _stationary(model.move))
    alpha, seen, scale = np.zeros((steps, n, states)), np.zeros((steps, n), np.int64), np.ones((steps, n))
    for s in range(steps):
        k = active[s]
        seen[s, :k] = seq[begin[:k] + s]
        a = (prior[:k] if s == 0 else alpha[s - 1, :k] @ model.move) * emit[seen[s, :k]]
        scale[s, :k] = np.maximum(a.sum(1), 1e-300)
        alpha[s, :k] = a / scale[s, :k, None]
    beta = np.ones((n, states))
    moves, emits = np.zeros((states, states)), np.zeros((classes, states))
    flat_class, flat_post = [], []
    for s in range(steps - 1, -1, -1):
        k = active[s]
        post = alpha[s, :k] * beta[:k]
        post /= np.maximum(post.sum(1, keepdims=True), 1e-300)
        flat_class.append(seen[s, :k])
        flat_post.append(post)
        if s:
            g = emit[seen[s, :k]] * beta[:k] / scale[s, :k, None]
            moves += (alpha[s - 1, :k].T @ g) * model.move
            beta[:k] = g @ model.move.T
        else:
            total[:states] += post[at_start].sum(0)
    c, p = np.concatenate(flat_class), np.concatenate(flat_post)
    for j in range(states):
        emits[:, j] = np.bincount(c, weights=p[:, j], minlength=classes)
    total[states:states + states * states] += moves.ravel()
    total[states + states * states:] += emits.T.ravel()


def _stationary(move: np.ndarray) -> np.ndarray:
    out = np.full(len(move), 1 / len(move))
    for _ in range(50):
        out = out @ move
    return out / out.sum()


def initial(mass: np.ndarray, states: int, seed: int) -> Hmm:
    """Near-uniform moves, the base's class shares with random tilts as emissions."""
    rng = np.random.Generator(np.random.PCG64(seed))
    emit = np.where(mass > 0, mass * rng.uniform(0.5, 1.5, (states, len(mass))), 0)
    move = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True), mass)


def _maximise(model: Hmm, total: np.ndarray, smooth: float = 0.5) -> Hmm:
    """New parameters from expected counts, with small Dirichlet priors (emissions: shaped as the base)."""
    states, classes = model.emit.shape
    start = total[:states] + smooth
    move = total[states:states + states * states].reshape(states, states) + smooth
    emit = total[states + states * states:].reshape(states, classes) + 100 * smooth * model.mass
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / np.maximum(emit.sum(1, keepdims=True), 1e-300), model.mass)


def reserve_unknown(model: Hmm, top: int, share: float) -> Hmm:
    """Give ``share`` of each state's probability of words seen once to the unknown word, which no training text holds.

    A word seen once would be unknown without its own text, so this is the leave-one-out estimate, damped."""
    once = slice(top + KINDS, top + 2 * KINDS)
    emit = model.emit.copy()
    emit[:, top] += share * emit[:, once].sum(1)
    emit[:, once] *= 1 - share
    return Hmm(model.start, model.move, emit, model.mass)


def log_likelihoods(model: Hmm, seq: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log10 likelihood of each class sequence by the scaled forward recursion, all sequences side by side."""
    out = np.zeros(len(size))
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    order = np.argsort(-size, kind="stable")
    begin, length, emit = first[order], size[order], model.emit.T.copy()
    active = np.searchsorted(-length, -np.arange(int(length.max()) if len(length) else 0), side="left")
    a, logs = np.tile(model.start, (len(order), 1)), np.zeros(len(order))
    for s, k in enumerate(active):
        if s:
            a = a[:k] @ model.move
        a = a[:k] * emit[seq[begin[:k] + s]]
        c = a.sum(1)
        a /= c[:, None]
        logs[:k] += np.log10(c)
    out[order] = logs
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
OUT_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: Hmm, tokens: int):
    def run(batches):
        with np.errstate(divide="ignore"):
            log_mass = np.log10(model.mass)
        for row in rows_of(batches):
            seq, size = unpack(row["classes"], np.uint16).astype(np.int64), np.frombuffer(row["sizes"], np.int64)
            base, first = np.frombuffer(row["base"], np.float64), np.concatenate([[0], np.cumsum(size)])[:-1]
            score = base - np.add.reduceat(log_mass[seq], first) + log_likelihoods(model, seq, size)
            ids = np.frombuffer(row["ids"], np.int64)
            cols = (pa.array(ids, mask=ids == NULL_ID), np.frombuffer(row["held"], bool), size, np.frombuffer(row["known"], np.int64), np.full(len(ids), tokens), base, score)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(cols, _OUT)], schema=_OUT)
    return run


def train(sequences: DataFrame, mass: np.ndarray, states: int, rounds: int, seed: int) -> Hmm:
    """Baum-Welch: each round is one pass over the stored class sequences."""
    model = initial(mass, states, seed)
    places = states + states * states + states * len(mass)
    for _ in range(rounds):
        sums = sequences.select("classes", "sizes", "learn").mapInArrow(_expected(model), "place long, total double").groupBy("place").agg(F.sum("total").alias("total"))
        total = np.zeros(places)
        for r in sums.collect():  # at most ``places`` rows, whatever the corpus
            total[r["place"]] = r["total"]
        model = _maximise(model, total)
    return model


def hmm_scores(docs: DataFrame, states: int = 6, top: int = 2000, rounds: int = 4, folds: int = 7, held: int = 2, chunk_bytes: int = 4 << 20, seed: int = 5, unknown_share: float = 0.5) -> DataFrame:
    """Score every whole text under a hidden Markov model and under the unigram base.

    Learns from rows whose crc32(doc_id as text) mod ``folds`` is not ``held``. Words are lower-cased (A-Z); each text
    ends with one end token. Result, one row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10). A null text is empty and has the end token only. Rows without an id are scored, not learnt from, and
    not held out. Repeated rows count as often as they occur. Without training rows every token has the same
    probability. Counts are exact up to collisions of 64-bit word hashes. Other columns are ignored."""
    chunks = gather(docs, chunk_bytes)
    buckets = buckets_for(chunks)
    sent = chunks.mapInArrow(_send(folds, held, buckets), SENT_SCHEMA)
    answers = scratch(sent.groupBy("bucket").applyInPandas(_answer(top), ANSWER_SCHEMA), "counts")
    own = answers.where("chunk_id = -1")
    n = own.agg(F.sum("tokens").alias("t"), F.sum("words").alias("w")).first()
    frequent = own.select("bucket", F.explode("top").alias("x")).select("bucket", "x.*").orderBy(F.col("n").desc(), "bucket", "key").limit(top).collect()
    vocab = Vocabulary(int(n["t"] or 0), int(n["w"] or 0), buckets, np.array([r["bucket"] for r in frequent], np.uint64), np.array([r["key"] for r in frequent], np.int64).view(np.uint64))
    top_n, mass = len(frequent), np.zeros(vocab.classes)
    for r in own.select(F.posexplode("masses").alias("place", "m")).groupBy("place").agg(F.sum("m").alias("m")).collect():  # COUNT_BITS * KINDS rows
        mass[top_n + r["place"]] = r["m"]
    for k, r in enumerate(frequent):
        mass[k] = r["n"] + 1
        mass[top_n + int(count_bits(np.array([r["n"]]))[0]) * KINDS + r["kind"]] -= r["n"] + 1
    mass[top_n] = 1  # all unknown words
    mass /= vocab.tokens + vocab.words + 1
    joined = with_answers(chunks, answers.where("chunk_id <> -1"), "counts")
    sequences = scratch(joined.mapInArrow(_sequences(vocab, folds, held), SEQ_SCHEMA), "sequences")
    model = Hmm(np.ones(1), np.ones((1, 1)), mass[None, :], mass)
    if states > 1 and vocab.tokens:
        model = reserve_unknown(train(sequences, mass, states, rounds, seed), top_n, unknown_share)
    return sequences.mapInArrow(_score(model, vocab.tokens), OUT_SCHEMA)
