"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Both tokenizers give end offsets of their tokens. Where both end, a group ends. As long as tokens are one to one, the ends of both arrays
are equal at a constant index shift: the shift's diagonal is probed with stretches of 1, 2, 4, 8 ... tokens, each compared as one block of
memory, and narrowed by halves where a probe fails. At an irregular group the side that lies behind moves on until both ends meet
again, which gives the new shift.

Links between tokens of a group are counted over the corpus as numbers of documents. A task gathers the documents it reads
into chunks, and a chunk sends each of its distinct id pairs once, so a pair that every document holds is one row a chunk. The
counts come back to the chunks by a join on the pair; texts are tokenised once.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import NULL_ID, rows_of
from .common import scratch, utf8
from .textmath import pack, unpack

TOKENIZERS = "/opt/tokenizers"
CUT = 1 << 14  # characters that go to a tokenizer at once, where a text has a place to cut
PIECE = 1 << 20  # bytes of text aligned at once (more if one text is longer)
CHUNK = 8 << 20  # bytes of text of a chunk
SIDE = 1 << 16  # ids of both sides are smaller
# Fixed value: what byte-level BPE splits a text by before it merges bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokenizers:
    """Tokenizer A (byte-level BPE) and B (pieces with byte fallback), and the bytes of each of their ids."""

    def __init__(self, folder: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        self.b = SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        alphabet = byte_alphabet()
        with open(f"{folder}/byte_bpe_50k.json", encoding="utf-8") as f:
            model = json.load(f)
        special = {t["id"] for t in model["added_tokens"]}
        words = {i: bytes(alphabet[c] for c in word) for word, i in model["model"]["vocab"].items() if i not in special}
        # ids ascend in the order of merges, so they serve as ranks; special tokens' strings are plain text
        self.a = Encoding("a", pat_str=PATTERN, mergeable_ranks={word: i for i, word in words.items()}, special_tokens={})
        self.a_bytes = [words.get(i, b"") for i in range(max(words) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of space + text under A, and of text under B, which adds the space."""
        parts = [cut(" " + t) for t in texts]
        flat = [p for x in parts for p in x]
        a = [self.a.encode_ordinary(p) for p in flat]
        b = self.b.encode([p[1:] for p in flat], num_threads=1)
        return _joined(a, parts), _joined(b, parts)


def _joined(ids: list[list[int]], parts: list[list[str]]) -> list[list[int]]:
    out, at = [], 0
    for x in parts:
        out.append(ids[at] if len(x) == 1 else [i for y in ids[at:at + len(x)] for i in y])
        at += len(x)
    return out


def cut(text: str, size: int = CUT) -> list[str]:
    """``text`` in parts of about ``size`` characters, each beginning with a space, whose tokens are those of the whole text.

    A space after a character that is no white space begins a word under A; under B no piece has a space behind another
    character, and the space that B puts in front of a part stands for it. A text without such a place stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        to = text.find(" ", at + size)
        while to > 0 and text[to - 1].isspace():
            to = text.find(" ", to + 1)
        if to < 0 or to + 1 == len(text):
            break
        out.append(text[at:to])
        at = to
    return [*out, text[at:]]


@lru_cache(maxsize=1)
def load(folder: str) -> Tokenizers:
    """Kept for the next tasks of this worker."""
    return Tokenizers(folder)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each group's last token in A and in B; both arrays ascend and have the same last end."""
    a, b = ends_a.astype(np.uint32).tobytes(), ends_b.astype(np.uint32).tobytes()
    at_a, at_b = ends_a.tolist(), ends_b.tolist()
    n, i, j = len(at_a), 0, 0
    run_i, run_j, run_n, odd_i, odd_j = [], [], [], [], []
    while i < n:
        begin, step = i, 1
        while True:
            probe = a[4 * i:4 * (i + step)]
            if len(probe) < 4 * step or probe != b[4 * j:4 * (j + step)]:
                break
            i, j, step = i + step, j + step, 2 * step
        while step > 1:
            step //= 2
            probe = a[4 * i:4 * (i + step)]
            if len(probe) == 4 * step and probe == b[4 * j:4 * (j + step)]:
                i, j = i + step, j + step
        if i > begin:
            run_i.append(begin)
            run_j.append(j - i + begin)
            run_n.append(i - begin)
        if i < n:
            x, y = at_a[i], at_b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = at_a[i]
                else:
                    j += 1
                    y = at_b[j]
            odd_i.append(i)
            odd_j.append(j)
            i, j = i + 1, j + 1
    size = np.array(run_n, np.int64)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    sides = []
    for starts, odd in ((run_i, odd_i), (run_j, odd_j)):
        sides.append(np.sort(np.concatenate([np.repeat(np.array(starts, np.int64), size) + inside, np.array(odd, np.int64)])))
    return sides[0], sides[1]


def _kinds(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id), and how often each occurs; ``group`` ascends."""
    key, n = np.unique(group * SIDE + ids, return_counts=True)
    return key // SIDE, key % SIDE, n


class Aligned:
    """Groups and links of a list of texts. Text k has ``n_a[k]`` and ``n_b[k]`` tokens, ``n_groups[k]`` groups, ``n_links[k]`` links, ``shas[k]``
    (digest of its groups, empty without tokens), and ``kinds[k]`` distinct pairs: ``pairs`` (A id * 65536 + B id) with ``times``."""

    def __init__(self, texts: list[bytes], tok: Tokenizers):
        count = len(texts)
        ids_a, ids_b = tok.encode([t.decode() for t in texts])
        for k, t in enumerate(texts):
            if not t or b"".join(map(tok.a_bytes.__getitem__, ids_a[k])) != b" " + t or b"".join(map(tok.b_bytes.__getitem__, ids_b[k])) != b" " + t:
                ids_a[k], ids_b[k] = [], []
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (ids_a, ids_b))
        a, b = (np.array([i for x in side for i in x], np.int64) for side in (ids_a, ids_b))
        # all texts lie on one line of bytes; both sides end at the end of each text, so no group runs into the next
        last_a, last_b = align(np.cumsum(tok.a_size[a]), np.cumsum(tok.b_size[b]))
        in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        doc = np.repeat(np.arange(count), self.n_a)[last_a]
        self.n_groups = np.bincount(doc, minlength=count)
        self.n_links = np.bincount(doc, weights=in_a * in_b, minlength=count).astype(np.int64)
        group = np.arange(len(last_a))
        self.shas = self._texts_of_groups(a, b, last_a, last_b, np.repeat(group, in_a), np.repeat(group, in_b), in_a, in_b)
        one = (in_a == 1) & (in_b == 1)
        pair, where, times = [a[last_a[one]] * SIDE + b[last_b[one]]], [doc[one]], [np.ones(one.sum(), np.int64)]
        if not one.all():
            ga, xa, na = _kinds(np.repeat(group, in_a)[many := np.repeat(~one, in_a)], a[many])
            gb, xb, nb = _kinds(np.repeat(group, in_b)[many := np.repeat(~one, in_b)], b[many])
            # each distinct id of A meets each distinct id of B in its group
            first, size = np.searchsorted(gb, ga), np.searchsorted(gb, ga, side="right") - np.searchsorted(gb, ga)
            x = np.repeat(np.arange(len(ga)), size)
            y = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size) + first[x]
            pair.append(xa[x] * SIDE + xb[y])
            where.append(doc[ga[x]])
            times.append(na[x] * nb[y])
        key = np.concatenate(where) * (SIDE * SIDE) + np.concatenate(pair)
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.diff(key, prepend=-1))
        self.times = np.add.reduceat(np.concatenate(times)[order], head) if len(head) else np.zeros(0, np.int64)
        self.pairs = (key[head] % (SIDE * SIDE)).astype(np.uint32)
        self.kinds = np.bincount(key[head] // (SIDE * SIDE), minlength=count)

    def _texts_of_groups(self, a, b, last_a, last_b, group_a, group_b, in_a, in_b) -> list[bytes]:
        """Digest of `a1,a2|b1;a3|b2,b3` of each text."""
        begin = np.cumsum(in_a + in_b) - in_a - in_b
        code = np.zeros(len(a) + len(b), np.int64)
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[last_a], end_b[last_b] = SIDE, 2 * SIDE
        code[np.arange(len(a)) - (last_a - in_a + 1)[group_a] + begin[group_a]] = a + end_a
        code[np.arange(len(b)) - (last_b - in_b + 1)[group_b] + (begin + in_a)[group_b]] = b + end_b
        to = np.cumsum(self.n_a + self.n_b)
        words = _words()
        return [hashlib.sha256(words[code[x:y]].tobytes().replace(b"\0", b"")[:-1]).digest() if y > x else b"" for x, y in zip((to - self.n_a - self.n_b).tolist(), to.tolist())]


@lru_cache(maxsize=1)
def _words() -> np.ndarray:
    """Ids in decimal followed by a comma, a bar (from 65536 on) or a semicolon (from 131072 on)."""
    return np.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(SIDE)])


_CHUNK = pa.schema([("chunk_id", pa.int64()), ("n_docs", pa.int32()), ("ids", pa.binary()), ("stats", pa.binary()), ("shas", pa.list_(pa.binary())), ("kinds", pa.binary()),
                    ("which", pa.binary()), ("times", pa.binary()), ("pairs", pa.binary()), ("docs", pa.binary())])
CHUNK_SCHEMA = "chunk_id long, n_docs int, ids binary, stats binary, shas array<binary>, kinds binary, which binary, times binary, pairs binary, docs binary"


def _chunk(ids: list[int], parts: list[Aligned]) -> pa.RecordBatch:
    pairs, which = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    stats = np.concatenate([np.stack([p.n_a, p.n_b, p.n_groups, p.n_links]) for p in parts], axis=1)
    which = which.astype(np.uint32)
    row = [int.from_bytes(os.urandom(7), "little"), len(ids), np.array(ids, np.int64).tobytes(), stats.astype(np.int64).tobytes(), [s for p in parts for s in p.shas], pack(np.concatenate([p.kinds for p in parts]).astype(np.int64)),
           pack(np.diff(which, prepend=np.uint32(0))), pack(np.concatenate([p.times for p in parts]).astype(np.int64)), pack(np.diff(pairs, prepend=np.uint32(0))), pack(np.bincount(which, minlength=len(pairs)).astype(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)


def _align(folder: str, chunk_bytes: int):
    def run(batches):
        tok = load(folder)
        ids, parts, size = [], [], 0
        for some, texts in _pieces(batches):
            ids += some
            parts.append(Aligned(texts, tok))
            size += sum(map(len, texts))
            if size >= chunk_bytes:
                yield _chunk(ids, parts)
                ids, parts, size = [], [], 0
        if ids:
            yield _chunk(ids, parts)
    return run


def _pieces(batches):
    """Bounded lists of (ids, texts), over the bounds of batches."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if ids and size + len(t) > PIECE:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(NULL_ID if i is None else i)
                texts.append(t)
                size += len(t)
    if ids:
        yield ids, texts


def _ascending(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint32), dtype=np.uint32)


_PAIRS = pa.schema([("chunk_id", pa.int64()), ("pair", pa.int64()), ("docs", pa.int64())])


def _send(batches):
    for row in rows_of(batches):
        pairs = _ascending(row["pairs"]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["chunk_id"])), pa.array(pairs), pa.array(unpack(row["docs"], np.int64))], schema=_PAIRS)


OUT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


def _finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of a chunk's documents, given the corpus counts of its pairs."""
    if not chunk.num_rows:
        return _OUT.empty_table()
    row = chunk.to_pylist()[0]
    ids, stats = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["stats"], np.int64).reshape(4, -1)
    order = np.argsort(answers["pair"].to_numpy())  # as the chunk's own pairs stand
    count, best = answers["count"].to_numpy()[order], answers["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
    which, times, kinds = _ascending(row["which"]), unpack(row["times"], np.int64), unpack(row["kinds"], np.int64)
    to = np.cumsum(kinds)

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values * times)])
        return total[to] - total[to - kinds]

    n_best, count_sum = (per_text(v[which]) if len(which) else np.zeros(len(ids), np.int64) for v in (best, count))
    shas = [s.hex() for s in row["shas"]]
    return pa.table([pa.array(ids, mask=ids == NULL_ID), *map(pa.array, (*stats, n_best, count_sum)), pa.array(shas, pa.string())], schema=_OUT)


def align_tokenizers(docs: DataFrame, tokenizers: str = TOKENIZERS, chunk_bytes: int = CHUNK) -> DataFrame:
    """Align the tokens of byte_bpe_50k.json (A, of space + text) and piece_bpe_32k.model (B, of text) in every whole text of ``docs``.

    A's merges are run by a second library with the vocabulary of A's file, which gives the same ids in a quarter of the time. ``tokenizers``: the folder of both files, the same on all executors. Result, one row per document: doc_id, n_a, n_b (tokens), n_groups, n_links (pairs
    of tokens in a group), n_best (links whose pair is in as many documents as any pair of its A id), count_sum (over
    links: documents that hold the pair linked), groups_sha256. Texts that are null or empty, or that a tokenizer does not give back byte by byte, have
    no tokens: zeros and ''. Repeated rows are documents of their own; rows without an id count, too. A very long text is tokenised in
    parts cut at spaces and aligned whole; a group of many tokens counts by its distinct ids. An empty table has no rows. Other columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("data"))
    chunks = scratch(rows.mapInArrow(_align(tokenizers, chunk_bytes), CHUNK_SCHEMA), "aligned")
    sent = chunks.select("chunk_id", "pairs", "docs").mapInArrow(_send, "chunk_id long, pair long, docs long")
    side = F.expr(f"pair div {SIDE}").alias("side")
    counts = scratch(sent.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("side", side), "pair-counts")
    highest = F.broadcast(counts.groupBy("side").agg(F.max("count").alias("highest")))  # at most one row for each id of A
    counts = counts.join(highest, "side").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = sent.select("chunk_id", "pair").join(counts, "pair")
    return chunks.groupBy("chunk_id").cogroup(answers.groupBy("chunk_id")).applyInArrow(_finish, OUT_SCHEMA)
