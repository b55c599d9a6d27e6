import hashlib
import random
import re

import numpy as np
import pytest

from cartwheel.llm.exact_dedup import build_mph, digests, exact_dedup, find_slots
from cartwheel.llm.substring_dedup import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_mph_is_minimal_perfect_and_byte_checked():
    keys = np.frombuffer(b"".join(hashlib.sha256(b"%d" % k).digest() for k in range(5000)), np.uint64).reshape(-1, 4)
    levels = build_mph(keys)
    assert sorted(find_slots(levels, keys)) == list(range(5000))
    others = np.frombuffer(b"".join(hashlib.sha256(b"o%d" % k).digest() for k in range(500)), np.uint64).reshape(-1, 4)
    slot = find_slots(levels, others)
    table = np.empty_like(keys)
    table[find_slots(levels, keys)] = keys
    assert not (table[slot[slot >= 0]] == others[slot >= 0]).all(axis=1).any()


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [0, 5, 120, 1000])
def test_exact_dedup_whatever_the_history(documents, odd_rows, split):
    rows = digests(documents(odd_rows))
    old = rows.where(f"coalesce(doc_id < {split}, false)")
    got = exact_dedup(old, rows.where(f"NOT coalesce(doc_id < {split}, false)")).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=str) == brute_exact(odd_rows)


def test_exact_dedup_of_empty_tables(documents):
    rows = digests(documents([]))
    assert exact_dedup(rows, rows).count() == 0


def brute_substring(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    owner = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and owner[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def planted(seed, docs=60, window=10):
    rng = random.Random(seed)
    passages = [[f"p{k}_{j}" for j in range(rng.randint(window - 2, 3 * window))] for k in range(6)]
    rows = []
    for i in rng.sample(range(1000), docs):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 12))]
            if rng.random() < 0.7:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                parts += p[a:rng.randint(a, len(p))]
            parts += ["the"] * rng.choice([0, 0, 0, 15])
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_equals_brute_force(documents, seed):
    rows = planted(seed)
    got = substring_dedup(documents(rows, 4), window=10, block=5, chunk_bytes=2000, bytes_per_bucket=1500).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute_substring(rows, 10)
    for r in got:
        assert sum(b - a for a, b in r.spans) == r.n_removed


def test_substring_dedup_of_odd_rows(documents, odd_rows):
    got = substring_dedup(documents(odd_rows), window=10, block=5, chunk_bytes=4000, bytes_per_bucket=50_000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute_substring(odd_rows, 10)


def test_substring_dedup_of_an_empty_table(documents):
    assert substring_dedup(documents([])).count() == 0


def test_blocks_that_could_miss_a_repeat_are_refused(documents):
    with pytest.raises(ValueError):
        substring_dedup(documents([]), window=50, block=26)
