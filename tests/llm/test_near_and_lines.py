import random
import re

import pytest

from cartwheel.llm import common, minhash_dedup
from cartwheel.llm.line_dedup import MIN_CHARS, drop_lines, line_dedup, within
from cartwheel.llm.minhash_dedup import components, distinct_documents, groups_for, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def closure(names, linked):
    label = {x: x for x in names}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(label[a], label[b])
            for x in (a, b):
                if label[x] != m:
                    label[x], changed = m, True
    return label


def brute_near(rows, k, percent):
    sets = {(i, t): shingles(t, k) for i, t in rows}
    names = [x for x in sets if x[0] is not None and sets[x]]
    linked = [(a[0], b[0]) for a in names for b in names if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = closure({x[0] for x in names}, linked)
    return sorted(((i, len(sets[i, t]), label.get(i, i), label.get(i, i) == i) for i, t in rows), key=str)


def near_rows(seed):
    rng = random.Random(seed)
    rows, ids = [], rng.sample(range(10_000), 120)
    bases = [[f"{rng.choice('abcdef')}{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))] for _ in range(12)]
    for i in ids:
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 99)}"
        rows.append((i, " ".join(x.upper() if rng.random() < 0.1 else x for x in w)))
    return rows


@pytest.mark.parametrize("seed,k,percent", [(0, 3, 85), (1, 3, 85), (2, 5, 80)])
def test_near_duplicates_equal_brute_force(documents, seed, k, percent):
    rows = near_rows(seed)
    got = near_duplicates(documents(rows, 4), shingle=k, percent=percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == brute_near(rows, k, percent)


def test_near_duplicates_of_odd_rows(documents, odd_rows):
    got = near_duplicates(documents(odd_rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == brute_near(odd_rows, 3, 85)
    assert near_duplicates(documents([])).count() == 0


def test_a_large_group_linked_through_its_base_only(documents):
    """Copies with different edits are linked with the base, not with each other: pivots must find the base."""
    base = [f"w{k}" for k in range(100)]
    rows = [(500, " ".join(base))]
    for k in range(60):
        w = list(base)
        for j in (k % 33 * 3, (k * 7 + 50) % 100):
            w[j] = f"edit{k}"
        rows.append((k, " ".join(w)))
    got = near_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == brute_near(rows, 3, 85)


def plan_of(df):
    """The plan as it ran, with joins that adaptive execution turned into broadcasts."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_table_that_grows_with_the_documents_is_broadcast(documents, monkeypatch):
    """All tables here are far below Spark's broadcast limit; only the few hot groups of the last join may go through the driver."""
    plans = {}

    def stored(df, label):
        plans.setdefault(label, []).append(plan_of(df))
        return common.scratch(df, label)

    monkeypatch.setattr(minhash_dedup, "scratch", stored)
    last = plan_of(near_duplicates(documents(near_rows(3))))
    assert {"halves", "members", "sets", "open", "pivots", "links", "star", "sketches", "components"} <= set(plans)
    assert [label for label, found in plans.items() if any("BroadcastHashJoin" in p for p in found)] == []
    assert "SortMergeJoin" in last and last.count("BroadcastHashJoin") <= 4  # two, in the plan as run and as first made
    kept = plan_of(distinct_documents(documents(near_rows(3))))
    assert re.search(r"SortMergeJoin.*LeftAnti", kept)


def test_distinct_documents_keep_all_columns(documents):
    docs = documents(near_rows(5))
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _, k in brute_near(near_rows(5), 3, 85) if k)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 1 for k in range(2, 41)) and all(got[k] == 100 for k in range(101, 130))


def test_groups_bound_the_loss():
    for s, r in ((0.85, 2), (0.8, 2), (0.9, 3)):
        g = groups_for(s, r)
        assert (1 - (1 - s ** r) ** g) ** 2 > 1 - 1e-5


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_equals_the_full_table(edits):
    rng = random.Random(edits)
    for _ in range(3000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
        b = "".join(b)
        assert within(a, b, edits) == (distance(a, b) <= edits), (a, b)


def brute_lines(rows, edits):
    text = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n") if t else []):
            if line.strip(" "):
                text.setdefault(line, []).append((2**63 - 1 if i is None else i, k))
    names = list(text)
    linked = [(a, b) for a in names for b in names if a < b and len(a) >= MIN_CHARS <= len(b) and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits]
    label = closure(names, linked)
    first = {}
    for x in names:
        first[label[x]] = min(first.get(label[x], (2**64, 0)), *text[x])
    out = []
    for i, t in rows:
        lines = t.split("\n") if t else []
        gone = [k for k, x in enumerate(lines) if x.strip(" ") and (2**63 - 1 if i is None else i, k) != first[label[x]]]
        out.append((i, len(lines), len(gone), gone))
    return sorted(out, key=str)


def line_rows(seed):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcde fgé") for _ in range(rng.randint(15, 40))).strip() for _ in range(15)] + ["", "short", "ends here\r"]
    rows = []
    for i in rng.sample(range(500), 40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            b = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                k = rng.randint(0, len(b))
                b[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
            lines.append("".join(b))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(documents, seed):
    rows = line_rows(seed)
    got = line_dedup(documents(rows, 4), bytes_per_bucket=500).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.removed_lines) for r in got), key=str) == brute_lines(rows, 2)


def test_line_dedup_of_odd_rows(documents, odd_rows):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 10_000] + [(900, "x" * 50_000 + "\n" + "x" * 49_999 + "\n" + "y" * 30)]
    got = line_dedup(documents(rows)).collect()
    want = brute_lines([r for r in rows if r[0] != 900], 2) + [(900, 3, 1, [1])]
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.removed_lines) for r in got), key=str) == sorted(want, key=str)
    assert line_dedup(documents([])).count() == 0


def test_drop_lines(documents):
    docs = documents([(1, "a line of twenty characters\nother"), (2, "other\na line of twenty characterz\nnew")])
    out = {r.doc_id: r.text for r in drop_lines(docs, line_dedup(docs)).collect()}
    assert out == {1: "a line of twenty characters\nother", 2: "new"}
