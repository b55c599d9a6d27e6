import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.llm.language_id import Automaton, labelled_sample, language_ids, predict
from cartwheel.llm.merkle_manifest import Block, levels_to_root, merkle_manifest
from cartwheel.llm.tokenizer_alignment import TOKENIZERS, align, align_tokenizers, cut, load

SF = "/root/testdata/sf0.01"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[k:k + fan]) for k in range(0, len(below), fan)])
    return levels


def brute_manifest(rows, fan):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def leaf(r, more=0):
        r = (*r[:3], None if r[3] is None else r[3] + more, r[4])
        return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def hit(r):
        return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0

    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: brute_tree([e[2] for e in sorted(by[x], key=lambda e: e[:3])], fan) for x in langs}
    top = brute_tree([trees[x][-1][0] for x in langs], fan)
    out = []
    for k, x in enumerate(langs):
        for i, (_, _, own, r) in enumerate(sorted(by[x], key=lambda e: e[:3])):
            sib, h = [], leaf(r, 1) if hit(r) else own
            for levels, at in ((trees[x], i), (top, k)):
                for nodes in levels[:-1]:
                    run = at - at % fan
                    left, right = nodes[run:at], nodes[at + 1:run + fan]
                    sib += left + right
                    h = H(*left, h, *right)
                    at //= fan
            out.append((r[0], own, trees[x][-1][0], top[-1][0], H(*sib), h, h == top[-1][0]))
    return Counter(out)


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, key string, place long, n long, root string"


@pytest.mark.parametrize("fan,depth", [(2, 10), (2, 2), (3, 2), (5, 1)])
def test_manifest_against_a_plain_tree(spark, fan, depth):
    rng = random.Random(fan * 10 + depth)
    rows = [(k, rng.choice(["a", "é", None, ""]), "en" if k % 3 else rng.choice(["de", "", None, "fr"]), rng.choice([None, 5, 12]), rng.choice(["", None, "täxt", "x" * 5000])) for k in range(160)]
    rows += [(None, None, None, None, None), (None, "s", "en", 3, "t"), (None, "s", "en", 3, "t"), (7, "s", "en", 3, "t"), (7, "s", "en", 3, "t"), (14, "s", "lone", (1 << 63) - 1, "t"), (-5, "s", "zz", -1, "t")]
    table = spark.createDataFrame([(*r, "k", 1, 2, "r") for r in rows], MANIFEST).repartition(5)
    got = merkle_manifest(table, fan, depth).collect()
    assert Counter(map(tuple, got)) == brute_manifest(rows, fan)
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_manifest_of_few_rows(spark):
    table = spark.createDataFrame([(3, "s", "en", 1, "t", "k", 1, 2, "r")], MANIFEST)
    (r,) = merkle_manifest(table).collect()
    assert r.root == r.subroot == r.leaf == r.folded_root and r.verified and r.proof_sha256 == H()
    assert merkle_manifest(table.limit(0)).count() == 0


@given(st.integers(1, 40), st.integers(2, 5), st.data())
def test_folding_resumes_the_state_before_the_slot(n, fan, data):
    nodes = [H(str(k)).encode() for k in range(n)]
    block = Block(nodes, levels_to_root(n, fan), fan)
    assert block.root.decode() == brute_tree([x.decode() for x in nodes], fan)[-1][0]
    i = data.draw(st.integers(0, n - 1))
    other = [*nodes[:i], H("other").encode(), *nodes[i + 1:]]
    assert block.fold(i, other[i]) == Block(other, levels_to_root(n, fan), fan).root and block.fold(i, nodes[i]) == block.root


# --- language ---------------------------------------------------------------------------------

def brute_phrases(text, labelled):
    at = count = 0
    while at < len(text):
        to = at + 1
        while to < len(text) and text[at:to + 1] in labelled:
            to += 1
        at, count = to, count + 1
    return count


@settings(deadline=None)
@given(st.text("abc ", min_size=1, max_size=60), st.text("abcd é", max_size=60))
def test_phrases_are_longest_matches(labelled, text):
    a, b = labelled.encode(), text.encode()
    assert Automaton(a).phrases(b) == brute_phrases(b, a)


def test_cheapest_language_wins():
    models = [("aa", Automaton(b"the cat and the dog")), ("bb", Automaton(b"der hund und die katze"))]
    assert predict(b"the dog and the cat", models)[0] == "aa" and predict(b"die katze und der hund", models)[0] == "bb"
    assert predict(b"\xff", models)[0] == "aa"  # one phrase in both; the shorter text is the cheaper one
    lang, score = predict(b"zzzz", [("x", Automaton(b"ab")), ("y", Automaton(b"cd"))])
    assert lang == "x" and score == 0.5


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_ids(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 150 and (held.lang_pred == held.lang).mean() > 0.97
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all() and got.score.between(0, 1).all()


def test_predictions_use_texts_and_other_folds_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).cache()
    one = {r.doc_id: tuple(r) for r in language_ids(docs).collect()}
    held = F.expr("crc32(encode(cast(doc_id as string), 'utf-8')) % 5 = 0")
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id: tuple(r) for r in language_ids(other.repartition(7)).collect()} == one


def test_language_of_odd_rows(spark, documents, odd_rows):
    docs = documents([*odd_rows, (900, "123 456 !?"), (901, "ภาษา"), (902, "der " * 5), (903, "die das der und ein " * 3)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") > 900, "de").when(F.col("doc_id") == 900, None).otherwise(F.col("lang")))
    got = language_ids(docs).collect()
    assert len(got) == len(odd_rows) + 4
    for r in got:
        assert (r.held_out is None) == (r.doc_id is None) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 900) or (r.doc_id is None and r.lang_pred == "und"))
    assert sum(r.lang_pred == "und" for r in got if r.doc_id is None) == 1  # the null text
    assert {r.lang_pred for r in language_ids(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_ids(documents([])).count() == 0


def test_sample_is_bounded_and_distinct(spark, documents):
    docs = documents([(k, f"same words {"abcdefg"[k % 7]} only " * 3) for k in range(400)] + [(k, "very long text " * 500) for k in range(400, 420)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") >= 400, "long").otherwise("en"))
    got = dict(labelled_sample(docs, train_bytes=200, all_bytes=1000))
    assert set(got) == {"en", "long"} and all(len(t) <= 200 + 10 for t in got.values())
    assert len(set(got["en"].split(b"\n"))) == len(got["en"].split(b"\n"))
    assert all(len(t) <= 60 for t in dict(labelled_sample(docs, train_bytes=200, all_bytes=100)).values())


# --- tokenizers -------------------------------------------------------------------------------

def brute_align(ends_a, ends_b):
    in_a, in_b = ({x: k for k, x in enumerate(e)} for e in (ends_a, ends_b))
    both = sorted(in_a.keys() & in_b.keys())
    return [in_a[x] for x in both], [in_b[x] for x in both]


@settings(deadline=None)
@given(st.integers(1, 120), st.data())
def test_runs_and_irregular_groups(n, data):
    ends = [sorted({n, *data.draw(st.lists(st.integers(1, n), max_size=120))}) for _ in "ab"]
    got = align(*(np.array(e, np.int64) for e in ends))
    assert tuple(x.tolist() for x in got) == brute_align(*ends)


def test_long_runs():
    a = np.arange(1, 5001)
    got = align(a, np.delete(a, [0, 777, 778, 4000]))
    assert tuple(x.tolist() for x in got) == brute_align(a.tolist(), np.delete(a, [0, 777, 778, 4000]).tolist())


@pytest.fixture(scope="module")
def slow_a():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    out.encode_special_tokens = True
    return out


def test_ids_of_every_character(slow_a):
    tok = load(TOKENIZERS)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for size in (1, 7):  # alone between letters, digits and marks, and in runs
        texts = [" " + "".join(f"a{c}b {c}1{c}2 .{c}, {c}" for c in chars[k:k + size]) if size > 1 else f" x{chars[k]}y {chars[k]}  {chars[k]}{chars[k]}3's" for k in range(0, len(chars), 16 * size)]
        assert [tok.a.encode_ordinary(t) for t in texts] == [e.ids for e in slow_a.encode_batch_fast(texts, add_special_tokens=False)]


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=200))
def test_ids_of_any_text(slow_a, text):
    assert load(TOKENIZERS).a.encode_ordinary(" " + text) == slow_a.encode(" " + text, add_special_tokens=False).ids


def brute_alignment(texts, slow_a, folder=TOKENIZERS):
    """One row per text, by tokens and dictionaries."""
    tok = load(folder)
    found, pairs = [], []
    for t in texts:
        a = b = []
        if t:
            a = slow_a.encode(" " + t, add_special_tokens=False).ids
            b = tok.b.encode(t)
            want = (" " + t).encode()
            if b"".join(tok.a_bytes[i] for i in a) != want or b"".join(tok.b_bytes[i] for i in b) != want:
                a = b = []
        ends = [np.cumsum([len(side[i]) for i in ids]).tolist() for side, ids in ((tok.a_bytes, a), (tok.b_bytes, b))]
        groups, links, i, j = [], Counter(), 0, 0
        for x, y in zip(*brute_align(*ends)):
            groups.append((a[i:x + 1], b[j:y + 1]))
            for p in a[i:x + 1]:
                for q in b[j:y + 1]:
                    links[p, q] += 1
            i, j = x + 1, y + 1
        found.append((len(a), len(b), groups))
        pairs.append(links)
    count = Counter(p for links in pairs for p in links)
    best = {}
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for (n_a, n_b, groups), links in zip(found, pairs):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()), H(text) if n_a else ""))
    return out


def test_alignment_against_plain_loops(spark, documents, odd_rows, slow_a):
    rng = random.Random(5)
    some = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    odd = ["<|endoftext|> and <s> </s> <0x41>", "a▁b", "▁", " ", "  two", "x  ", "ภาษา \U0001f600\U0001f601‍", "tab\tand\r\nlines\n\n\n", "\x00\x01", "é é", "ﬁ", "1234567890" * 20,
           "".join(rng.choice("ab é中\U0001f600.\n") for _ in range(3000)), "\U0001f600" * 400, "word" * 9000, " ".join("q" * rng.randint(1, 9) for _ in range(9000))]
    rows = [*odd_rows, *((1000 + k, t) for k, t in enumerate(some + odd))]
    want = Counter(zip([r[0] for r in rows], brute_alignment([r[1] for r in rows], slow_a)))
    for chunk_bytes in (1, 8 << 20):
        got = align_tokenizers(documents(rows, 4), chunk_bytes=chunk_bytes).collect()
        assert Counter((r[0], tuple(r)[1:]) for r in got) == want
    assert align_tokenizers(documents([])).count() == 0
    zeros = align_tokenizers(documents([(1, None), (2, "")])).collect()
    assert {tuple(r)[1:] for r in zeros} == {(0, 0, 0, 0, 0, 0, "")}


@settings(deadline=None, max_examples=60)
@given(st.lists(st.sampled_from(["a", " ", "  ", "word", "'s", ".", "\n", "\t", " ", "é", "12", "中", "　", "\x1c"]), min_size=1, max_size=80).map("".join))
def test_parts_give_the_tokens_of_the_whole(slow_a, text):
    tok = load(TOKENIZERS)
    whole = " " + text
    parts = cut(whole, 5)
    assert "".join(parts) == whole and all(p[0] == " " for p in parts)
    a = [i for p in parts for i in tok.a.encode_ordinary(p)]
    b = [i for p in parts for i in tok.b.encode(p[1:])]
    assert a == slow_a.encode(whole, add_special_tokens=False).ids and b == tok.b.encode(text)
