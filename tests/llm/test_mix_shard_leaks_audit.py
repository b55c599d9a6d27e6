import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cartwheel.llm.decontaminate import clean_documents, decontaminate
from cartwheel.llm.fixity import Tree, audit, manifest, record_bytes, replica, seen_by
from cartwheel.llm.mixing import mix, period, smoothed_parts
from cartwheel.llm.sharding import schedule, shard_documents, shard_table


@pytest.mark.parametrize("parts", [{"a": 1}, {"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 50, "b": 33, "c": 11, "d": 5, "e": 1}])
def test_every_prefix_is_less_than_a_block_from_its_share(parts):
    total, seen = sum(parts.values()), Counter()
    plan = period(parts)
    assert len(plan) == total
    for t, (s, j) in enumerate(plan, 1):
        assert seen[s] == j
        seen[s] += 1
        for name, a in parts.items():
            assert abs(seen[name] - Fraction(a * t, total)) < 1
    assert dict(seen) == parts


def brute_mix(counts, parts, block):
    """Earliest deadline first, slot by slot, until each source has been read once."""
    total, blocks = sum(parts.values()), {s: -(-n // block) for s, n in counts.items()}
    done, out, t = Counter(), [], 0
    while any(done[s] < blocks[s] for s in counts):
        ready = [(-(-(done[s] + 1) * total // a), s) for s, a in parts.items() if done[s] * total // a <= t]
        _, s = min(ready)
        out.append((t, s, done[s] % blocks[s], done[s] // blocks[s]))
        done[s] += 1
        t += 1
    return out


@pytest.mark.parametrize("parts", [{"x": 5, "y": 3, "": 2}, {"x": 1, "y": 8, "": 1}, None])
def test_mix_equals_slot_by_slot_scheduling(documents, parts):
    rows = [(k, f"t{k}", ("x", "x", "x", "y", None)[k % 5]) for k in range(230)] + [(None, None, "y"), (7, "t7", "x"), (7, "t7", "x")]
    docs = documents([(i, t, s) for i, t, s in rows])
    got = mix(docs, parts, block_rows=4).collect()
    counts = Counter(s or "" for _, _, s in rows)
    want = brute_mix(counts, parts or smoothed_parts(counts), 4)
    assert sorted({(r.slot, r.source or "", r.block, r.epoch) for r in got}) == want
    every = Counter((r.doc_id, r.text, r.source) for r in got if r.epoch == 0)
    assert every == Counter(rows)
    places = defaultdict(list)
    for r in got:
        places[r.slot].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_mix_refuses_a_source_without_weight_and_stands_an_empty_table(documents):
    with pytest.raises(ValueError):
        mix(documents([(1, "a", "x"), (2, "b", "y")]), {"x": 1})
    assert mix(documents([])).count() == 0


def test_schedule_is_longest_first_to_the_least_loaded():
    assert schedule([(2, "c"), (5, "a"), (4, "b"), (2, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_shards_hold_groups_together_and_balance(documents, odd_rows):
    rng = random.Random(1)
    rows = [*odd_rows[:6], *((k, "x" * rng.randint(0, 3000)) for k in range(1000, 1800)), *((k, "hot" * 20) for k in range(2000, 2300)), (None, "é"), (None, "é"), (5, "one two")]
    got = shard_table(documents(rows), 8).collect()
    text = Counter()
    for i, t in rows:
        text[(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == text
    where, load, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in got:
        where[r.size, r.text_crc32].add(r.shard)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in where.values()) and set(load) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values())
    docs = documents(rows)
    out = shard_documents(docs, 8)
    assert out.columns == [*docs.columns, "shard"] and out.count() == len(rows)
    assert shard_documents(docs.withColumn("shard", F.lit("own")), 8).dtypes == out.dtypes
    clash = mix(docs.withColumn("slot", F.lit("own")))
    assert clash.dtypes == mix(docs).dtypes
    assert shard_table(documents([])).count() == 0


ITEM = "On Monday the baker Anna sold 12 loaves and 3 cakes, and then Anna walked 5 km to the old mill before the long night began."
CASES = {
    1: ("before " + ITEM + " after", True),
    2: ("Intro text. " + ITEM.replace("12", "40").replace("Anna", "Maria").replace("5 km", "7 miles"), True),  # new values, equal ones still equal
    3: ("Intro text. " + ITEM.replace("Anna sold", "Maria sold"), True),  # only windows with both names are inconsistent
    4: ("on monday the baker sold bread and cakes and then walked to the old mill before the night", False),
    5: ("12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27", False),
    6: (None, False), 7: ("", False), 8: ("short one", False),
    9: ("x " + " ".join(ITEM.split()[:12]), False),  # twelve tokens are no window
}


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM, 0), (2, "A short question of only nine tokens for all", 0), (3, None, 0), (4, "", 0), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", 0), (1, ITEM, 0)]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long")


def test_leaks_are_found_and_clean_texts_left_alone(documents, benchmark):
    docs = documents([(k, t) for k, (t, _) in CASES.items()] + [(20, "so: a short question of only nine tokens for all, is it?"), (None, ITEM), (None, "clean")])
    got = {r.doc_id: r for r in decontaminate(docs, benchmark).collect()}
    assert {k: got[k].contaminated for k in CASES} == {k: bad for k, (_, bad) in CASES.items()}
    assert got[20].contaminated and got[20].item_id == 2 and got[None].contaminated
    assert got[1].item_id == 1 and got[4].item_id == -1 and got[1].n_hits > got[3].n_hits
    kept = clean_documents(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, (_, bad) in CASES.items() if not bad}


def test_inconsistent_slots_are_no_hit(documents, spark):
    item = "the sum of 5 and 7 and 5 again is what the child wrote on the board"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents([(1, item.replace("5", "9").replace("7", "2")), (2, "the sum of 9 and 2 and 8 again is what the child"), (3, "the sum of 9 and 9 and 9 again is what the child")])
    assert {r.doc_id: r.contaminated for r in decontaminate(docs, bench).collect()} == {1: True, 2: False, 3: False}


SHORT = {1: "What is the capital of France?", 2: "Yes", 3: "12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27", 4: "法国的首都是哪里？", 5: "5 + 3", 6: "Anna met Bob near Rome and Tom saw Eva in Ulm with Max and Ida at Bonn"}


def test_items_below_the_literal_bound_are_found_word_for_word(documents, spark):
    bench = spark.createDataFrame([*SHORT.items(), (7, "?!")], "item_id long, text string")
    docs = documents([(k, f"so then {t} ok") for k, t in SHORT.items()] + [(20, "what is the capital of Spain?"), (21, "22 13 14 15 16 17 18 19 20 21 32 23 24 25 26 27"), (22, "5 - 3"),
                     (23, "法国的首都在哪里"), (24, "?!"), (25, ""), (26, "我问：法国的首都是哪里？请回答")])
    got = {r.doc_id: r for r in decontaminate(docs, bench).collect()}
    assert {k: (got[k].contaminated, got[k].item_id) for k in SHORT} == {k: (True, k) for k in SHORT}
    assert {k: got[k].contaminated for k in range(20, 27)} == {20: False, 21: False, 22: False, 23: False, 24: False, 25: False, 26: True}


APPLES = "Anna has 5 apples. Anna gives 2 apples to a friend. Anna eats 1 apple. How many apples does Anna have left?"
TRAIN = "The train from New York leaves at noon and the bus from the old harbour leaves two hours later."


def test_names_are_found_wherever_they_stand(documents, spark):
    other = APPLES.replace("Anna", "Tom").replace("5", "9").replace("2", "3").replace("1", "4")
    bench = spark.createDataFrame([(1, APPLES), (2, TRAIN)], "item_id long, text string")
    found = {1: "Quiz: " + other, 2: other.replace("Tom", "Mary Ann Smith"), 3: other.replace("Tom", "TOM"), 4: other.replace(" ", "  ").replace(".  ", ".\n"),
             5: APPLES.lower(), 6: APPLES.upper(), 7: TRAIN.replace("New York", "Paris"), 8: TRAIN.replace("from New", "from\nNew").replace("York", "Delhi")}
    clean = {20: "Tom has 9 pears. Tom buys 3 pears in the shop. Mia eats 4 of them. How many pears does Tom have left?", 21: "THE BUS FROM NEW YORK", 22: " ".join(["Anna"] * 30)}
    got = {r.doc_id: r for r in decontaminate(documents([*found.items(), *clean.items()]), bench).collect()}
    assert {k: got[k].item_id for k in got} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 2, 8: 2, 20: -1, 21: -1, 22: -1}


def test_short_items_are_found_with_other_values(documents, spark):
    items = {1: "What is 12 times 7?", 2: "How many apples does Anna have if she buys 5 and eats 2?", 3: "Add 5 and 7.", 4: "Anna 5 Bob 7 it"}
    bench = spark.createDataFrame([*items.items()], "item_id long, text string")
    docs = documents([(1, "quiz: What is 15 times 9? end"), (2, "so: How many apples does Tom have if she buys 7 and eats 3? ok"), (3, "Add 8 and 3 now"), (4, "Tom 3 Eva 2 it"), (5, "what is many times seven")])
    got = {r.doc_id: r.item_id for r in decontaminate(docs, bench).collect()}
    assert got == {1: 1, 2: 2, 3: -1, 4: -1, 5: -1}  # the last two items have too few words of their own


def test_sieve_never_changes_the_result(spark, documents, monkeypatch):
    """Texts whose words the readings cut in different ways, and a very long one, with and without the sieve and its join."""
    import cartwheel.llm.decontaminate as d

    items = [ITEM, APPLES, TRAIN, "The well-known rule of thumb for the old harbour says that nobody leaves early at all", "Le café à côté du marché ouvre à huit heures chaque jour de la semaine sauf lundi"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    odd = []
    for t in items:
        odd += [t, t.upper(), t.replace(" ", "\n"), t.replace("-", ""), t.replace(" the ", " the(5) "), t.replace(" ", "\x01"), t.replace(" ", " \u00b7 "), "x" + t, "e.g." + t, "9" + t, f"({t})", t.replace("e", "e\u0301"), "w " * 200_000 + t]
    docs = documents([*enumerate(odd), (900, None), (901, ""), (902, "nothing here"), (None, ITEM)])
    want = None
    for change in ({}, {"MAX_KEYS": 0}, {"sieved": lambda rows, *_: rows.select("doc_id", "text")}):
        with monkeypatch.context() as m:
            for name, value in change.items():
                m.setattr(d, name, value)
            got = sorted(map(tuple, d.decontaminate(docs, bench).collect()), key=str)
        want = want or got
        assert got == want
    assert sum(r[1] for r in want) > len(odd) * 0.6
    assert d.sieved(docs, bench, 13).where("doc_id = 902").count() == 0


def test_empty_benchmark_and_empty_documents(documents, benchmark):
    assert {r.contaminated for r in decontaminate(documents([(1, ITEM)]), benchmark.limit(0)).collect()} == {False}
    assert decontaminate(documents([]), benchmark).count() == 0


@pytest.fixture
def pages(spark):
    rows = [(k, f"http://x/{k}", "é" * (k % 50)) for k in range(700)] + [(None, "u", "lost id"), (None, None, None), (5, "http://x/5", "other five"), (701, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_manifest_offsets_and_digests(pages):
    rows = replica(pages, 64).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.volume].append(r)
    got = {(r.volume, r.place): r for r in manifest(replica(pages, 64)).collect()}
    assert len(got) == len(rows)
    for v, part in by.items():
        part.sort(key=lambda r: (r.page_id is not None, r.page_id or 0, hashlib.sha256(r.record).hexdigest()))
        at = 0
        for k, r in enumerate(part):
            assert (got[v, k].offset, got[v, k].length, got[v, k].digest) == (at, len(r.record), hashlib.sha256(r.record).hexdigest())
            at += len(r.record)


def test_record_has_its_length(spark):
    row = spark.range(1).select(record_bytes(F.lit(3), F.lit("http://é"), F.lit("aé")).alias("r")).first()
    assert bytes(row.r) == "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:3>\r\nWARC-Target-URI: http://é\r\nContent-Length: 3\r\n\r\naé\r\n\r\n".encode()


@pytest.mark.parametrize("damage", [set(), {(0, 3)}, {(0, 0), (3, 17), (10, 59), (5, 5), (5, 6)}])
def test_audit_finds_exactly_the_damaged_records(pages, damage):
    records = replica(pages, 64)
    listed = manifest(records)
    placed = records.withColumn("digest", F.sha2("record", 256)).join(listed.select("volume", "place", "offset", "digest"), ["volume", "digest"])
    placed = placed.select("volume", "place", "offset", "record").dropDuplicates(["volume", "place"])
    bad = F.lit(False)
    for v, p in damage:
        bad = bad | ((F.col("volume") == v) & (F.col("place") == p))
    copy = placed.withColumn("record", F.when(bad & (F.col("place") % 2 == 0), F.lit(None)).when(bad, F.concat(F.col("record"), F.lit(b"!"))).otherwise(F.col("record")))
    found = audit(Tree(listed, "a"), Tree(seen_by(listed, copy), "b"))
    assert {(r.volume, r.place) for r in found.collect()} == damage


def test_audit_of_empty_archives(pages):
    listed = manifest(replica(pages.limit(0)))
    assert audit(Tree(listed, "a"), Tree(listed, "b")).count() == 0
