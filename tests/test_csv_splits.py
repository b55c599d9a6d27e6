"""Reading one CSV file by many tasks, and chunks in file order without a key."""

import csv
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from cartwheel.sources import csv_splits
from cartwheel.sources.chunks import chunk_manifest, chunk_rows, write_chunks
from cartwheel.sources.csv_splits import FILE_ORDER, file_lines
from cartwheel.sources.csv_table import read_csv_table


@pytest.fixture
def small_splits(spark):
    """Files are cut every 97 bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    yield 97
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _folder():
    return tempfile.mkdtemp(prefix="cw-splits-")


def _write(path, rows, header=("id", "note", "more"), line="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, lineterminator=line, quoting=quoting)
        w.writerow(header)
        w.writerows(rows)
    return path


def _random_rows(seed, n):
    rnd = random.Random(seed)
    parts = ["a", '"', "\n", ",", '""', " ", "é", '",', ',"', "\r\n", "long words", "\n\n", 'x"y']
    return [(str(i), "".join(rnd.choice(parts) for _ in range(rnd.randrange(12))), rnd.choice(["", "z", 'q"', "\n"])) for i in range(n)]


@pytest.mark.parametrize("seed,line,quoting", [(1, "\n", csv.QUOTE_MINIMAL), (2, "\r\n", csv.QUOTE_MINIMAL), (3, "\n", csv.QUOTE_ALL)])
def test_splits_against_python_csv_and_multi_line(spark, small_splits, seed, line, quoting):
    rows = _random_rows(seed, 200)
    path = _write(os.path.join(_folder(), "t.csv"), rows, line=line, quoting=quoting)
    assert file_lines(spark, path).select("_block").distinct().count() > 20  # read in many pieces
    got = read_csv_table(spark, path, splits=True, positions=True).orderBy(*FILE_ORDER).collect()
    assert [tuple(r[c] or "" for c in ("id", "note", "more")) for r in got] == rows
    whole = read_csv_table(spark, path).orderBy(F.col("id").cast("int")).collect()
    # Spark's whole-file reader turns \r\n inside quotes into \n where records end in \r\n; the read by splits leaves text alone
    plain = lambda v: v if v is None or line == "\n" else v.replace("\r\n", "\n")
    assert [(r["id"], plain(r["note"]), plain(r["more"])) for r in got] == [tuple(r) for r in whole]


def test_record_over_many_splits_and_blank_lines(spark, small_splits):
    path = os.path.join(_folder(), "t.csv")
    text = "\n".join(f'line {i}, with ""quotes""' for i in range(300))
    with open(path, "w") as fh:
        fh.write('\n\nid,note\n1,"' + text + '"\n\n2,5" disk\n3,"a"\n')
    got = read_csv_table(spark, path, splits=True).orderBy("id").collect()
    assert [(r["id"], r["note"]) for r in got] == [("1", text.replace('""', '"')), ("2", '5" disk'), ("3", "a")]


def test_headers_ragged_rows_and_empty_files(spark, small_splits):
    d = _folder()
    _write(os.path.join(d, "1.csv"), _random_rows(5, 30))
    _write(os.path.join(d, "2.csv"), [])
    assert read_csv_table(spark, d, splits=True).count() == 30
    _write(os.path.join(d, "3.csv"), [("1", "a", "b")], header=("id", "more", "note"))
    with pytest.raises(Exception, match="different headers"):
        read_csv_table(spark, d, splits=True).select("id").collect()
    path = os.path.join(_folder(), "t.csv")
    with open(path, "w") as fh:
        fh.write("name,name,\n1,2,3\n4,5\n6,7,8,9\n")
    with pytest.raises(Exception, match="number of fields"):
        read_csv_table(spark, path, splits=True).select("name0").count()
    kept = read_csv_table(spark, path, on_ragged="keep", splits=True)
    assert kept.columns == ["name0", "name1", "_c2", "_corrupt_record"]
    assert sorted(r["_corrupt_record"] for r in kept.where("_corrupt_record is not null").collect()) == ["4,5", "6,7,8,9"]
    with pytest.raises(ValueError):
        read_csv_table(spark, path, positions=True)


def test_chunks_in_file_order_whatever_the_tasks(spark):
    """Repeated rows and no key: the same chunks whether the files are one task or many."""
    d = _folder()
    rows = [(str(i % 7), "same", "") for i in range(500)]
    _write(os.path.join(d, "a.csv"), rows[:300])
    _write(os.path.join(d, "b.csv"), rows[300:])
    seen = []
    for size in ("97", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        t = read_csv_table(spark, d, splits=True, positions=True)
        ch = chunk_rows(t, 64).withColumn("id", F.col("id").cast("int"))
        assert ch.columns == ["id", "note", "more", "row_no", "chunk_id"]
        assert [r["id"] for r in ch.orderBy("row_no").collect()] == [int(r[0]) for r in rows]
        seen.append(sorted(map(tuple, chunk_manifest(ch, key="id").collect())))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] and [r[1] for r in seen[0]] == [64] * 7 + [52]


def test_parquet_chunks_without_a_key(spark):
    d = _folder() + "/p"
    spark.range(5000).select((F.col("id") % 3).alias("v"), F.col("id").alias("no")).coalesce(1).write.parquet(d)
    seen = []
    for size in ("2000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        ch = chunk_rows(spark.read.parquet(d), 777)
        assert ch.where("row_no <> no + 1").count() == 0
        seen.append(sorted(map(tuple, chunk_manifest(ch).collect())))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1]
    man = write_chunks(spark.read.parquet(d), _folder() + "/out", 2500)
    assert sorted(r["n_rows"] for r in man.collect()) == [2500, 2500]


def test_runs_inside_a_split(spark, monkeypatch):
    """One split, many runs: records that go over runs, or over many of them, come out whole and in order."""
    rows = _random_rows(11, 300) + [("300", "\n".join(f'l "{i}", x' for i in range(200)), "z")] + [(str(i), "a\nb", "") for i in range(301, 400)]
    path = _write(os.path.join(_folder(), "with space.csv"), rows)
    monkeypatch.setattr(csv_splits, "RUN_BITS", 4)
    monkeypatch.setattr(csv_splits, "TASK_BYTES", 4096)
    got = read_csv_table(spark, path, splits=True, positions=True).orderBy(*FILE_ORDER).collect()
    assert [tuple(r[c] or "" for c in ("id", "note", "more")) for r in got] == rows
    assert len({r["_block"] for r in got}) == 1 and len({r["_file"] for r in got}) == 1


def test_lines_are_sorted_in_runs_and_carry_no_path(spark):
    """What a sort or a window holds is a run of a split, not a split, and no copy of the path (csv_splits over 60 times sf0.1 ran out of memory)."""
    path = _write(os.path.join(_folder(), "t.csv"), _random_rows(12, 50))
    plan = csv_splits.file_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and not any("_file" in x for x in windows)
    assert any("_part" in x for x in windows)
