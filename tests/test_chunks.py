"""Chunking (FIXTURES.md section B) and the CSV reader."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cartwheel.sources.chunks import chunk_manifest, chunk_rows, write_chunks
from cartwheel.sources.csv_table import read_csv_table


def _table(spark, n):
    return spark.createDataFrame([(i, f"name{i}") for i in range(n)], "id bigint, name string")


@pytest.mark.parametrize("n,k,sizes", [(10, 4, [4, 4, 2]), (10, 5, [5, 5]), (3, 10, [3]), (0, 4, [])])
def test_chunk_sizes(spark, n, k, sizes):
    ch = chunk_rows(_table(spark, n), k, ["id"])
    man = sorted(chunk_manifest(ch).collect(), key=lambda r: r["chunk_id"])
    assert [r["n_rows"] for r in man] == sizes
    rows = ch.orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1, n + 1))
    assert [r["id"] for r in rows] == list(range(n))


@pytest.mark.parametrize("k", [0, -1])
def test_bad_chunk_size(spark, k):
    with pytest.raises(ValueError):
        chunk_rows(_table(spark, 10), k, ["id"])


def test_row_numbers_survive_many_partitions(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 7).alias("g")).repartition(13)
    ch = chunk_rows(df, 333, ["id"])
    rows = ch.select("id", "row_no").collect()
    assert all(r["row_no"] == r["id"] + 1 for r in rows)


def test_write_chunks(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="cw-chunks-"), "out")
    man = write_chunks(_table(spark, 10), out, 4, ["id"])
    assert sorted(r["n_rows"] for r in man.collect()) == [2, 4, 4]
    dirs = sorted(glob.glob(os.path.join(out, "chunk_id=*")))
    assert [os.path.basename(d) for d in dirs] == ["chunk_id=0", "chunk_id=1", "chunk_id=2"]
    for d in dirs:
        files = [f for f in glob.glob(os.path.join(d, "*.csv"))]
        assert len(files) == 1
        with open(files[0]) as fh:
            lines = fh.read().splitlines()
        assert lines[0] == "id,name"
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 10


def test_reader_quotes_and_newlines(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cw-csv-"), "t.csv")
    with open(path, "wb") as fh:
        fh.write(b'id,name,note\r\n1,"a ""q"" b",x\r\n2,"multi\r\nline",y\r\n3,,\r\n4, pad ,z\r\n')
    rows = read_csv_table(spark, path).collect()
    assert len(rows) == 4
    assert rows[0]["name"] == 'a "q" b'
    assert "\n" in rows[1]["name"]
    assert rows[2]["name"] is None and rows[2]["note"] is None
    assert rows[3]["name"] == " pad "


def test_reader_ragged(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cw-csv-"), "r.csv")
    with open(path, "wb") as fh:
        fh.write(b"a,b,c\r\n1,2,3\r\n4,5\r\n6,7,8,9\r\n")
    with pytest.raises(Exception):
        read_csv_table(spark, path).collect()
    kept = read_csv_table(spark, path, on_ragged="keep").collect()
    bad = [r["_corrupt_record"] for r in kept if r["_corrupt_record"] is not None]
    assert sorted(b.strip() for b in bad) == ["4,5", "6,7,8,9"]


def test_duplicate_and_empty_header_names(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cw-csv-"), "d.csv")
    with open(path, "wb") as fh:
        fh.write(b"id,name,name,\r\n1,a,b,c\r\n")
    df = read_csv_table(spark, path)
    assert df.columns == ["id", "name1", "name2", "_c3"]
    assert tuple(df.collect()[0]) == ("1", "a", "b", "c")


def test_holdout_csv_replaces_validation_block(spark):
    from cartwheel.operators.split import split_two_level
    from cartwheel.sources.retail import interactions_from_csv
    path = os.path.join(tempfile.mkdtemp(prefix="cw-csv-"), "holdout.csv")
    with open(path, "w") as fh:
        fh.write("household_key,BASKET_ID,PRODUCT_ID,WEEK_NO,QUANTITY,SALES_VALUE\n"
                 "1,10,100,96,2,3.5\n2,11,101,97,1,1.25\nx,12,102,98,1,1.0\n")
    hold = interactions_from_csv(spark, path, {"user_id": "household_key", "basket_id": "BASKET_ID",
                                               "item_id": "PRODUCT_ID", "week_no": "WEEK_NO",
                                               "quantity": "QUANTITY", "sales_value": "SALES_VALUE"},
                                 on_bad="drop")
    assert hold.dtypes == [("user_id", "bigint"), ("basket_id", "bigint"), ("item_id", "bigint"),
                           ("week_no", "int"), ("quantity", "double"), ("sales_value", "double")]
    rows = hold.orderBy("user_id").collect()
    assert [(r["user_id"], r["item_id"], r["sales_value"]) for r in rows] == [(1, 100, 3.5), (2, 101, 1.25)]
    base = spark.createDataFrame([(1, 1, 5, 10, 1.0, 1.0)], hold.schema)
    _, _, val = split_two_level(base, 20, 30, holdout=hold)
    assert val.count() == 2
