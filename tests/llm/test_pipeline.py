import corpus_pipeline as P
import __spark_entry__ as E
from cartwheel.llm.decontaminate import decontaminate
from cartwheel.llm.minhash_dedup import near_duplicates
from cartwheel.llm.quality import quality_scores

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_their_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5
    step = P.quality(spark, docs, SF)
    assert ids(step) == ids(quality_scores(docs, labels).where("predicted = 1"))
    assert step.columns == docs.columns
    last, step = step, P.near_duplicates(spark, step, SF)
    assert ids(step) == ids(near_duplicates(last, shingle=5, percent=80).where("kept")) and step.columns == docs.columns
    last, step = step, P.decontamination(spark, step, SF)
    assert ids(step) == ids(decontaminate(last, bench).where("NOT contaminated")) and step.columns == docs.columns
    last, step = step, P.mixture(spark, step, SF)
    assert set(ids(step)) == set(ids(last)) and step.columns == docs.columns
    out = P.shards(spark, step, SF)
    assert ids(out) == ids(step) and {r.shard for r in out.select("shard").collect()} <= set(range(16))
    assert ids(P.run(spark, SF)) == ids(step)


def test_stages_stand_odd_rows_and_empty_tables(spark, documents, odd_rows):
    for rows in (odd_rows, []):
        docs = documents(rows)
        for _, stage in P.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()


def test_entry_registers_each_operator_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in E.queries()
