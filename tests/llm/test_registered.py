"""The registered queries against their SQL, and the pipeline against its parts."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harness.compare import check, connect
from partflow.llm import catalog, toxicity
from partflow.llm.common import table
from partflow.llm.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, monkeypatch, name):
    monkeypatch.setattr("harness.compare.QUERIES", catalog.QUERIES)
    monkeypatch.setattr("harness.compare.ORACLE", ORACLE)
    verdict, _, _ = check(spark, connect(SF_DIR), SF_DIR, name)
    assert verdict.startswith("ok"), verdict


def test_pipeline_stages(spark, docs, texts):
    """Each stage on rows with nulls, repeats and clashing columns: columns stay, decisions take effect."""
    before = docs.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == before.columns and after.count() <= before.count(), name
        assert stage(spark, before.limit(0), SF_DIR).collect() == []
    first = corpus_pipeline.near_duplicate_documents(spark, before, SF_DIR).collect()
    ids = [r["doc_id"] for r in first]
    assert 8 in ids and not {None, 9, 11, 12, 13} & set(ids)
    cut = {r["doc_id"]: r for r in corpus_pipeline.repeated_passages(spark, before, SF_DIR).collect() if r["doc_id"] is not None}
    assert cut[8]["text"] == "" and cut[8]["n_chars"] == 0 and cut[0]["text"] is None
    assert cut[3]["text"] == texts[3]
    packed = corpus_pipeline.packed_sequences(spark, before, SF_DIR)
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024


def test_pipeline_drops_near_duplicates_from_80_percent(spark):
    """90 of 110 shingles are common (0.82); 85 of 115 (0.74) are not enough."""
    words = [f"w{i}" for i in range(104)]
    changed = [" ".join("x" if i in at else w for i, w in enumerate(words)) for at in ((), (30, 60), (20, 45, 70))]
    docs = spark.createDataFrame([(1, changed[0]), (2, changed[1]), (3, changed[2])], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_documents(spark, docs, SF_DIR).collect()) == [1, 3]


def test_pipeline_keeps_one_of_repeated_rows(spark):
    """Rows of one id, and copies without an id, stay once, and so keep their text in the next stage."""
    text = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "abc"}
    rows = [(1, text["a"]), (1, text["a"]), (None, text["b"]), (None, text["b"]), (None, text["a"]), (3, text["c"]), (2, text["c"] + " end"), (2, "other"), (4, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    once = corpus_pipeline.near_duplicate_documents(spark, docs, SF_DIR)
    want = [(1, text["a"]), (2, "other"), (2, text["c"] + " end"), (4, ""), (4, None), (None, text["b"])]
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(want, key=repr)
    cut = corpus_pipeline.repeated_passages(spark, once, SF_DIR)
    assert sorted(map(tuple, cut.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    docs = table(spark, SF_DIR, "documents")
    labels = table(spark, SF_DIR, "labels").select("doc_id", F.col("toxic").alias("label"))
    toxic = toxicity.score(docs, toxicity.learn(docs, labels)).filter("predicted = 1")
    assert 0 < out.select("doc_id").distinct().count() < docs.count()
    assert out.join(toxic, "doc_id").count() == 0
