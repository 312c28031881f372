import corpus_pipeline
from holdfast.llm.common import staged

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, [{r["doc_id"] for r in docs.select("doc_id").collect()}]
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        rows = [r["doc_id"] for r in docs.select("doc_id").collect()]
        ids.append(set(rows))
        assert ids[-1] <= ids[-2]
        if name in ("exact_dedup", "simhash_dedup"):
            assert len(rows) == len(ids[-1])
    dropped_good = [i for i in ids[1] - ids[2] if i in labels and labels[i]["quality"] == 1]
    dropped_clean = [i for i in ids[0] - ids[1] if i in labels and labels[i]["toxic"] == 0]
    kept_poor = [i for i in ids[2] if i in labels and labels[i]["quality"] == 0]
    assert len(dropped_good) <= 2 and len(dropped_clean) <= 6 and len(kept_poor) <= 2
    assert ids[-1] == ids[-2]  # packing keeps every document


def test_edge_documents(spark, tmp_path):
    rows = [(1, None, None, None, 0), (1, None, None, None, 0), (None, "", "en", "s", 0), (3, "a b c", "en", "s", 5),
            (4, "a  b c", "en", "s", 6)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in found) == [1, 3]
    documents.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_as_query(spark):
    import __spark_entry__

    assert corpus_pipeline.run is __spark_entry__.queries()["pipeline"]
