import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        assert out.count() <= docs.count()
        docs = out
    empty = docs.limit(0)
    assert cp.pack(spark, empty, SF).count() == 0
    assert cp.run(spark, SF).select("sequence_id").distinct().count() > 10
