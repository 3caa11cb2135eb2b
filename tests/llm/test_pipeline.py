import corpus_pipeline


def test_stages_and_columns(spark, small_dir):
    """What each stage returns; tests/llm/test_brute_force.py checks the rows."""
    source = spark.read.parquet(f"{small_dir}/documents.parquet")
    docs, sizes = source, [source.count()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small_dir)
        docs = docs.sparkSession.createDataFrame(docs.toPandas(), docs.schema)
        sizes.append(docs.count())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == source.columns
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] >= sizes[4] > 0.4 * sizes[0]
    assert docs.filter("piece = 0").count() == sizes[4]
