"""The decision of the mix stage in the rows of the pipeline."""

from conftest import DATA


def test_rows_keep_the_order_of_the_mix(spark):
    import corpus_pipeline
    from eodledger.llm import mixing, queries

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, DATA)
    placed = mixing.positions(docs.select("doc_id", "source"), queries.WEIGHTS)
    want = sorted((r.position, r.slot, r.in_mix, r.doc_id) for r in placed.select("doc_id", f"{placed.columns[-1]}.*").collect())
    found = [(r.position, r.slot, r.in_mix, r.doc_id) for r in corpus_pipeline.run(spark, DATA).collect()]
    assert found == want and len({r[0] for r in found}) == len(found)
