"""What the mix stage decides is what the encode stage goes by."""

import pytest
from conftest import DATA

N = 700


@pytest.fixture
def left(spark):
    """Documents in an order that is neither that of their keys nor that of the mix."""
    keys = sorted(range(N), key=lambda i: i * 37 % N)
    rows = [(k, "word " * (n % 90 + 1), "en", f"src{k % 3}", 5, n) for n, k in enumerate(keys)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long").coalesce(1)


def places(frame):
    return {r.doc_id: (r.place, r.position, r.slot, r.in_mix) for r in frame.collect()}


def test_places_are_those_of_the_rows_as_written(spark, left, tmp_path):
    """Files of unequal length, longest last, and cut by the scan."""
    import corpus_pipeline

    files = left.withColumn("file", left.n * left.n / 100000).repartitionByRange(6, "file").sortWithinPartitions("n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        files.drop("n", "file").write.option("parquet.block.size", 800).parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
        assert docs.rdd.getNumPartitions() > 6 and [r.doc_id for r in docs.collect()] != [r.doc_id for r in left.sort("n").collect()]
        found = places(corpus_pipeline.encode(spark, docs, DATA))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {k: p[0] for k, p in found.items()} == {r.doc_id: r.n for r in left.collect()}
    for source in range(3):
        own = sorted(found[k] for k in found if k % 3 == source)
        assert [p[1] for p in own] == sorted(p[1] for p in own)


def test_without_the_mix_the_rows_of_the_pipeline_differ(spark, left, tmp_path):
    import corpus_pipeline
    from eodledger.llm import mixing, queries

    left.drop("n").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    mixed = corpus_pipeline.mix(spark, docs, DATA)
    mixed.write.parquet(f"{tmp_path}/mixed")
    with_mix = places(corpus_pipeline.encode(spark, spark.read.parquet(f"{tmp_path}/mixed"), DATA))
    without = places(corpus_pipeline.encode(spark, docs, DATA))
    assert with_mix.keys() == without.keys() and with_mix != without
    placed = mixing.positions(docs.select("doc_id", "source"), queries.WEIGHTS)
    want = {r.doc_id: tuple(r[placed.columns[-1]]) for r in placed.collect()}
    assert {k: (p[2], p[1], p[3]) for k, p in with_mix.items()} == want
    by_position = sorted(with_mix, key=lambda k: with_mix[k][1])
    assert [with_mix[k][0] for k in by_position] == list(range(N))
    assert places(corpus_pipeline.encode(spark, mixed, DATA)) == with_mix  # rows that no file holds yet
