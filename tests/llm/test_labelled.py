"""The labelled sample is bounded in rows, whatever repeats."""

from eodledger.llm.labelled import sample


def test_a_repeated_key_is_one_row(spark):
    docs = spark.createDataFrame([(7, f"text {i:03}") for i in range(300)] + [(i, "other") for i in range(10, 20)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (7, 1)] + [(i, 0) for i in range(10, 20)], "doc_id long, toxic int")
    got = sample(docs, labels, "toxic", (1, 1), 50).collect()
    assert sorted((r.key, r.text, r.y) for r in got) == [(7, "text 000", 1.0)] + [(i, "other", 0.0) for i in range(10, 20)]
    assert sample(docs, labels, "toxic", (1, 1), 5).count() == 5
