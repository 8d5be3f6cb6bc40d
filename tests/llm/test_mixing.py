from pyspark.sql import functions as F

from dewpoint.llm.mixing import apply_mix, mix_sources


def test_empty_documents_are_taken_no_more_than_others(spark):
    """A source at its limit of two copies: all its documents come twice, empty ones too."""
    rows = [(i, "" if i % 3 else None, "small") for i in range(300)]
    rows += [(300, "a few words", "small")]
    rows += [(i, "some words that are many " * 40, "large") for i in range(301, 340)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = apply_mix(docs).groupBy("source", "doc_id").count().collect()
    assert {r["count"] for r in mixed if r.source == "small"} == {2}
    assert sum(r.source == "small" for r in mixed) == 301
    taken = mix_sources(docs).groupBy("source").agg(F.max("copies").alias("most")).collect()
    assert all(r.most <= 2 for r in taken)
