"""Words of benchmark items and documents, from texts that are spaced out once."""

from pyspark.sql import functions as F

from tagloom.llm.decontaminate import literal_words, raw_words, spaced_out, template_words


def test_white_space_and_placeholders_of_benchmark_words(spark):
    texts = ["", " ", "\t\n", " a  b\t\tc \n d\r", "one\n\ntwo", "He met Anna, 12 km off 5 hours 5 hoursx x1 1x 12.34a 7 8 t"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", raw_words(F.col("text")).alias("raw"), template_words(spaced_out(F.col("text"))).alias("template"),
        literal_words(spaced_out(F.col("text"))).alias("literal")).collect()
    assert [r.raw for r in rows] == [t.split() for t in texts]
    assert [len(r.template) for r in rows] == [len(r.literal) for r in rows] == [len(t.split()) for t in texts]
    assert rows[-1].template == ("he met <name> <num> <unit> off <num> <unit> <num> hoursx x1 1x <num>34a <num> <num> <unit>").split()
