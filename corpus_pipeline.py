"""Corpus preparation in stages, each of which works on all that the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import quality
from tagloom.llm.decontaminate import drop_contaminated
from tagloom.llm.line_dedup import dedup_lines
from tagloom.llm.near_dedup import drop_near_duplicates
from tagloom.llm.pieces import PieceModel, default_model_path, encode
from tagloom.llm.shared import stored, table

ORACLE_SQL = None  # the first stage is a trained model, which SQL cannot state


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on this corpus' labels, does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that they share with others; ``n_chars`` follows the text."""
    kept = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    return (kept.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
            .withColumn("n_chars", F.when(changed, F.char_length("text").cast("bigint"))
                        .otherwise(F.col("n_chars")))
            .select(*docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document."""
    rows = encode(docs, PieceModel.load(default_model_path()))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", unrepeated_lines),
    ("minhash near-dedup", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
