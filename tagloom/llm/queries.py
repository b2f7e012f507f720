"""The operators bound to the given tables, with their production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import quality, toxicity
from tagloom.llm.decontaminate import contaminated
from tagloom.llm.exact_dedup import exact_groups
from tagloom.llm.fill_middle import fill_in_middle, restored
from tagloom.llm.filter_audit import audit_filters
from tagloom.llm.licenses import scan_licenses
from tagloom.llm.line_dedup import dedup_lines
from tagloom.llm.near_dedup import near_duplicates
from tagloom.llm.pieces import encode_and_check
from tagloom.llm.sharding import shard
from tagloom.llm.shared import table
from tagloom.llm.token_counts import Tokenizer, count_tokens
from tagloom.llm.url_filter import judge_urls

URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    lines = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=4)


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode_and_check(spark, table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), Tokenizer.load()).drop("field")


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(table(spark, folder, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_line_dedup": op2_line_dedup,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_quality": op4_quality,
        "op5_license_scan": op5_license_scan,
        "op6_near_dedup": op6_near_dedup,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_decontamination": op8_decontamination,
        "op9_sharding": op9_sharding,
        "op10_token_counts": op10_token_counts,
        "op11_toxicity": op11_toxicity,
        "op12_filter_audit": op12_filter_audit,
        "op13_fill_in_middle": op13_fill_in_middle,
    }
