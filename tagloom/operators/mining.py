"""Frequent tag sets, mined with Spark ML's FP-growth, and the rules that follow from them.

A fitted model mines its sets anew for every action. Write the itemsets to a table where
several results are made of them, as the report job does.
"""

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.tags import tag_label

# Thresholds and length of the published report.
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.1
TOP_ITEMSETS = 16
PREFIX_ITEMS_PER_GROUP = 2_000_000
"""Tags that a group of items receives in the prefixes of baskets; decides the number of groups."""


def item_groups(questions: DataFrame, per_group: int = PREFIX_ITEMS_PER_GROUP) -> int:
    """Groups of items to mine in, from the data: mining sends each group the prefixes of the baskets with its items.

    A basket of w tags sends prefixes of at most w (w + 1) / 2 tags; no basket is sent to more groups than it has
    tags, and there are never more groups than distinct tags. Small tables still get a group per task of the session.
    """
    width = F.size("Tags").cast("bigint")
    seen = questions.where(F.col("Tags").isNotNull()).agg(
        F.coalesce(F.sum(width * (width + 1) / 2), F.lit(0)).alias("prefixes"), F.coalesce(F.sum(width), F.lit(0)).alias("tags")).first()
    parallel = questions.sparkSession.sparkContext.defaultParallelism
    return int(max(1, min(seen["tags"], max(parallel, -(-int(seen["prefixes"]) // per_group)))))


def frequent_itemsets(questions: DataFrame, min_support: float = MIN_SUPPORT,
                      max_items: int | None = None, partitions: int | None = None) -> DataFrame:
    """(items, freq): sorted tag sets and the number of questions that have all of them.

    ``partitions`` spreads the mining over that many tasks, by default as many as ``item_groups``
    finds the data to need, however few files they come in; ``max_items`` leaves out larger sets.
    """
    miner = FPGrowth(itemsCol="Tags", minSupport=min_support).setNumPartitions(partitions or item_groups(questions))
    mined = miner.fit(questions.select("Tags")).freqItemsets
    itemsets = mined.select(F.sort_array("items").alias("items"), "freq")
    return itemsets if max_items is None else itemsets.where(F.size("items") <= max_items)


def top_itemsets(itemsets: DataFrame, top: int = TOP_ITEMSETS) -> DataFrame:
    """(items, item_list, freq) of the most frequent sets, ``items`` being their label."""
    labelled = itemsets.select(
        tag_label("items").alias("items"), F.col("items").alias("item_list"), "freq")
    return labelled.orderBy(F.desc("freq"), "items", "item_list").limit(top)


def count_baskets(questions: DataFrame) -> int:
    """Questions that FP-growth counts: those whose ``Tags`` are not NULL."""
    return questions.where(F.col("Tags").isNotNull()).count()


def association_rules(itemsets: DataFrame, questions: int,
                      min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules with a single consequent, from all frequent sets of so many questions.

    ``questions`` is the ``count_baskets`` of the questions that the sets were mined from.
    Both sides come as label and as list. Every part of a frequent set is frequent itself,
    so the joins find the counts of both sides.
    """
    split = itemsets.where(F.size("items") > 1).select(
        "items", "freq", F.explode("items").alias("consequent_item"))
    rules = split.select(
        F.array_remove("items", F.col("consequent_item")).alias("antecedent_list"),
        F.array("consequent_item").alias("consequent_list"), "freq")
    antecedents = itemsets.select(F.col("items").alias("antecedent_list"),
                                  F.col("freq").alias("antecedent_freq"))
    consequents = itemsets.select(F.col("items").alias("consequent_list"),
                                  F.col("freq").alias("consequent_freq"))
    confidence = F.col("freq") / F.col("antecedent_freq")
    return (
        rules.join(antecedents, "antecedent_list").where(confidence >= min_confidence)
        .join(consequents, "consequent_list")
        .select(tag_label("antecedent_list").alias("antecedent"),
                tag_label("consequent_list").alias("consequent"),
                confidence.alias("confidence"),
                (confidence / (F.col("consequent_freq") / questions)).alias("lift"),
                (F.col("freq") / questions).alias("support"),
                "antecedent_list", "consequent_list")
    )


def rule_graph_edges(rules: DataFrame) -> DataFrame:
    """(source, target, weight, label): one edge per pair of labels, weighted by support."""
    return (rules.groupBy(F.col("antecedent").alias("source"), F.col("consequent").alias("target"))
            .agg(F.max("support").alias("weight"))
            .withColumn("label", F.format_string("%.4f", "weight")))


def rule_graph_nodes(rules: DataFrame) -> DataFrame:
    """(node): every label at either end of a rule."""
    ends = F.explode(F.array("antecedent", "consequent"))
    return rules.select(ends.alias("node")).distinct()
