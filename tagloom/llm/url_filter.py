"""URL filter: host and path rules, and boosted trees on lexical features for the rest.

All of it is DataFrame work: parsing, rules, features, the statistics of host suffixes over all labelled
URLs, and gradient-boosted trees of Spark ML, which are fitted on a bounded sample of those URLs.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import lower_ascii, stored
from tagloom.plans.lookups import lookup_join

BLOCK, ALLOW = "block", "allow"
MAX_TRAINING_ROWS = 20_000
"""Bound of the labelled sample that the trees are fitted on, taken in the order of a hash of the URL."""
TREES, DEPTH, SEED = 20, 4, 7
PRIOR_WEIGHT = 10.0
LEXICAL = ("url_length", "host_length", "path_length", "depth", "digits", "entropy", "params", "labels", "hyphens")
STATISTICS = ("suffix_rate", "suffix_seen", "domain_rate", "domain_seen")


def host_of(url: str | Column = "url") -> Column:
    return lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: str | Column = "url") -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    return (((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host)))
            & F.startswith(F.col("path"), F.lit(slash + path)))


def ruled(urls: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Adds host, path, and the longest rule that fits with its action; NULLs if none fits.

    A rule is a host and the beginning of a path, and holds for subdomains too. A NULL URL, or one
    without ``://``, has an empty host and path.
    """
    rows = (urls.withColumn("host", F.coalesce(host_of(), F.lit("")))
            .withColumn("path", F.coalesce(path_of(), F.lit(""))))
    rule = F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (len(r), r)):
        rule = F.when(_fits(name), name).otherwise(rule)
    action = F.lit(None).cast("string")
    for name, verdict in rules.items():
        action = F.when(F.col("rule") == name, verdict).otherwise(action)
    return rows.withColumn("rule", rule).withColumn("action", action)


def _suffix(labels: int) -> Column:
    """The last ``labels`` parts of the host name."""
    return F.substring_index("host", ".", -labels)


def with_lexical(rows: DataFrame) -> DataFrame:
    """Lexical features of ``url`` with its ``host`` and ``path``; a NULL URL is judged as an empty one."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.char_length(url), F.lit(1))
    letters = F.filter(F.array_distinct(F.split(url, "")), lambda c: c != "")

    def information(total: Column, letter: Column) -> Column:
        share = (F.char_length(url) - F.char_length(F.replace(url, letter, F.lit("")))) / n
        return total - share * F.log2(share)

    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return (rows.withColumn("url_length", F.char_length(url).cast("double"))
            .withColumn("host_length", F.char_length("host").cast("double"))
            .withColumn("path_length", F.char_length("path").cast("double"))
            .withColumn("depth", F.regexp_count("path", F.lit("/[^/]")).cast("double"))
            .withColumn("digits", F.regexp_count(url, F.lit("[0-9]")) / n)
            .withColumn("entropy", F.aggregate(letters, F.lit(0.0), information))
            .withColumn("params", F.when(query == "", 0.0).otherwise(
                F.size(F.split(query, "&", -1)).cast("double")))
            .withColumn("labels", F.size(F.split("host", r"\.", -1)).cast("double"))
            .withColumn("hyphens", F.regexp_count("host", F.lit("-")).cast("double"))
            .withColumn("suffix", _suffix(1)).withColumn("domain", _suffix(2)))


def suffix_statistics(labelled: DataFrame, name: str) -> tuple[DataFrame, float]:
    """Smoothed share of blocked URLs and log count of each suffix, over all labelled URLs; and the mean."""
    total = labelled.agg(F.avg("label")).first()[0]
    prior = 0.5 if total is None else float(total)
    seen = F.count("*")
    return (labelled.groupBy(F.col(name).alias(f"{name}_key"))
            .agg(((F.sum("label") + PRIOR_WEIGHT * prior) / (seen + PRIOR_WEIGHT)).alias(f"{name}_rate"),
                 F.log1p(seen).alias(f"{name}_seen"))), prior


class UrlModel:
    """Trees and suffix statistics learnt from labelled URLs."""

    def __init__(self, labelled: DataFrame, max_rows: int = MAX_TRAINING_ROWS):
        """``labelled`` has url, host, path and label (1: block). Rows without a label are left out.

        If all labels agree, or there are none, the model answers with that label, or allows.
        """
        rows = with_lexical(labelled.where("label IS NOT NULL").withColumn("label", F.col("label").cast("double")))
        self.suffixes, self.prior = suffix_statistics(rows, "suffix")
        self.domains, _ = suffix_statistics(rows, "domain")
        self.suffixes = stored(self.suffixes, "url-suffixes")
        self.domains = stored(self.domains, "url-domains")
        least, most = rows.agg(F.min("label"), F.max("label")).first()
        self.constant, self.trees = (least or 0.0) if least == most else None, None
        if self.constant is None:
            sample = stored(rows.orderBy(F.xxhash64("url"), "url").limit(max_rows), "url-sample")
            self.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label",
                                       featuresCol="features").fit(self._vectors(sample).select("features", "label"))

    def _vectors(self, rows: DataFrame) -> DataFrame:
        for name, known in (("suffix", self.suffixes), ("domain", self.domains)):
            rows = (lookup_join(rows, known, name, f"{name}_key", "left")
                    .withColumn(f"{name}_rate", F.coalesce(f"{name}_rate", F.lit(self.prior)))
                    .withColumn(f"{name}_seen", F.coalesce(f"{name}_seen", F.lit(0.0))).drop(f"{name}_key"))
        return VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(rows)

    def judge(self, rows: DataFrame) -> DataFrame:
        """Adds ``prediction`` (1.0: block) to rows with url, host and path."""
        if self.trees is None:
            return rows.withColumn("prediction", F.lit(self.constant))
        return self.trees.transform(self._vectors(with_lexical(rows)))


def judge_urls(pages: DataFrame, rules: dict[str, str], labelled: DataFrame | None = None,
               id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Verdict for each URL: page_id, host, path, rule, verdict.

    The longest fitting rule decides; the other URLs are judged by trees trained on ``labelled`` (url,
    label), by default the URLs of ``pages`` that a rule decides.

    * A NULL URL or one without ``://`` has an empty host and path and is judged as it stands.
    * Rows repeated in full get the same verdict each; a missing id stays NULL; other columns are ignored.
    * An empty table gives an empty result.
    """
    rows = ruled(pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url")), rules)
    if labelled is None:
        examples = rows.where("action IS NOT NULL").withColumn("label", F.col("action") == BLOCK)
    else:
        examples = ruled(labelled.select("url", "label"), {})
    judged = UrlModel(examples.select("url", "host", "path", "label")).judge(rows)
    learnt = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", learnt).alias("verdict"))
