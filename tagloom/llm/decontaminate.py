"""Benchmark decontamination by template windows, also for questions with changed parameters.

Numbers, units after numbers and names become typed placeholders; what is left of a word is
compared in lower case without punctuation. Windows of such words are hash-joined with the windows of the
benchmark items. Matches on one diagonal of a document and an item form a passage, and its slots are
checked: the same value in the item must always be the same value in the document, and the other
way round. Exact copies pass this trivially, re-parameterised ones if their slots were filled consistently.

Literal windows, of the words without case and punctuation, are joined beside the template windows. They find copies of which the
templates say too little (mostly numbers) or something else (names in another case). A run of ``MIN_WORDS`` words holds a window
that begins at a multiple of ``MIN_WORDS - WINDOW + 1``, so the documents' literal windows are taken at such places only; how far
a copy goes is then read from the two texts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import NO_ID, stored, text_or_empty
from tagloom.plans.lookups import lookup_join

WINDOW = 8
MIN_WORDS = 13
LEAST_LITERAL = 5
LITERAL = 1
"""Enters the hashes of literal windows."""
UNITS = ("mm cm m km in ft yd mi g kg mg lb oz t l ml s ms min h hours hour minutes minute seconds second days "
         "day weeks week months month years year usd eur dollars dollar cents cent euros euro percent "
         "meters metres kilometers kilometres miles grams kilograms pounds liters litres degrees").split()
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"


def spaced_out(text: Column) -> Column:
    """The text with one space for each run of white space, and none at its ends. Single spaces, the most of all, are passed."""
    return F.btrim(F.regexp_replace(text, r"[\t-\r][ \t-\r]*| [ \t-\r]+", " "), F.lit(" "))


def raw_words(text: Column) -> Column:
    """Words between runs of white space; an empty array for blank text."""
    spaced = spaced_out(text)
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " ", -1))


def template_words(spaced: Column) -> Column:
    """One template word per word of a text from ``spaced_out``: a placeholder, or the word without case and punctuation.

    A name is a capitalised word that follows another word of its sentence.

    Each pattern begins with what few places have, so that most are passed before it looks behind.
    """
    named = F.regexp_replace(spaced, r"(?=\p{Lu})(?<=[\p{L}\p{Nd},;] )\p{Lu}\p{Ll}+(?=[^\p{L}\p{Nd}]|$)", NAME)
    numbered = F.regexp_replace(
        named, r"(?=\p{Nd})(?<![\p{L}\p{Nd}])\p{Nd}+(?:[.,:]\p{Nd}+)*(?![\p{L}\p{Nd}])", NUMBER)
    measured = F.regexp_replace(
        numbered, rf"{NUMBER} (?:{'|'.join(UNITS)})(?![\p{{L}}\p{{Nd}}])", f"{NUMBER} {UNIT}")
    plain = F.lower(F.regexp_replace(measured, r"[^\p{L}\p{Nd}<> ]+", ""))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(plain, " ", -1))


def literal_words(spaced: Column) -> Column:
    """One word per word of a text from ``spaced_out``, without case and punctuation."""
    plain = F.lower(F.regexp_replace(spaced, r"[^\p{L}\p{Nd} ]+", ""))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(plain, " ", -1))


def _windows(words: str, length: int, step: int, *kind: Column) -> Column:
    """Hash of the window at each multiple of ``step``; none if there are fewer words."""
    last = F.size(words) - length
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last, F.lit(step)), lambda i: F.xxhash64(F.slice(words, i + 1, length), *kind))).otherwise(
            F.array().cast("array<bigint>"))


def _fingerprints(words: str | Column, length: int) -> Column:
    """A 64-bit fingerprint of the window at each place; none if there are fewer words.

    Words are hashed once; windows are put together from two of half their length, which takes fewer steps than hashing word by word.
    """
    def joined(parts: Column, step: int) -> Column:
        def with_next(held: Column) -> Column:
            left = F.size(held) - step
            return F.zip_with(F.slice(held, 1, left), F.slice(held, 1 + step, left), lambda a, b: F.xxhash64(a, b))

        # The array of one keeps the parts from being computed for each use.
        return F.get(F.transform(F.array(parts), with_next), F.lit(0))

    words = F.col(words) if isinstance(words, str) else words
    made, width = F.transform(words, lambda word: F.xxhash64(word)), 1
    while width < length:
        step = min(width, length - width)
        made, width = joined(made, step), width + step
    return F.when(F.size(words) >= length, made).otherwise(F.array().cast("array<bigint>"))


def _is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def benchmark_windows(items: DataFrame, window: int) -> DataFrame:
    """Windows of the items: hash, item, at, length, literal. Items shorter than a window are one window.

    Template windows of which more than half is placeholders would match anything and are left out, and so are literal
    windows of fewer than ``LEAST_LITERAL`` words.
    """
    sized = items.withColumn("length", F.least(F.size("words"), F.lit(window)))
    spans = (sized.where("length > 0")
             .select("item", "words", "literals", "length",
                     F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("at"))
             .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("literal")))

    def part(of: str) -> Column:
        return F.slice(of, F.col("at") + 1, F.col("length"))

    slots = F.size(F.filter(part("words"), _is_slot))
    told = F.when(F.col("literal"), F.col("length") >= LEAST_LITERAL).otherwise(slots * 2 <= F.col("length"))
    plain = F.coalesce(*[F.when(F.col("length") == k, F.get(_fingerprints(part("words"), k), F.lit(0))) for k in range(1, window + 1)])
    return spans.where(told).select(
        F.when(F.col("literal"), F.xxhash64(part("literals"), F.lit(LITERAL))).otherwise(plain).alias("hash"),
        "item", "at", "length", "literal")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS,
                 id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
                 item_text_column: str = "text") -> DataFrame:
    """Passages of benchmark items in documents.

    Returns doc_id, item_id, first_word and last_word (in the document, from 0), matched_words, coverage
    (of the item), exact (all slot values equal). A passage counts if its windows cover ``min_words`` words
    on one diagonal, or the whole item, and its slots are consistent. Copies that differ in case and punctuation only are exact.

    * Missing, empty and blank texts match nothing, on either side.
    * Rows repeated in full give each passage once; rows of one id are one document. A missing id
      is reported as NULL. Empty tables give an empty result, and other columns are ignored.
    """
    items = stored(
        benchmark.select(F.col(item_column).alias("item"), text_or_empty(item_text_column).alias("text"))
        .distinct().withColumn("words", template_words(spaced_out(F.col("text"))))
        .withColumn("literals", literal_words(spaced_out(F.col("text"))))
        .withColumn("raw", raw_words(F.col("text"))), "benchmark-items")
    index = stored(benchmark_windows(items, window).distinct(), "benchmark-windows")
    lengths = [row[0] for row in index.select("length").distinct().collect()]  # at most ``window`` of them

    rows = docs.select(F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("doc"),
                       text_or_empty(text_column).alias("text"))
    # Exploding one struct column keeps the windows of a document out of one another's rows. Texts are spaced out
    # before, since a generator would do it for each use.
    words = rows.select("doc", spaced_out(F.col("text")).alias("spaced")).select("doc", F.explode(F.array(F.struct(
        template_words(F.col("spaced")).alias("words"), literal_words(F.col("spaced")).alias("literals")))).alias("of")).select(
            "doc", "of.*")
    shortest = items.where(F.size("words") >= window).agg(F.min(F.size("words"))).first()[0] or window
    matches = None
    for length in sorted(lengths):
        step = max(1, min(min_words, shortest) - window + 1) if length == window else 1
        both = F.concat(_fingerprints("words", length), _windows("literals", length, step, F.lit(LITERAL)))
        windows = words.select("doc", (F.size("words") - length + 1).alias("n"), F.posexplode(both).alias("at_both", "window"))
        own = index.where(F.col("length") == length).select("hash", "item", "at", "literal")
        place = F.when(F.col("literal"), (F.col("at_both") - F.col("n")) * step).otherwise(F.col("at_both"))
        found = lookup_join(windows, own, "window", "hash", "inner").select(
            "doc", "item", "at", "literal", (place - F.col("at")).alias("diagonal"), F.lit(length).alias("length"))
        matches = found if matches is None else matches.unionByName(found)
    schema = "doc_id bigint, item_id bigint, first_word int, last_word int, matched_words int, coverage double, exact boolean"
    if matches is None:
        return docs.sparkSession.createDataFrame([], schema)

    def places(starts: str | Column, length: Column) -> Column:
        span = F.transform(starts, lambda at: F.sequence(at, at + length - 1))
        return F.array_sort(F.array_distinct(F.flatten(span)))

    def enough(column: str) -> Column:
        return F.size(column) >= F.least(F.lit(min_words), F.size("item_words"))

    passages = (matches.groupBy("doc", "item", "diagonal", "length")
                .agg(F.collect_set(F.when(~F.col("literal"), F.col("at"))).alias("starts"),
                     F.max("literal").alias("literal"))
                .withColumn("told", places("starts", F.col("length"))))
    passages = (passages.join(items.select("item", F.col("words").alias("item_words"), F.col("literals").alias("item_literals"),
                                           F.col("raw").alias("item_raw")), "item")
                .where(F.col("literal") | enough("told")))
    passages = stored(passages.drop("starts", "length", "literal"), "passages")

    # Slot values are looked up in the texts of the matched documents only.
    held = rows.join(passages.select("doc").distinct(), "doc", "left_semi").withColumn(
        "doc_raw", raw_words(F.col("text"))).withColumn("doc_literals", literal_words(spaced_out(F.col("text")))).select(
            "doc", "doc_raw", "doc_literals")
    run = F.least(F.lit(min_words), F.size("item_words"))
    alike = F.transform("item_literals", lambda word, at: F.coalesce(
        (at + F.col("diagonal") >= 0) & (word == F.get("doc_literals", at + F.col("diagonal"))), F.lit(False)))
    runs = F.filter(F.sequence(F.lit(0), F.size("alike") - run), lambda at: F.forall(F.slice("alike", at + 1, run), lambda x: x))
    slots = F.filter("covered", lambda at: _is_slot(F.get("item_words", at)))

    def value(words: str, at: Column) -> Column:
        return F.lower(F.regexp_replace(F.get(words, at), r"^[^\p{L}\p{Nd}]+|[^\p{L}\p{Nd}]+$", ""))

    pairs = F.array_distinct(F.transform(slots, lambda at: F.struct(
        value("item_raw", at).alias("item"),
        F.when(F.array_contains("same", at), value("item_raw", at))
        .otherwise(value("doc_raw", at + F.col("diagonal"))).alias("doc"))))
    checked = (passages.join(held, "doc").withColumn("alike", alike).withColumn("same", places(runs, run))
               .withColumn("covered", F.array_sort(F.array_union("told", "same"))).where(enough("covered"))
               .withColumn("matched_words", F.size("covered")).withColumn("pairs", pairs))
    one_to_one = ((F.size(F.array_distinct("pairs.item")) == F.size("pairs"))
                  & (F.size(F.array_distinct("pairs.doc")) == F.size("pairs")))
    return (checked.where(one_to_one).select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), F.col("item").alias("item_id"),
        (F.get("covered", F.lit(0)) + F.col("diagonal")).alias("first_word"),
        (F.element_at("covered", -1) + F.col("diagonal")).alias("last_word"), "matched_words",
        (F.col("matched_words") / F.size("item_words")).alias("coverage"),
        F.forall("pairs", lambda pair: pair["item"] == pair["doc"]).alias("exact")).distinct())


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with all their columns."""
    gone = (contaminated(docs, benchmark, id_column=id_column, **options)
            .select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(gone, docs[id_column].eqNullSafe(gone["__gone"]), "left_anti")
