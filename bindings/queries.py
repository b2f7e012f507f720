"""Every operator bound to the given tables, as (session, folder) -> DataFrame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import tables as t
from tagloom import schemas
from tagloom.functions.dates import parse_partition_day
from tagloom.functions.sentiment import classify, fit_classifier, lexicon_sentiment
from tagloom.functions.tags import tag_label
from tagloom.functions.text import strip_markup, word_count
from tagloom.operators import (
    mining, prepare, profile, questions, report, scorecard, sentiment_weights, tag_usage, trends)
from tagloom.plans.analysis import RESULTS
from tagloom.plans.etl import load_lake, run_etl
from tagloom.sources.csv import read_csv, write_csv
from tagloom.sources.lake import Lake
from tagloom.staging import new_path

MOMENT = "yyyy-MM-dd HH:mm:ss"


def comparable(df: DataFrame) -> DataFrame:
    """Rounded doubles, timestamps as text and lists as joined text."""
    kinds = {"double": lambda c: F.round(c, 6), "timestamp": lambda c: F.date_format(c, MOMENT),
             "array<string>": lambda c: F.concat_ws(",", c)}
    return df.select(*[kinds.get(kind, lambda c: c)(F.col(name)).alias(name)
                       for name, kind in df.dtypes])


# --- raw exports -----------------------------------------------------------------------------

def prepare_posts(spark, folder):
    return comparable(prepare.prepare_posts(t.raw_posts(spark, folder)))


def questions_from_posts(spark, folder):
    posts = prepare.prepare_posts(t.raw_posts(spark, folder))
    return comparable(prepare.questions_from_posts(posts, t.synonyms(spark)))


def answers_from_posts(spark, folder):
    return comparable(prepare.answers_from_posts(prepare.prepare_posts(t.raw_posts(spark, folder))))


def prepare_comments(spark, folder):
    return prepare.prepare_comments(t.raw_comments(spark, folder))


def strip_html(spark, folder):
    html = t.given(spark, folder, "pages")
    return html.select("page_id", strip_markup("html").alias("text"),
                       strip_markup("html", " ").alias("spaced_text"))


def count_words(spark, folder):
    return t.given(spark, folder, "documents").select("doc_id", word_count("text").alias("words"))


def explode_tags(spark, folder):
    asked = t.raw_posts(spark, folder).where(prepare.is_question())
    return comparable(tag_usage.explode_tags(asked))


def tag_synonyms(spark, folder):
    asked = t.raw_posts(spark, folder).where(prepare.is_question())
    return comparable(tag_usage.replace_tag_synonyms(tag_usage.explode_tags(asked), t.synonyms(spark)))


def answers_with_question_tags(spark, folder):
    posts = t.raw_posts(spark, folder)
    return comparable(tag_usage.answers_with_question_tags(
        posts.where(prepare.is_question()), posts.where(prepare.is_answer())))


def comments_with_posts_tags(spark, folder):
    asked = t.raw_posts(spark, folder).where(prepare.is_question())
    return comparable(tag_usage.comments_with_posts_tags(asked, t.raw_comments(spark, folder)))


def day_tag_counts(spark, folder):
    asked = t.raw_posts(spark, folder).where(prepare.is_question())
    return tag_usage.count_tags_per_day(tag_usage.explode_tags(asked), t.tags(spark, folder))


def tag_usage_per_day(spark, folder):
    return tag_usage.tag_usage_per_day(
        t.raw_posts(spark, folder), t.raw_comments(spark, folder), t.synonyms(spark),
        t.tags(spark, folder))


def data_profile(spark, folder):
    return profile.data_profile(t.raw_posts(spark, folder), t.raw_comments(spark, folder),
                                t.synonyms(spark), t.tags(spark, folder))


def describe_posts(spark, folder):
    described = profile.describe(t.lake_answers(spark, folder), "Score", "WordsCount", "PartitionDate")
    return described.select(
        "summary", F.round(F.col("Score").cast("double"), 6).alias("Score"),
        F.round(F.col("WordsCount").cast("double"), 6).alias("WordsCount"),
        F.when(F.col("summary").isin("count", "min", "max"), F.col("PartitionDate")).alias("PartitionDate"))


def summarize_posts(spark, folder):
    names = ("Score", "WordsCount", "OwnerUserId")
    summary = profile.summarize(t.lake_answers(spark, folder).select(*names))
    return summary.select("summary", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in names])


def profile_raw_tables(spark, folder):
    return comparable(profile.profile_tables(
        posts=t.raw_posts(spark, folder), comments=t.raw_comments(spark, folder), synonyms=t.synonyms(spark)))


def table_previews(spark, folder):
    """The first rows of the answers and the comments, by Id, in one shape."""
    answers = t.lake_answers(spark, folder).orderBy("Id").limit(100)
    comments = t.lake_comments(spark, folder).orderBy("Id").limit(100)
    columns = ["Id", F.col("ParentId").alias("OnPost"), "OwnerUserId", "Score", "WordsCount", "CreationDate", "Sentiment", "PartitionDate"]
    no = {"answers": {"Sentiment": F.lit(None).cast("int")},
          "comments": {"ParentId": F.col("PostId"), "OwnerUserId": F.lit(None).cast("bigint"), "CreationDate": F.lit(None).cast("timestamp")}}
    return comparable(answers.withColumns(no["answers"]).select(F.lit("answers").alias("TableName"), *columns).unionByName(
        comments.withColumns(no["comments"]).select(F.lit("comments").alias("TableName"), *columns)))


# --- sentiment -------------------------------------------------------------------------------

def comment_sentiment(spark, folder):
    score = lexicon_sentiment(positive=("the", "of", "and", "best"),
                              negative=("de", "der", "idiot", "stupid", "worthless"))
    return t.given(spark, folder, "documents").select("doc_id", score(F.col("text")).alias("Sentiment"))


def held_out(key):
    """A fixed quarter of the ids, by hash."""
    return F.md5(F.col(key).cast("string")) < "4"


def fitted_weights(spark, folder):
    """Civil documents count as positive; held-out ones are not learnt from."""
    labelled = t.given(spark, folder, "documents").join(
        t.given(spark, folder, "labels").where(~held_out("doc_id")), "doc_id")
    return sentiment_weights.fit_weights(labelled.select("text", (1 - F.col("toxic")).alias("Label")), text="text")


def sentiment_by_weights(spark, folder):
    scored = sentiment_weights.score_by_weights(
        t.given(spark, folder, "documents"), fitted_weights(spark, folder), "doc_id", "text")
    return scored.select("doc_id", held_out("doc_id").alias("HeldOut"), F.round("Score", 4).alias("Score"), "Sentiment")


def sentiment_by_model(spark, folder):
    score = sentiment_weights.shipped_sentiment(sentiment_weights.ship_weights(fitted_weights(spark, folder)))
    return t.given(spark, folder, "documents").select("doc_id", score(F.col("text")).alias("Sentiment"))


def sentiment_by_classifier(spark, folder):
    documents = t.given(spark, folder, "documents").select("doc_id", F.col("text").alias("Text"))
    labelled = documents.join(t.given(spark, folder, "labels"), "doc_id").select(
        "Text", (1 - F.col("toxic")).alias("Label"))
    return classify(documents, fit_classifier(labelled)).select("doc_id", "Sentiment")


# --- lake tables -----------------------------------------------------------------------------

def partition_date_parse(spark, folder):
    dated = t.lake_questions(spark, folder).select("Id", "PartitionDate")
    return comparable(dated.withColumn("Day", parse_partition_day("PartitionDate")))


def table_preview(spark, folder):
    return comparable(t.lake_questions(spark, folder)).orderBy("Id").limit(100)


def general_info(spark, folder):
    return trends.general_info(t.lake_questions(spark, folder), t.lake_answers(spark, folder),
                               t.lake_comments(spark, folder))


def top_tags_per_day(spark, folder):
    return trends.top_tags_per_day(t.lake_questions(spark, folder))


def tag_frequency_series(spark, folder):
    dated = trends.with_partition_timestamp(t.lake_questions(spark, folder))
    return comparable(trends.tag_frequency_series(dated))


def question_answer_info(spark, folder):
    return comparable(answered(spark, folder))


def question_comment_info(spark, folder):
    return comparable(commented(spark, folder))


def answered(spark, folder, tag=t.BRAND_TYPE_TAG):
    return questions.question_answer_info(
        t.lake_questions(spark, folder, tag), t.lake_answers(spark, folder))


def commented(spark, folder):
    return questions.question_comment_info(answered(spark, folder), t.lake_comments(spark, folder))


def card(spark, folder):
    return scorecard.tag_scorecard(commented(spark, folder))


def tag_scorecard(spark, folder):
    return comparable(card(spark, folder))


def tag_averages(spark, folder):
    return comparable(scorecard.tag_averages(answered(spark, folder)))


def answer_count_buckets(spark, folder):
    return questions.answer_count_buckets(t.lake_questions(spark, folder), t.lake_answers(spark, folder))


def leaderboards(spark, folder):
    return comparable(report.leaderboards(card(spark, folder)))


def leaderboard_of(metric):
    return lambda spark, folder: comparable(report.leaderboard(card(spark, folder), metric))


def tag_options(spark, folder):
    return report.tag_options(card(spark, folder))


def tag_overview(spark, folder):
    return report.tag_overview(card(spark, folder))


# --- mining ----------------------------------------------------------------------------------

def mined(spark, folder):
    """The itemsets as a written table, so that no step mines them again."""
    path = new_path(spark, "itemsets")
    mining.frequent_itemsets(t.lake_questions(spark, folder)).write.parquet(path)
    return spark.read.parquet(path)


def freq_itemsets(spark, folder):
    itemsets = mining.frequent_itemsets(t.lake_questions(spark, folder))
    return itemsets.select(tag_label("items").alias("items"), F.size("items").alias("size"), "freq")


def top_itemsets(spark, folder):
    return comparable(mining.top_itemsets(mining.frequent_itemsets(t.lake_questions(spark, folder))))


def rules(spark, folder):
    return mining.association_rules(mined(spark, folder), mining.count_baskets(t.lake_questions(spark, folder)))


def association_rules(spark, folder):
    return comparable(rules(spark, folder).drop("antecedent_list", "consequent_list"))


def rule_graph_edges(spark, folder):
    return comparable(mining.rule_graph_edges(rules(spark, folder)))


def rule_graph_nodes(spark, folder):
    return mining.rule_graph_nodes(rules(spark, folder))


# --- sources, sinks and jobs -----------------------------------------------------------------

def csv_roundtrip(spark, folder):
    path = new_path(spark, "csv")
    write_csv(t.raw_posts(spark, folder), path)
    return comparable(read_csv(spark, [path], schemas.POSTS))


def result_roundtrip(spark, folder):
    path = new_path(spark, "result")
    write_csv(card(spark, folder), path)
    return comparable(read_csv(spark, path, RESULTS["final_df"], multi_line=False))


def partitioned_write(spark, folder):
    lake = Lake(spark, new_path(spark, "lake"))
    lake.overwrite(t.lake_comments(spark, folder), schemas.COMMENTS_TABLE)
    return lake.read(schemas.COMMENTS_TABLE)


def upsert_by_id(spark, folder):
    """Purchases come again with other values, and every signup comes again as a new row."""
    stored = t.lake_comments(spark, folder)
    events = stored.join(t.given(spark, folder, "events").select(F.col("event_id").alias("Id"), "event_type"), "Id")
    changed = events.where("event_type = 'purchase'").withColumns(
        {"Sentiment": F.lit(0), "WordsCount": F.col("WordsCount") + 1, "PartitionDate": F.lit("31_01_2024")})
    added = events.where("event_type = 'signup'").withColumn("Id", F.col("Id") + 1000000000)
    lake = Lake(spark, new_path(spark, "lake"))
    lake.overwrite(stored, schemas.COMMENTS_TABLE)
    lake.upsert(changed.unionByName(added).drop("event_type"), schemas.COMMENTS_TABLE)
    return lake.read(schemas.COMMENTS_TABLE)


def lake_rows(lake: Lake) -> DataFrame:
    """The three tables in one shape."""
    def rows(name, detail):
        return lake.read(name).select(
            F.lit(name).alias("TableName"), "Id", "PartitionDate", "WordsCount", "Score",
            detail.cast("string").alias("Detail"))

    return (rows(schemas.QUESTIONS_TABLE, F.concat_ws(",", "Tags"))
            .unionByName(rows(schemas.ANSWERS_TABLE, F.col("ParentId")))
            .unionByName(rows(schemas.COMMENTS_TABLE, F.col("Sentiment"))))


def etl_from_csv(spark, folder) -> Lake:
    exports = new_path(spark, "exports")
    write_csv(t.raw_posts(spark, folder), f"{exports}/posts")
    write_csv(t.raw_comments(spark, folder), f"{exports}/comments")
    write_csv(t.synonyms(spark), f"{exports}/synonyms")
    lake = Lake(spark, new_path(spark, "lake"))
    run_etl(spark, lake, [f"{exports}/posts"], [f"{exports}/comments"], [f"{exports}/synonyms"],
            incremental=False)
    return lake


def etl_initial(spark, folder):
    return lake_rows(etl_from_csv(spark, folder))


def planted_comments(spark, folder, exports):
    """Comment exports in which every 13th Id, day and quoting is wrong; the odd quotes are in files of their own."""
    comments = t.raw_comments(spark, folder)
    texts = comments.select(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if kind == "timestamp"
                              else F.col(c).cast("string").alias(c) for c, kind in comments.dtypes],
                            F.pmod("Id", F.lit(13)).alias("kind"))
    wrong = texts.withColumns({
        "Id": F.when(F.col("kind") == 0, F.concat(F.lit("x"), "Id")).otherwise(F.col("Id")),
        "CreationDate": F.when(F.col("kind") == 1, "yesterday").otherwise(F.col("CreationDate"))})
    write_csv(wrong.where("kind <> 2").drop("kind"), f"{exports}/comments")
    odd = texts.where("kind = 2").withColumns({"Text": F.lit("plain text"), "Score": F.concat(F.lit('"4"'), "Score", F.lit('"'))})
    odd.drop("kind").write.options(header=True, quote="\u0000", escape="\u0000").csv(f"{exports}/odd")
    return [f"{exports}/comments", f"{exports}/odd"]


def etl_rejects(spark, folder):
    """What becomes of exports with records that do not fit: counts per export, each reject's Id, and the stored comments."""
    exports = new_path(spark, "exports")
    write_csv(t.raw_posts(spark, folder), f"{exports}/posts")
    write_csv(t.synonyms(spark), f"{exports}/synonyms")
    lake = Lake(spark, new_path(spark, "lake"))
    counts = run_etl(spark, lake, [f"{exports}/posts"], planted_comments(spark, folder, exports),
                     [f"{exports}/synonyms"], incremental=False, rejects=f"{exports}/rejects", split_from=1 << 16)
    outcomes = counts.unpivot("Export", ["Read", "Loaded", "Rejected"], "Outcome", "Records").select(
        "Export", "Outcome", F.lit(None).cast("string").alias("Id"), "Records")

    def each(rows, outcome, id_text):
        return rows.groupBy(id_text.alias("Id")).agg(F.count("*").alias("Records")).select(
            F.lit("comments").alias("Export"), F.lit(outcome).alias("Outcome"), "Id", "Records")

    rejected = spark.read.parquet(f"{exports}/rejects/comments")
    return (outcomes.unionByName(each(rejected, "record", F.substring_index("_corrupt_record", ",", 1)))
            .unionByName(each(lake.read(schemas.COMMENTS_TABLE), "stored", F.col("Id").cast("string"))))


def etl_incremental(spark, folder):
    """A second export changes some posts, moves them to another day and brings new ones."""
    lake = etl_from_csv(spark, folder)
    rows, changed = t.page_questions(
        spark, folder, Score="p_size + 100",
        CreationDate=f"{t.FIRST_DAY} + make_dt_interval(p_size + 1)")
    _, new = t.page_questions(spark, folder, Id="3000000000 + 3 * page_id")
    posts = (t.shaped(rows.where("p_type = 'LARGE'"), schemas.POSTS, **changed)
             .unionByName(t.shaped(rows.where("p_type = 'PROMO'"), schemas.POSTS, **new)))
    labelled = t.given(spark, folder, "labels").select(F.col("doc_id").alias("Id"))
    comments = t.raw_comments(spark, folder).join(labelled, "Id", "left_semi").withColumn(
        "Score", F.lit(7))
    load_lake(lake, posts, comments, t.synonyms(spark), incremental=True)
    return lake_rows(lake)


def all_queries():
    named = [
        prepare_posts, questions_from_posts, answers_from_posts, prepare_comments, strip_html,
        explode_tags, tag_synonyms, answers_with_question_tags, comments_with_posts_tags,
        day_tag_counts, tag_usage_per_day, data_profile, describe_posts, summarize_posts, profile_raw_tables,
        comment_sentiment, sentiment_by_model, sentiment_by_weights, sentiment_by_classifier, partition_date_parse,
        table_preview, table_previews, general_info, top_tags_per_day, tag_frequency_series,
        question_answer_info, question_comment_info, tag_scorecard, tag_averages,
        answer_count_buckets, leaderboards, tag_options, tag_overview, freq_itemsets,
        top_itemsets, association_rules, rule_graph_edges, rule_graph_nodes, csv_roundtrip,
        result_roundtrip, partitioned_write, upsert_by_id, etl_initial, etl_incremental, etl_rejects,
    ]
    return {
        **{query.__name__: query for query in named},
        "word_count": count_words,
        **{f"leaderboard_{m}": leaderboard_of(m) for m in report.LEADERBOARD_METRICS},
    }
