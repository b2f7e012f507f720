"""The registered queries in SQL, over the same given tables."""

from tagloom import schemas
from tagloom.functions.sentiment import NEGATIVE_WORDS, POSITIVE_WORDS
from tagloom.operators.report import LEADERBOARD_METRICS

DAY = "'%d_%m_%Y'"
MOMENT = "'%Y-%m-%d %H:%M:%S'"


def stripped(column, separator=""):
    return (f"regexp_replace(regexp_replace({column}, '<.*?>|\\n', '{separator}', 'g'), "
            "'\\s\\s+', ' ', 'g')")


def words(column):
    return f"CAST(len(string_split({column}, ' ')) AS INTEGER)"


def sentiment(column, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS):
    def listed(values):
        return ", ".join(f"'{v}'" for v in values)

    return (f"CAST(list_sum(list_transform(regexp_split_to_array(lower({column}), '[^a-z]+'), "
            f"lambda w: CASE WHEN w IN ({listed(positive)}) THEN 1 "
            f"WHEN w IN ({listed(negative)}) THEN -1 ELSE 0 END)) > 0 AS INTEGER)")


# --- raw exports -----------------------------------------------------------------------------

PAGE_QUESTION = """
    SELECT {id} AS Id, 1 AS PostTypeId, 3 * (8 * page_id + 1) + 1 AS AcceptedAnswerId,
           CAST(NULL AS BIGINT) AS ParentId,
           TIMESTAMP '2024-01-01' + to_days(p_size{day}) AS CreationDate, p_size{score} AS Score,
           CAST(trunc(p_retailprice) AS INTEGER) AS ViewCount, html AS Body,
           CASE WHEN p_size <= 45 THEN page_id END AS OwnerUserId, url AS Title,
           CASE WHEN p_type <> 'SMALL' THEN '<' || replace(p_name, ' ', '><') || '>' END AS Tags
    FROM pages LEFT JOIN part ON page_id = p_partkey
"""
PAGES = PAGE_QUESTION.format(id="3 * page_id", day="", score="")

RAW = f"""
page_rows AS ({PAGES}),
raw_posts AS (
    SELECT * FROM page_rows
    UNION ALL
    {PAGES} WHERE p_type = 'LARGE'
    UNION ALL
    SELECT 3 * (8 * conv_id + turn) + 1, CASE role WHEN 'assistant' THEN 2 ELSE 4 END, NULL,
           3 * conv_id, TIMESTAMP '2024-01-01' + to_days(CAST(turn AS INTEGER)),
           CAST(turn AS INTEGER), NULL, text, conv_id + turn - 1, NULL, NULL
    FROM conversations WHERE role <> 'user'
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM region
),
raw_comments AS (
    SELECT doc_id AS Id, 3 * CAST(substr(source, 4) AS BIGINT) AS PostId,
           CAST(length(lang) AS INTEGER) AS Score, text AS Text,
           CASE WHEN lang <> 'es' THEN TIMESTAMP '2024-01-01'
                + to_days(CAST(n_chars // 1000 AS INTEGER)) + to_hours(CAST(n_chars % 24 AS INTEGER)) END AS CreationDate
    FROM documents
    UNION ALL
    SELECT 1000000000 + 8 * conv_id + turn, 3 * (8 * conv_id + turn + 1) + 1,
           CAST(turn AS INTEGER), text, TIMESTAMP '2024-01-01' + to_days(CAST(turn AS INTEGER))
    FROM conversations WHERE role = 'user'
),
synonyms AS (
    SELECT * FROM (VALUES ('bolt', 'gear'), ('gear', 'ring'), ('old', 'cold')) v(SourceTagName, TargetTagName)
),
tags AS (
    SELECT min(p_partkey) AS Id, word AS TagName, count(*) AS Count
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
    WHERE word <> 'widget' GROUP BY word
),
posts AS (
    SELECT Id, PostTypeId, ParentId, AcceptedAnswerId, OwnerUserId, Score, ViewCount, Title,
           {stripped('Body')} AS Body, Tags, CreationDate, CAST(NULL AS VARCHAR) AS ClosedDate,
           {words(stripped('Body'))} AS WordsCount
    FROM (SELECT DISTINCT * FROM raw_posts) WHERE OwnerUserId IS NOT NULL
),
raw_questions AS (SELECT * FROM raw_posts WHERE PostTypeId = 1 AND Tags IS NOT NULL),
raw_answers AS (SELECT * FROM raw_posts WHERE PostTypeId = 2 AND Tags IS NULL),
question_tags AS (
    SELECT DISTINCT Id, coalesce(TargetTagName, tag) AS Tag
    FROM (SELECT Id, unnest(string_split(replace(Tags, '<', ''), '>')) AS tag
          FROM posts WHERE PostTypeId = 1 AND Tags IS NOT NULL)
    LEFT JOIN synonyms ON tag = SourceTagName WHERE tag <> ''
),
questions AS (
    SELECT p.Id, AcceptedAnswerId, OwnerUserId, Score, ViewCount, WordsCount,
           strftime(CreationDate, {MOMENT}) AS CreationDate, ClosedDate,
           strftime(CreationDate, {DAY}) AS PartitionDate, t.Tags
    FROM posts p JOIN (SELECT Id, string_agg(Tag, ',' ORDER BY Tag) AS Tags
                       FROM question_tags GROUP BY Id) t ON p.Id = t.Id
    WHERE p.PostTypeId = 1
),
answers AS (
    SELECT Id, ParentId, OwnerUserId, Score, WordsCount, strftime(CreationDate, {MOMENT}) AS CreationDate,
           strftime(CreationDate, {DAY}) AS PartitionDate
    FROM posts WHERE PostTypeId = 2 AND Tags IS NULL
),
comments AS (
    SELECT Id, PostId, Score, {words(stripped('Text'))} AS WordsCount,
           {sentiment(stripped('Text'))} AS Sentiment, strftime(CreationDate, {DAY}) AS PartitionDate
    FROM raw_comments WHERE CreationDate IS NOT NULL
),
single_tags AS (
    SELECT * FROM (
        SELECT CreationDate, unnest(string_split(replace(Tags, '<', ''), '>')) AS Tag FROM raw_questions)
    WHERE Tag <> ''
),
answer_tags AS (
    SELECT a.Id, a.CreationDate, q.Tags FROM raw_questions q JOIN raw_answers a ON q.Id = a.ParentId
),
tagged_posts AS (
    SELECT DISTINCT * FROM (
        SELECT Id, CreationDate, Tags FROM raw_questions
        UNION ALL
        SELECT a.Id, a.CreationDate, q.Tags
        FROM (SELECT DISTINCT * FROM raw_questions) q
        JOIN (SELECT DISTINCT * FROM raw_answers) a ON q.Id = a.ParentId)
),
moments AS (
    SELECT DISTINCT * FROM (
        SELECT CreationDate, Tags FROM tagged_posts
        UNION ALL
        SELECT c.CreationDate, p.Tags FROM tagged_posts p JOIN raw_comments c ON p.Id = c.PostId)
),
moment_tags AS (
    SELECT CreationDate, coalesce(TargetTagName, tag) AS Tag
    FROM (SELECT CreationDate, unnest(string_split(replace(Tags, '<', ''), '>')) AS tag FROM moments)
    LEFT JOIN synonyms ON tag = SourceTagName WHERE tag <> ''
),
first_load AS (
    SELECT 'questions' AS TableName, Id, PartitionDate, WordsCount, Score, Tags AS Detail FROM questions
    UNION ALL
    SELECT 'answers', Id, PartitionDate, WordsCount, Score, CAST(ParentId AS VARCHAR) FROM answers
    UNION ALL
    SELECT 'comments', Id, PartitionDate, WordsCount, Score, CAST(Sentiment AS VARCHAR) FROM comments
)
"""


def raw(select):
    return f"WITH {RAW} {select}"


def raw_counts():
    """Counts of the profile, one row each."""
    distinct_posts = "(SELECT DISTINCT * FROM raw_posts)"
    measures = {
        "posts": "raw_posts",
        "untagged_questions": "raw_posts WHERE PostTypeId = 1 AND Tags IS NULL",
        "distinct_posts": distinct_posts,
        # Of the columns only the empty rows lack an Id.
        "non_empty_posts": f"{distinct_posts} WHERE Id IS NOT NULL",
        "other_post_types": f"{distinct_posts} WHERE PostTypeId NOT IN (1, 2)",
        "questions": f"{distinct_posts} WHERE PostTypeId = 1 AND Tags IS NOT NULL",
        "answers": f"{distinct_posts} WHERE PostTypeId = 2 AND Tags IS NULL",
        "comments": "raw_comments", "tag_synonyms": "synonyms", "tags": "tags",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS Measure, count(*) AS Count FROM {rows}" for name, rows in measures.items())


def second_load():
    """The incremental load: rows of the second export win, all others stay."""
    def page_load(condition, **changes):
        page = PAGE_QUESTION.format(**changes)
        return f"""
            SELECT 'questions' AS TableName, q.Id, strftime(q.CreationDate, {DAY}) AS PartitionDate,
                   {words(stripped('q.Body'))} AS WordsCount, q.Score,
                   (SELECT string_agg(DISTINCT coalesce(TargetTagName, tag), ',' ORDER BY coalesce(TargetTagName, tag))
                    FROM (SELECT unnest(string_split(replace(q.Tags, '<', ''), '>')) AS tag)
                    LEFT JOIN synonyms ON tag = SourceTagName WHERE tag <> '') AS Detail
            FROM ({page} WHERE {condition}) q WHERE q.OwnerUserId IS NOT NULL AND q.Tags IS NOT NULL"""

    return f"""
        , new_rows AS (
            {page_load("p_type = 'LARGE'", id="3 * page_id", day=" + 1", score=" + 100")}
            UNION ALL
            {page_load("p_type = 'PROMO'", id="3000000000 + 3 * page_id", day="", score="")}
            UNION ALL
            SELECT TableName, Id, PartitionDate, WordsCount, 7, Detail FROM first_load
            WHERE TableName = 'comments' AND Id IN (SELECT doc_id FROM labels)
        )
        SELECT * FROM new_rows
        UNION ALL
        SELECT f.* FROM first_load f
        WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.TableName = f.TableName AND n.Id = f.Id)
    """


# --- lake tables -----------------------------------------------------------------------------

LINE_ID = "((l_orderkey * 100000 + l_partkey) * 1000 + l_suppkey) * 10 + l_linenumber"


def lake(select, tag="p_brand"):
    return f"""WITH
line_tags AS (
    SELECT DISTINCT l_orderkey AS Id, {tag} AS Tag FROM lineitem JOIN part ON l_partkey = p_partkey
),
tag_lists AS (SELECT Id, string_agg(Tag, ',' ORDER BY Tag) AS Tags FROM line_tags GROUP BY Id),
first_returns AS (
    SELECT l_orderkey, {LINE_ID} AS line,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, {LINE_ID}) AS n
    FROM lineitem WHERE l_returnflag = 'A'
),
questions AS (
    SELECT o_orderkey AS Id, line AS AcceptedAnswerId, o_custkey AS OwnerUserId,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS Score,
           CAST(trunc(o_totalprice) AS INTEGER) AS ViewCount, {words('o_orderpriority')} AS WordsCount,
           o_orderdate AS CreationDate, strftime(o_orderdate, {DAY}) AS PartitionDate,
           coalesce(Tags, '') AS Tags
    FROM orders LEFT JOIN first_returns ON o_orderkey = l_orderkey AND n = 1
    LEFT JOIN tag_lists ON o_orderkey = tag_lists.Id
),
answers AS (
    SELECT {LINE_ID} AS Id, l_orderkey AS ParentId, l_suppkey AS OwnerUserId,
           CAST(l_quantity AS INTEGER) AS Score, l_linenumber AS WordsCount, l_shipdate AS CreationDate,
           strftime(l_shipdate, {DAY}) AS PartitionDate
    FROM lineitem
),
comments AS (
    SELECT event_id AS Id, user_id * 100 + event_id % 100 AS PostId, CAST(trunc(value) AS INTEGER) AS Score,
           CAST(length(event_type) AS INTEGER) AS WordsCount,
           CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS Sentiment,
           strftime(ts, {DAY}) AS PartitionDate, event_type
    FROM events
),
day_tags AS (
    SELECT PartitionDate, Tag, count(*) AS Count FROM questions JOIN line_tags USING (Id) GROUP BY ALL
),
top_day_tags AS (
    SELECT PartitionDate, Tag, Count FROM day_tags
    QUALIFY row_number() OVER (PARTITION BY PartitionDate ORDER BY Count DESC, Tag) <= 7
),
answered AS (
    SELECT q.Id, q.Score, q.ViewCount, q.Tags, q.WordsCount, strftime(q.CreationDate, {MOMENT}) AS CreationDate,
           a.Score AS AcceptedAnswerScore, a.WordsCount AS AcceptedAnswerWordsCount,
           q.OwnerUserId = a.OwnerUserId AS SelfAnswered,
           (epoch(a.CreationDate) - epoch(q.CreationDate)) / 3600 AS AcceptedAnswerAppearenceTimeInHours,
           coalesce(n.AnswersCount, 0) AS AnswersCount, n.AverageAnswerWordsCount
    FROM questions q LEFT JOIN answers a ON q.AcceptedAnswerId = a.Id
    LEFT JOIN (SELECT ParentId, count(*) AS AnswersCount, avg(WordsCount) AS AverageAnswerWordsCount
               FROM answers GROUP BY ParentId) n ON q.Id = n.ParentId
),
commented AS (
    SELECT answered.*, coalesce(n.CommentsCount, 0) AS CommentsCount,
           coalesce(n.PositiveCommentsCount, 0) AS PositiveCommentsCount, n.AvgCommentWordsCount
    FROM answered
    LEFT JOIN (SELECT PostId, count(*) AS CommentsCount, CAST(sum(Sentiment) AS BIGINT) AS PositiveCommentsCount,
                      avg(WordsCount) AS AvgCommentWordsCount
               FROM comments GROUP BY PostId) n ON answered.Id = n.PostId
),
totals AS (
    SELECT Tag, count(*) AS QuestionsCount, CAST(sum(AnswersCount) AS BIGINT) AS SumAnswersCount,
           count(AcceptedAnswerScore) AS SumAcceptedAnswerCount,
           count(*) FILTER (WHERE SelfAnswered) AS SumSelfAnswered,
           avg(AnswersCount) AS AnswersPerQuestions,
           count(AcceptedAnswerScore) / count(*) AS AcceptedAnswersPerQuestions,
           (count(*) FILTER (WHERE SelfAnswered)) / count(*) AS SelfAnsweredPerQuestions,
           coalesce(avg(AcceptedAnswerAppearenceTimeInHours), CAST('inf' AS DOUBLE)) AS AvgAcceptedAnswerAppearenceTimeInHours,
           avg(ViewCount) AS AvgQuestionViewCount, avg(WordsCount) AS AvgQuestionWordsCount,
           coalesce(avg(AverageAnswerWordsCount), 0) AS AvgAnswerWordsCount,
           avg(AcceptedAnswerWordsCount) AS AvgAcceptedAnswerWordsCount,
           avg(CommentsCount) AS CommentsCountPerQuestion,
           avg(PositiveCommentsCount) AS PositiveCommentsPerQuestion,
           avg(AvgCommentWordsCount) AS AvgCommentWordsCount_,
           CAST(sum(CommentsCount) AS BIGINT) AS SumCommentsCount,
           CAST(sum(PositiveCommentsCount) AS BIGINT) AS SumPositiveComments
    FROM commented JOIN line_tags USING (Id) GROUP BY Tag
),
scorecard AS (
    SELECT *, CASE WHEN SumCommentsCount <> 0 THEN SumPositiveComments / SumCommentsCount ELSE 0 END AS PortionsOfPositiveComments,
           SumAcceptedAnswerCount / QuestionsCount AS PortionsOfAnswered
    FROM totals
),
baskets AS (SELECT count(*) AS n FROM questions),
itemsets AS (
    SELECT Tag AS items, [Tag] AS list, count(*) AS freq FROM line_tags GROUP BY Tag
    UNION ALL
    SELECT a.Tag || '-' || b.Tag, [a.Tag, b.Tag], count(*)
    FROM line_tags a JOIN line_tags b ON a.Id = b.Id AND a.Tag < b.Tag GROUP BY a.Tag, b.Tag
    UNION ALL
    SELECT a.Tag || '-' || b.Tag || '-' || c.Tag, [a.Tag, b.Tag, c.Tag], count(*)
    FROM line_tags a JOIN line_tags b ON a.Id = b.Id AND a.Tag < b.Tag
    JOIN line_tags c ON a.Id = c.Id AND b.Tag < c.Tag GROUP BY a.Tag, b.Tag, c.Tag
),
frequent AS (SELECT itemsets.* FROM itemsets, baskets WHERE freq >= ceil(0.01 * n)),
rules AS (
    SELECT a.items AS antecedent, c.items AS consequent, s.freq / a.freq AS confidence,
           (s.freq / a.freq) / (c.freq / n) AS lift, s.freq / n AS support
    FROM (SELECT freq, list, unnest(list) AS item FROM frequent WHERE len(list) > 1) s
    JOIN frequent a ON a.list = list_filter(s.list, lambda x: x <> s.item)
    JOIN frequent c ON c.list = [s.item], baskets
    WHERE s.freq / a.freq >= 0.1
)
{select}"""


def rounded(*columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


ANSWERED = f"""Id, Score, ViewCount, Tags, WordsCount, CreationDate, AcceptedAnswerScore,
    AcceptedAnswerWordsCount, SelfAnswered, AnswersCount,
    {rounded('AcceptedAnswerAppearenceTimeInHours', 'AverageAnswerWordsCount')}"""
BRAND_TYPE = "p_brand || ' ' || p_type"
SCORECARD = f"""SELECT Tag, QuestionsCount, SumAnswersCount, SumAcceptedAnswerCount, SumSelfAnswered,
    SumCommentsCount, SumPositiveComments, {rounded(
        'AnswersPerQuestions', 'AcceptedAnswersPerQuestions', 'SelfAnsweredPerQuestions',
        'AvgAcceptedAnswerAppearenceTimeInHours', 'AvgQuestionViewCount', 'AvgQuestionWordsCount',
        'AvgAnswerWordsCount', 'AvgAcceptedAnswerWordsCount', 'CommentsCountPerQuestion',
        'PositiveCommentsPerQuestion', 'AvgCommentWordsCount_', 'PortionsOfPositiveComments',
        'PortionsOfAnswered')} FROM scorecard"""


def leaderboard(metric):
    ranked = f"""
        SELECT Tag, {metric} AS Value,
               row_number() OVER (ORDER BY {metric} DESC NULLS LAST, QuestionsCount DESC, Tag) AS t,
               row_number() OVER (ORDER BY {metric} ASC NULLS LAST, QuestionsCount DESC, Tag) AS b
        FROM (SELECT * FROM scorecard ORDER BY QuestionsCount DESC, Tag LIMIT 50)"""
    return " UNION ALL ".join(
        f"SELECT '{metric}' AS Metric, '{side}' AS Side, CAST({rank} AS INTEGER) AS Rank, Tag, "
        f"round(Value, 6) AS Value FROM ({ranked}) WHERE {rank} <= 10"
        for side, rank in (("top", "t"), ("bottom", "b")))


OVERVIEW = " UNION ALL ".join(
    f"SELECT Tag, '{chart}' AS Chart, '{category}' AS Category, {count} AS Count FROM scorecard"
    for chart, category, count in (
        ("Publications", "Questions", "QuestionsCount"),
        ("Publications", "Answers", "SumAnswersCount"),
        ("Publications", "Comments", "SumCommentsCount"),
        ("Comments", "negative", "SumCommentsCount - SumPositiveComments"),
        ("Comments", "positive", "SumPositiveComments"),
        ("Questions", "not_answered", "QuestionsCount - SumAcceptedAnswerCount"),
        ("Questions", "answered", "SumAcceptedAnswerCount")))

DESCRIBE = " UNION ALL ".join(
    f"SELECT '{name}' AS summary, round({call('Score')}, 6) AS Score, "
    f"round({call('WordsCount')}, 6) AS WordsCount, {day} AS PartitionDate FROM answers"
    for name, call, day in (
        ("count", lambda c: f"CAST(count({c}) AS DOUBLE)", "CAST(count(PartitionDate) AS VARCHAR)"),
        ("mean", lambda c: f"avg({c})", "NULL"),
        ("stddev", lambda c: f"stddev_samp({c})", "NULL"),
        ("min", lambda c: f"CAST(min({c}) AS DOUBLE)", "min(PartitionDate)"),
        ("max", lambda c: f"CAST(max({c}) AS DOUBLE)", "max(PartitionDate)")))

SUMMARIZE = " UNION ALL ".join(
    f"SELECT '{name}' AS summary, " + ", ".join(
        f"round(CAST({call(c)} AS DOUBLE), 6) AS {c}" for c in ("Score", "WordsCount", "OwnerUserId"))
    + " FROM answers"
    for name, call in (
        ("count", lambda c: f"count({c})"), ("mean", lambda c: f"avg({c})"),
        ("stddev", lambda c: f"stddev_samp({c})"), ("min", lambda c: f"min({c})"),
        ("25%", lambda c: f"quantile_disc({c}, 0.25)"), ("50%", lambda c: f"quantile_disc({c}, 0.5)"),
        ("75%", lambda c: f"quantile_disc({c}, 0.75)"), ("max", lambda c: f"max({c})")))

UPSERT = """, new_rows AS (
    SELECT Id, PostId, Score, WordsCount + 1 AS WordsCount, 0 AS Sentiment, '31_01_2024' AS PartitionDate
    FROM comments WHERE event_type = 'purchase'
    UNION ALL
    SELECT Id + 1000000000, PostId, Score, WordsCount, Sentiment, PartitionDate
    FROM comments WHERE event_type = 'signup'
)
SELECT * FROM new_rows
UNION ALL
SELECT Id, PostId, Score, WordsCount, Sentiment, PartitionDate FROM comments
WHERE Id NOT IN (SELECT Id FROM new_rows)"""


# Columns of the raw exports with their types; those that no given table fills are empty.
RAW_COLUMNS = {
    ("posts", "raw_posts"): (schemas.POSTS, {"Id", "PostTypeId", "AcceptedAnswerId", "ParentId", "CreationDate", "Score",
                                             "ViewCount", "Body", "OwnerUserId", "Title", "Tags"}),
    ("comments", "(SELECT *, CASE WHEN Id >= 1000000000 THEN (Id - 1000000000) // 8 END AS UserId FROM raw_comments)"): (
        schemas.COMMENTS, {"Id", "PostId", "Score", "Text", "CreationDate", "UserId"}),
    ("synonyms", "synonyms"): (schemas.TAG_SYNONYMS, {"SourceTagName", "TargetTagName"}),
}


def profile_of(name, view, column, kind, filled):
    value = column if filled else "CAST(NULL AS BIGINT)"
    numeric, moment = kind in ("BIGINT", "INT"), kind == "TIMESTAMP"

    def shown(expression):
        return f"strftime({expression}, {MOMENT})" if moment and filled else f"CAST({expression} AS VARCHAR)"

    quartiles = (f"array_to_string([{', '.join(shown(f'quantile_disc({value}, {q})') for q in (0.25, 0.5, 0.75))}], ',')"
                 if numeric or moment else "''")
    return (f"SELECT '{name}' AS \"Table\", '{column}' AS \"Column\", '{kind.lower()}' AS Type, count({value}) AS Count, "
            + (f"round(avg({value}), 6) AS Mean, round(stddev_samp({value}), 6) AS Stddev, " if numeric
               else "CAST(NULL AS DOUBLE) AS Mean, CAST(NULL AS DOUBLE) AS Stddev, ")
            + f"{shown(f'min({value})')} AS Min, {shown(f'max({value})')} AS Max, coalesce({quartiles}, '') AS Quantiles FROM {view}")


PROFILE = " UNION ALL ".join(
    profile_of(name, view, *field.split(), field.split()[0] in filled)
    for (name, view), (schema, filled) in RAW_COLUMNS.items() for field in schema.split(","))

PREVIEWS = f"""
SELECT * FROM (SELECT 'answers' AS TableName, Id, ParentId AS OnPost, OwnerUserId, Score, WordsCount,
                      strftime(CreationDate, {MOMENT}) AS CreationDate, CAST(NULL AS INTEGER) AS Sentiment, PartitionDate
               FROM answers ORDER BY Id LIMIT 100)
UNION ALL
SELECT * FROM (SELECT 'comments', Id, PostId, CAST(NULL AS BIGINT), Score, WordsCount, CAST(NULL AS VARCHAR), Sentiment, PartitionDate
               FROM comments ORDER BY Id LIMIT 100)"""

WEIGHTED = """WITH tokens AS (
    SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM documents),
learnt AS (SELECT doc_id, 1 - toxic AS label FROM labels WHERE md5(CAST(doc_id AS VARCHAR)) >= '4'),
counted AS (
    SELECT token, sum(label) AS positive, sum(1 - label) AS negative FROM tokens JOIN learnt USING (doc_id)
    WHERE token <> '' GROUP BY token HAVING count(*) >= 5),
totals AS (SELECT sum(positive) + count(*) AS of_positive, sum(negative) + count(*) AS of_negative FROM counted),
weights AS (
    SELECT token, (ln(positive + 1) - ln(of_positive)) - (ln(negative + 1) - ln(of_negative)) AS weight FROM counted, totals),
prior AS (SELECT ln(sum(label) + 1) - ln(sum(1 - label) + 1) AS weight FROM learnt JOIN documents USING (doc_id)),
scores AS (
    SELECT doc_id, CASE WHEN text IS NOT NULL THEN prior.weight + coalesce(added, 0) END AS score
    FROM documents CROSS JOIN prior
    LEFT JOIN (SELECT doc_id, sum(weight) AS added FROM tokens JOIN weights USING (token) GROUP BY doc_id) USING (doc_id))"""

REJECTS = """, exported AS (
    SELECT 'posts' AS Export, NULL AS Id, false AS Bad, true AS Dated FROM raw_posts
    UNION ALL SELECT 'synonyms', NULL, false, true FROM synonyms
    UNION ALL SELECT 'comments', CASE Id % 13 WHEN 0 THEN 'x' ELSE '' END || Id, Id % 13 < 3, CreationDate IS NOT NULL
    FROM raw_comments
)
SELECT Export, Outcome, CAST(NULL AS VARCHAR) AS Id, Records
FROM (SELECT Export, count(*) AS Read, count(*) FILTER (WHERE NOT Bad) AS Loaded, count(*) FILTER (WHERE Bad) AS Rejected
      FROM exported GROUP BY Export) UNPIVOT (Records FOR Outcome IN (Read, Loaded, Rejected))
UNION ALL
SELECT Export, CASE WHEN Bad THEN 'record' ELSE 'stored' END, Id, count(*)
FROM exported WHERE Export = 'comments' AND (Bad OR Dated) GROUP BY ALL"""


def all_oracles():
    return {
        "prepare_posts": raw(f"SELECT * REPLACE (strftime(CreationDate, {MOMENT}) AS CreationDate) FROM posts"),
        "questions_from_posts": raw("SELECT * FROM questions"),
        "answers_from_posts": raw("SELECT * FROM answers"),
        "prepare_comments": raw("SELECT * FROM comments"),
        "strip_html": f"SELECT page_id, {stripped('html')} AS text, {stripped('html', ' ')} AS spaced_text FROM pages",
        "word_count": f"SELECT doc_id, {words('text')} AS words FROM documents",
        "explode_tags": raw(f"SELECT strftime(CreationDate, {MOMENT}) AS CreationDate, Tag FROM single_tags"),
        "tag_synonyms": raw(
            f"SELECT strftime(CreationDate, {MOMENT}) AS CreationDate, coalesce(TargetTagName, Tag) AS Tag "
            "FROM single_tags LEFT JOIN synonyms ON Tag = SourceTagName"),
        "answers_with_question_tags": raw(
            f"SELECT Id, strftime(CreationDate, {MOMENT}) AS CreationDate, Tags FROM answer_tags"),
        "comments_with_posts_tags": raw(
            f"SELECT strftime(c.CreationDate, {MOMENT}) AS CreationDate, q.Tags "
            "FROM raw_questions q JOIN raw_comments c ON q.Id = c.PostId"),
        "day_tag_counts": raw(
            "SELECT strftime(CreationDate, '%Y-%m-%d') AS Date, t.Id AS TagId, s.Tag, count(*) AS Count "
            "FROM single_tags s JOIN tags t ON s.Tag = t.TagName GROUP BY ALL"),
        "tag_usage_per_day": raw(
            "SELECT strftime(CreationDate, '%Y-%m-%d') AS Date, t.Id AS TagId, m.Tag, count(*) AS Count "
            "FROM moment_tags m JOIN tags t ON m.Tag = t.TagName GROUP BY ALL"),
        "data_profile": raw(raw_counts()),
        "profile_raw_tables": raw(PROFILE),
        "table_previews": lake(PREVIEWS),
        "describe_posts": lake(DESCRIBE),
        "summarize_posts": lake(SUMMARIZE),
        "comment_sentiment": "SELECT doc_id, " + sentiment(
            "text", ("the", "of", "and", "best"), ("de", "der", "idiot", "stupid", "worthless"))
        + " AS Sentiment FROM documents",
        "sentiment_by_model": f"{WEIGHTED} SELECT doc_id, CAST(score > 0 AS INTEGER) AS Sentiment FROM scores",
        "sentiment_by_weights": f"{WEIGHTED} SELECT doc_id, md5(CAST(doc_id AS VARCHAR)) < '4' AS HeldOut, "
                                "round(score, 4) AS Score, CAST(score > 0 AS INTEGER) AS Sentiment FROM scores",
        "partition_date_parse": lake(
            f"SELECT Id, PartitionDate, strftime(date_trunc('day', CreationDate), {MOMENT}) AS Day FROM questions"),
        "table_preview": lake(
            f"SELECT * REPLACE (strftime(CreationDate, {MOMENT}) AS CreationDate), "
            "CAST(NULL AS VARCHAR) AS ClosedDate FROM questions ORDER BY Id LIMIT 100"),
        "general_info": lake(
            "SELECT 'Questions' AS Category, count(*) AS Count FROM questions UNION ALL "
            "SELECT 'Answers', count(*) FROM answers UNION ALL SELECT 'Comments', count(*) FROM comments"),
        "top_tags_per_day": lake("SELECT * FROM top_day_tags"),
        "tag_frequency_series": lake(
            f"SELECT strftime(strptime(PartitionDate, {DAY}), {MOMENT}) AS PartitionDate, Tag, Count "
            "FROM day_tags WHERE Tag IN (SELECT Tag FROM top_day_tags)"),
        "question_answer_info": lake(f"SELECT {ANSWERED} FROM answered", BRAND_TYPE),
        "question_comment_info": lake(
            f"SELECT {ANSWERED}, CommentsCount, PositiveCommentsCount, {rounded('AvgCommentWordsCount')} "
            "FROM commented", BRAND_TYPE),
        "tag_scorecard": lake(SCORECARD, BRAND_TYPE),
        "result_roundtrip": lake(SCORECARD, BRAND_TYPE),
        "tag_averages": lake(
            "SELECT Tag, round(avg(Score), 6) AS AverageQuestionScore, "
            "round(avg(ViewCount), 6) AS AverageQuestionViewCount, "
            "round(avg(AcceptedAnswerWordsCount), 6) AS AverageAcceptedAnswerWordsCount "
            "FROM answered JOIN line_tags USING (Id) GROUP BY Tag", BRAND_TYPE),
        "answer_count_buckets": lake(
            "SELECT CASE WHEN AnswersCount > 2 THEN '> 2' ELSE CAST(AnswersCount AS VARCHAR) END AS Answers, "
            "count(*) AS Questions FROM answered GROUP BY 1"),
        "leaderboards": lake(" UNION ALL ".join(map(leaderboard, LEADERBOARD_METRICS)), BRAND_TYPE),
        **{f"leaderboard_{m}": lake(leaderboard(m), BRAND_TYPE) for m in LEADERBOARD_METRICS},
        "tag_options": lake(
            "SELECT Tag FROM (SELECT * FROM scorecard ORDER BY QuestionsCount DESC, Tag LIMIT 100)", BRAND_TYPE),
        "tag_overview": lake(OVERVIEW, BRAND_TYPE),
        "freq_itemsets": lake("SELECT items, CAST(len(list) AS INTEGER) AS size, freq FROM frequent"),
        "top_itemsets": lake(
            "SELECT items, array_to_string(list, ',') AS item_list, freq FROM frequent "
            "ORDER BY freq DESC, items LIMIT 16"),
        "association_rules": lake(
            f"SELECT antecedent, consequent, {rounded('confidence', 'lift', 'support')} FROM rules"),
        "rule_graph_edges": lake(
            "SELECT antecedent AS source, consequent AS target, round(support, 6) AS weight, "
            "printf('%.4f', support) AS label FROM rules"),
        "rule_graph_nodes": lake("SELECT antecedent AS node FROM rules UNION SELECT consequent FROM rules"),
        "csv_roundtrip": raw(
            f"""SELECT Id, PostTypeId, AcceptedAnswerId, ParentId, strftime(CreationDate, {MOMENT}) AS CreationDate,
                CAST(NULL AS VARCHAR) AS DeletionDate, Score, ViewCount, Body, OwnerUserId,
                CAST(NULL AS VARCHAR) AS OwnerDisplayName, CAST(NULL AS BIGINT) AS LastEditorUserId,
                CAST(NULL AS VARCHAR) AS LastEditorDisplayName, CAST(NULL AS VARCHAR) AS LastEditDate,
                CAST(NULL AS VARCHAR) AS LastActivityDate, Title, Tags, CAST(NULL AS INTEGER) AS AnswerCount,
                CAST(NULL AS INTEGER) AS CommentCount, CAST(NULL AS INTEGER) AS FavoriteCount,
                CAST(NULL AS VARCHAR) AS ClosedDate, CAST(NULL AS VARCHAR) AS CommunityOwnedDate,
                CAST(NULL AS VARCHAR) AS ContentLicense
            FROM raw_posts"""),
        "partitioned_write": lake("SELECT * EXCLUDE (event_type) FROM comments"),
        "upsert_by_id": lake(UPSERT),
        "etl_initial": raw("SELECT * FROM first_load"),
        "etl_incremental": raw(second_load()),
        "etl_rejects": raw(REJECTS),
    }
