"""A hand-made forum small enough to check by eye."""

from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import types as T

from tagloom import schemas


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M") if text else None


def table(spark, schema, rows):
    """Rows given as dicts; columns not named are NULL."""
    wanted = T.StructType.fromDDL(schema)
    return spark.createDataFrame([tuple(r.get(n) for n in wanted.names) for r in rows], wanted)


def post(id, kind, created, score, body, owner, tags, accepted=None, parent=None, views=None):
    return dict(Id=id, PostTypeId=kind, AcceptedAnswerId=accepted, ParentId=parent,
                CreationDate=at(created), Score=score, ViewCount=views, Body=body,
                OwnerUserId=owner, Tags=tags)


def comment(id, post_id, score, text, created):
    return dict(Id=id, PostId=post_id, Score=score, Text=text, CreationDate=at(created))


POSTS = [
    post(1, 1, "2024-01-01 00:00", 5, "<p>How  to x</p>", 100, "<py><python><spark>", 11, None, 100),
    post(2, 1, "2024-01-01 10:00", 0, "why", 101, "<python>", views=10),
    post(2, 1, "2024-01-01 10:00", 0, "why", 101, "<python>", views=10),
    post(3, 1, "2024-01-02 00:00", 1, "a b c", 102, "<sql><py>", 12, None, 50),
    post(4, 1, "2024-01-02 00:00", 0, "orphan", None, "<sql><py>", views=1),
    post(5, 1, "2024-01-02 00:00", 0, "untagged", 103, None, views=1),
    post(6, 1, "2024-01-04 00:00", 0, "late", None, "<spark>", views=1),
    post(7, 4, "2024-01-02 00:00", 0, "wiki", 104, None),
    post(11, 2, "2024-01-01 02:00", 3, "use y", 200, None, parent=1),
    post(12, 2, "2024-01-02 12:00", 2, "one two three four", 102, None, parent=3),
    post(13, 2, "2024-01-03 00:00", 0, "no", 201, None, parent=1),
    {},
]
COMMENTS = [
    comment(21, 1, 0, "great thanks", "2024-01-01 03:00"),
    comment(22, 1, 1, "bad <b>idea</b>", "2024-01-01 04:00"),
    comment(23, 11, 0, "great", "2024-01-01 05:00"),
    comment(24, 3, 0, "no date", None),
    comment(25, 3, 0, "love it", "2024-01-02 01:00"),
]
SYNONYMS = [dict(SourceTagName="py", TargetTagName="python"),
            dict(SourceTagName="postgres", TargetTagName="sql")]
TAGS = [dict(Id=1, TagName="python", Count=3), dict(Id=2, TagName="spark", Count=1)]


def forum(spark):
    return SimpleNamespace(
        posts=table(spark, schemas.POSTS, POSTS),
        comments=table(spark, schemas.COMMENTS, COMMENTS),
        synonyms=table(spark, schemas.TAG_SYNONYMS, SYNONYMS),
        tags=table(spark, schemas.TAGS, TAGS),
    )
