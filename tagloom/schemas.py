"""Input schemas of the four forum exports and names of the lake tables.

Fixed values: field names, their order and their types are those of the public data
export, so that files can be read without inference. Ids are BIGINT.
"""

POSTS = """
    Id BIGINT, PostTypeId INT, AcceptedAnswerId BIGINT, ParentId BIGINT,
    CreationDate TIMESTAMP, DeletionDate TIMESTAMP, Score INT, ViewCount INT, Body STRING,
    OwnerUserId BIGINT, OwnerDisplayName STRING, LastEditorUserId BIGINT,
    LastEditorDisplayName STRING, LastEditDate TIMESTAMP, LastActivityDate TIMESTAMP,
    Title STRING, Tags STRING, AnswerCount INT, CommentCount INT, FavoriteCount INT,
    ClosedDate TIMESTAMP, CommunityOwnedDate TIMESTAMP, ContentLicense STRING
"""

COMMENTS = """
    Id BIGINT, PostId BIGINT, Score INT, Text STRING, CreationDate TIMESTAMP,
    UserDisplayName STRING, UserId BIGINT, ContentLicense STRING
"""

TAG_SYNONYMS = """
    Id BIGINT, SourceTagName STRING, TargetTagName STRING, CreationDate TIMESTAMP,
    OwnerUserId BIGINT, AutoRenameCount INT, LastAutoRename TIMESTAMP, Score INT,
    ApprovedByUserId BIGINT, ApprovalDate TIMESTAMP
"""

TAGS = """
    Id BIGINT, TagName STRING, Count INT, ExcerptPostId BIGINT, WikiPostId BIGINT,
    IsModeratorOnly STRING, IsRequired STRING
"""

QUESTION_TYPE = 1
ANSWER_TYPE = 2

QUESTIONS_TABLE = "questions"
ANSWERS_TABLE = "answers"
COMMENTS_TABLE = "comments"

PARTITION_COLUMN = "PartitionDate"
