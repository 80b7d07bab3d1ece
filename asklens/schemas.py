"""Fixed schemas of the reference's inputs and outputs (see FIXTURES.md)."""

from pyspark.sql import types as T

# The 20 counter fields of a user profile, in the reference's order.
PROFILE_COUNTERS = [
    "followerCount", "followingCount", "answerCount", "questionCount",
    "commercialQuestionCount", "articlesCount", "favoritedCount", "pinsCount",
    "logsCount", "voteupCount", "thankedCount", "hostedLiveCount",
    "followingColumnsCount", "followingTopicCount", "followingQuestionCount",
    "followingFavlistsCount", "voteToCount", "voteFromCount", "thankToCount",
    "thankFromCount",
]

EDUCATION = T.StructType([
    T.StructField("school", T.StringType()),
    T.StructField("major", T.StringType()),
])

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("urlToken", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("isOrg", T.BooleanType()),
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("isActive", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("badge", T.ArrayType(T.StringType())),
    ]
    + [T.StructField(c, T.LongType()) for c in PROFILE_COUNTERS]
    + [
        T.StructField("business", T.StringType()),
        T.StructField("locations", T.ArrayType(T.StringType())),
        T.StructField("educations", T.ArrayType(EDUCATION)),
    ]
)

# The scalar keys a raw profile record must carry (the crawler reads each one by key).
PROFILE_SCALAR_KEYS = [
    "id", "urlToken", "name", "isOrg", "type", "url", "headline", "isActive",
    "description", "gender", "badge",
] + PROFILE_COUNTERS

NAMED = T.StructType([T.StructField("name", T.StringType())])

# Raw user object as embedded in a profile page (nested business/locations/educations).
RAW_PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("urlToken", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("isOrg", T.BooleanType()),
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("headline", T.StringType()),
        T.StructField("isActive", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("badge", T.ArrayType(T.StringType())),
    ]
    + [T.StructField(c, T.LongType()) for c in PROFILE_COUNTERS]
    + [
        T.StructField("business", NAMED),
        T.StructField("locations", T.ArrayType(NAMED)),
        T.StructField("educations", T.ArrayType(T.StructType([
            T.StructField("school", NAMED),
            T.StructField("major", NAMED),
        ]))),
    ]
)

ID_TITLE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
])

FOLLOW_DOC_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("urlToken", T.StringType()),
    T.StructField("following", T.ArrayType(T.StructType([
        T.StructField("urlToken", T.StringType()),
        T.StructField("name", T.StringType()),
    ]))),
    T.StructField("question", T.ArrayType(ID_TITLE)),
    T.StructField("topic", T.ArrayType(ID_TITLE)),
])

ACTION_SCHEMA = T.StructType([
    T.StructField("userUrlToken", T.StringType()),
    T.StructField("questionId", T.StringType()),
    T.StructField("actType", T.StringType()),
])

# Ids are 64-bit here (the reference parses them with Python's unbounded int());
# for ALS, whose columns are 32-bit, ids are always renumbered.
RATING_SCHEMA = T.StructType([
    T.StructField("UId", T.LongType()),
    T.StructField("QId", T.LongType()),
    T.StructField("rate", T.DoubleType()),
])

VERTEX_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("node", T.StringType()),
])

EDGE_SCHEMA = T.StructType([
    T.StructField("srcId", T.LongType()),
    T.StructField("dstId", T.LongType()),
    T.StructField("relation", T.StringType()),
])

# Follow-list API page: paging flag and one record per followed user.
API_PAGE_SCHEMA = T.StructType([
    T.StructField("paging", T.StructType([T.StructField("is_end", T.BooleanType())])),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("url_token", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("gender", T.IntegerType()),
    ]))),
])
