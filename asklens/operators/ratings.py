"""User-question ratings from weighted actions.

The reference builds a nested dict in one Python process and upserts row by
row; here every step is a distributed set operation: distinct-weight sums
are a two-level aggregate with map-side combine, the id lookup is a join,
the upsert an anti-join plus union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.functions.text import tolerant_int, too_large_int

# Rating weights.  A question the user follows rates 5; answer
# actions: approve 1, collect 1.5, anything else (publish, comment, ...) 2.5.
RATE_FOLLOW = 5.0
RATE_APPROVE = 1.0
RATE_COLLECT = 1.5
RATE_OTHER = 2.5
ACT_APPROVE = "answer_approve"
ACT_COLLECT = "answer_collect"


def action_weight(act_type: Column) -> Column:
    return (F.when(act_type == ACT_APPROVE, F.lit(RATE_APPROVE))
            .when(act_type == ACT_COLLECT, F.lit(RATE_COLLECT))
            .otherwise(F.lit(RATE_OTHER)))


def follow_rates(follows: DataFrame) -> DataFrame:
    """(userUrlToken, questionId, rate=5) of followed questions."""
    return follows.select("userUrlToken", "questionId", F.lit(RATE_FOLLOW).alias("rate"))


def weighted_actions(actions: DataFrame) -> DataFrame:
    return actions.withColumn("rate", action_weight(F.col("actType")))


def required_keys(df: DataFrame, keys=("userUrlToken", "questionId", "actType")) -> DataFrame:
    """Drop records missing any required key."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def last_doc_per_user(docs: DataFrame, user: str = "urlToken", order: str = "_id") -> DataFrame:
    """The document with the largest ``order`` per user: later documents replace
    earlier ones (D12).  ``max_by`` is a partial aggregate: one row per user per task."""
    cols = docs.columns
    picked = docs.groupBy(user).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_doc"))
    return picked.select(*[F.col("_doc")[c].alias(c) for c in cols])


def followed_questions(docs: DataFrame) -> DataFrame:
    """(userUrlToken, questionId, rate=5) from each user's last follow document that has questions.

    Documents lacking a user or a question list are no candidates, so a later one
    without questions does not hide an earlier one's."""
    last = last_doc_per_user(docs.select("_id", "urlToken", "question")
                             .where(F.col("urlToken").isNotNull() & F.col("question").isNotNull()))
    return follow_rates(last.select(F.col("urlToken").alias("userUrlToken"),
                                    F.explode("question.id").alias("questionId")))


def action_rating(weighted: DataFrame, followed: DataFrame | None = None) -> DataFrame:
    """Sum of the *distinct* weights per (user, question) (D11), over answer actions
    and, when given, followed questions rated 5 (G2; see ``followed_questions``)."""
    rows = required_keys(weighted).select("userUrlToken", "questionId", "rate")
    if followed is not None:
        rows = rows.unionByName(required_keys(followed.select("userUrlToken", "questionId", "rate"),
                                              ("userUrlToken", "questionId")))
    return rows.groupBy("userUrlToken", "questionId").agg(F.sum_distinct("rate").alias("rate"))


def first_match(idmap: DataFrame, key: str = "urlToken", value: str = "UId",
                order: str = "_id") -> DataFrame:
    """First record per key by ``order`` (D15): (key, value)."""
    return idmap.groupBy(key).agg(F.min_by(value, order).alias(value))


def user_id_lookup(users: DataFrame, idmap: DataFrame, user_col: str = "userUrlToken") -> DataFrame:
    """(user, UId): first id-map match per token, users without one skipped."""
    ids = first_match(idmap).select(F.col("urlToken").alias(user_col),
                                    tolerant_int(F.col("UId")).alias("UId"))
    return (users.select(user_col).distinct().join(ids, user_col)
            .where(F.col("UId").isNotNull()))


def to_ratings(rated: DataFrame, idmap: DataFrame) -> DataFrame:
    """(UId bigint, QId bigint, rate double), one row per (UId, QId).

    Rows whose ids are not integers are skipped, as ``int()`` failing skips them in the
    reference (B9).  Different texts can name the same pair ("7" and " 7", two tokens with one id); the
    reference keeps the value written last, here the one of the largest (token, question text)."""
    ids = first_match(idmap).select(F.col("urlToken").alias("userUrlToken"), tolerant_int(F.col("UId")).alias("UId"))
    named = (rated.select("userUrlToken", "questionId", "rate", tolerant_int(F.col("questionId")).alias("QId"))
             .where(F.col("QId").isNotNull()).join(ids.where(F.col("UId").isNotNull()), "userUrlToken"))
    return named.groupBy("UId", "QId").agg(
        F.max_by(F.col("rate").cast("double"), F.struct("userUrlToken", "questionId")).alias("rate"))


def rejected_ratings(rated: DataFrame, idmap: DataFrame) -> DataFrame:
    """(userUrlToken, questionId, UId, rate): what ``to_ratings`` cannot hold, as an id is an integer of more than 64 bits."""
    ids = first_match(idmap).select(F.col("urlToken").alias("userUrlToken"), "UId")
    rows = rated.join(ids, "userUrlToken").select("userUrlToken", "questionId", "UId", "rate")
    held = tolerant_int(F.col("questionId")).isNotNull(), tolerant_int(F.col("UId")).isNotNull()
    large = too_large_int(F.col("questionId")), too_large_int(F.col("UId"))
    return rows.where((large[0] | large[1]) & (held[0] | large[0]) & (held[1] | large[1]))


def upsert(old: DataFrame, new: DataFrame, keys=("UId", "QId")) -> DataFrame:
    """Insert-or-replace on ``keys`` (A10): new rows, plus old rows no new row replaces.  Two new rows of
    one key are an error: nothing says which of them is to stay."""
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    twice = F.raise_error(F.lit(f"two new rows with the same {', '.join(keys)}"))
    one = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(F.lit(1).alias("__one"), *rest)).alias("__row"))
    one = one.where(F.when(F.col("__n") == 1, F.lit(True)).otherwise(twice.cast("boolean"))).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])
    one = one.select(*new.columns)
    return one.unionByName(old.join(one.select(*keys), keys, "left_anti"))
