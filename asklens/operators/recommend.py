"""Question recommendation: split, ALS, predictions, RMSE, top-k.

ALS is MLlib's distributed solver (blocked factors, checkpointed every
``checkpointInterval`` iterations into the session's checkpoint folder).
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asklens.operators import inner_product

# The reference's ALS settings (rank is ALS's default).
ALS_MAX_ITER = 15
ALS_REG = 0.22
ALS_RANK = 10
TOP_K = 10


def hash_split(ratings: DataFrame, train_tenths: int = 8) -> DataFrame:
    """Repeatable split by arithmetic on the ids: part = 'train' / 'test' (J1)."""
    bucket = F.pmod(F.col("UId").cast("long") * F.lit(31) + F.col("QId").cast("long"), F.lit(10))
    return ratings.withColumn("part", F.when(bucket < train_tenths, "train").otherwise("test"))


def random_split(ratings: DataFrame, weights=(0.8, 0.2), seed: int = 42):
    return ratings.randomSplit(list(weights), seed)


# ALS blocks per side.  MLlib seeds its factors by block, so the model depends on this number;
# it is a parameter with one default and never taken from the data or the cluster.
ALS_BLOCKS = 10


class Recommender:
    """A fitted ALS model plus its id maps.

    MLlib's ALS takes 32-bit int ids, so users and items are always renumbered with ``dense_index`` (no
    single-partition window) and results are mapped back.  ALS runs on the columns ``_u``/``_q``."""

    def __init__(self, model: ALSModel, users: DataFrame, items: DataFrame):
        self.model, self.users, self.items = model, users, items

    def _with_index(self, df: DataFrame) -> DataFrame:
        """Rows whose user and item occur in training (others are cold starts, dropped)."""
        return df.join(self.users, "UId").join(self.items, "QId")


def _index(train: DataFrame, col: str, idx: str) -> DataFrame:
    from asklens.operators.graph import dense_index

    ids = dense_index(train.select(col).distinct(), col, idx)
    return ids.select(F.col(idx).cast("int").alias(idx), col)


def fit_als(train: DataFrame, seed: int = 42, rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER,
            reg: float = ALS_REG, num_blocks: int = ALS_BLOCKS) -> Recommender:
    """``num_blocks`` splits users and items into so many groups each; on a cluster choose it once for a model,
    for example one block per 100,000 ratings."""
    from pyspark import StorageLevel

    train = train.persist(StorageLevel.MEMORY_AND_DISK)  # read by the two numberings and by the fit
    try:
        rec = Recommender(None, _index(train, "UId", "_u"), _index(train, "QId", "_q"))
        als = (ALS().setMaxIter(max_iter).setRegParam(reg).setRank(rank).setSeed(seed)
               .setUserCol("_u").setItemCol("_q").setRatingCol("rate")
               .setNumUserBlocks(num_blocks).setNumItemBlocks(num_blocks)
               .setColdStartStrategy("drop"))
        rec.model = als.fit(rec._with_index(train))
    finally:
        train.unpersist()
    return rec


def predict(rec: Recommender, test: DataFrame) -> DataFrame:
    """Predictions on held-out rows; users or items unseen in training are dropped."""
    cols = test.columns
    out = rec.model.setColdStartStrategy("drop").transform(rec._with_index(test))
    return out.select(*cols, "prediction")


def rmse(predictions: DataFrame, label: str = "rate", prediction: str = "prediction") -> DataFrame:
    """One-row frame (rmse, n): a distributed aggregate, no rows reach the driver."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return predictions.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def rmse_value(predictions: DataFrame, label: str = "rate", prediction: str = "prediction") -> float:
    ev = RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol=prediction)
    return ev.evaluate(predictions)


def mean_rate_predictor(train: DataFrame, test: DataFrame) -> DataFrame:
    """Baseline model: a question's mean training rate; unseen questions dropped."""
    means = train.groupBy("QId").agg(F.avg("rate").alias("prediction"))
    return test.join(means, "QId")


def _named(rec: Recommender, recs: DataFrame) -> DataFrame:
    flat = (recs.select("_u", F.explode("recommendations").alias("r"))
            .select("_u", F.col("r._q").alias("_q"), F.col("r.rating").cast("double").alias("Rating")))
    return flat.join(rec.users, "_u").join(rec.items, "_q").select("UId", "QId", "Rating")


def pruned_search(rec: Recommender, k: int = TOP_K, **options) -> inner_product.TopItems:
    """The k best items of every user by maximum inner product search; see ``inner_product``."""
    return inner_product.top_items(rec.model.userFactors, rec.model.itemFactors, k, **options)


def named_items(rec: Recommender, found: inner_product.TopItems) -> DataFrame:
    """(UId, QId, Rating double, position) of a search."""
    flat = found.best.select(F.col("user").alias("_u"), F.col("item").alias("_q"), F.col("rating").cast("double").alias("Rating"), "position")
    return flat.join(rec.users, "_u").join(rec.items, "_q").select("UId", "QId", "Rating", "position")


def top_items(rec: Recommender, k: int = TOP_K, **options) -> DataFrame:
    """(UId, QId, Rating double): k recommendations per user, exploded (J6), without scoring all pairs."""
    return named_items(rec, pruned_search(rec, k, **options)).drop("position")


def normal_residuals(rec: Recommender, train: DataFrame, reg: float = ALS_REG) -> DataFrame:
    """One row per trained user: UId, n_ratings, residual.

    ALS ends with a half-step that solves, for each user with n ratings r of items with factors Q,
    (Q'Q + reg * n * I) x = Q'r.  The residual is |Q'(Qx - r) + reg * n * x| over tr(Q'Q + reg * n * I) |x| + |Q'r|: the size of the rounding of
    32-bit factors where x solves its system, whatever the system's condition.  Per rating only vectors of the
    rank's length are summed, in the map tasks first, so a user with very many ratings is no single task's work."""
    rank = rec.model.rank
    n = F.col("n_ratings")
    dot = F.aggregate(F.arrays_zip("x", "q"), F.lit(0.0), lambda s, p: s + p["x"].cast("double") * p["q"])
    rated = (rec._with_index(train)
             .join(rec.model.itemFactors.select(F.col("id").alias("_q"), F.col("features").alias("q")), "_q")
             .join(rec.model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("x")), "_u")
             .withColumn("r", F.col("rate").cast("float").cast("double")).withColumn("e", dot - F.col("r")))
    sums = rated.groupBy("UId").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.first("x").alias("x"), F.sum(inner_product.norm("q") ** 2).alias("trace"),
        F.array(*[F.sum(F.col("e") * F.col("q")[i]) for i in range(rank)]).alias("qe"),
        F.array(*[F.sum(F.col("r") * F.col("q")[i]) for i in range(rank)]).alias("qr"))
    left = F.zip_with("qe", "x", lambda a, b: a + b * reg * n)
    size = (F.col("trace") + reg * n * rank) * inner_product.norm("x") + inner_product.norm("qr")
    return sums.withColumn("left", left).select("UId", "n_ratings", (inner_product.norm("left") / size).alias("residual"))


def dot_predictions(rec: Recommender, test: DataFrame) -> DataFrame:
    """``predict`` recomputed: the inner product of the two factors, in DataFrame functions."""
    cols = test.columns
    dot = F.aggregate(F.arrays_zip("x", "q"), F.lit(0.0), lambda s, p: s + p["x"].cast("double") * p["q"])
    return (rec._with_index(test)
            .join(rec.model.itemFactors.select(F.col("id").alias("_q"), F.col("features").alias("q")), "_q")
            .join(rec.model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("x")), "_u")
            .select(*cols, dot.alias("prediction")))


def topk_per_group(df: DataFrame, group: str, order_cols, k: int = TOP_K,
                   position: str = "position") -> DataFrame:
    """First k rows per group.  A ``row_number() <= k`` filter, which Spark turns
    into a map-side WindowGroupLimit before the shuffle, so a hot group sends at
    most k rows per task, never its whole row set."""
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= k)


def preview(recs: DataFrame, n: int = 10) -> DataFrame:
    """First n rows by user, then rating desc (A6, F5): a bounded top-n."""
    return recs.orderBy(F.col("UId").asc(), F.col("Rating").desc(), F.col("QId").asc()).limit(n)


def preview_users(rec: Recommender, k: int = TOP_K, n: int = 10) -> DataFrame:
    """``preview`` of ``top_items`` without scoring everybody: every user has a recommendation, so the
    first ``n`` rows belong to the first ``n`` users."""
    first = rec.users.orderBy("UId").limit(n).select("_u")
    return preview(_named(rec, rec.model.recommendForUserSubset(first, k)), n)
