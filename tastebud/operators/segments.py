"""User segments: k-means clustering of users, and per-segment top-N items."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import fixed
from .skew import salted_join
from .topn import ranked_top_n

# Parts of one segment's members.
SEGMENT_SALTS = 32


def cluster_users(vectors: DataFrame, *, k: int, max_iter: int = 10, seed: int = 42) -> tuple[KMeansModel, DataFrame]:
    """K-means on user rating vectors (label, features) -> (model, label + prediction).

    The within-set sum of squared errors is ``model.summary.trainingCost``.
    """
    model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features").fit(vectors)
    return model, model.transform(vectors).select("label", C.PREDICTION)


def model_centres(model: KMeansModel, items: DataFrame, *, index: str = "i") -> DataFrame:
    """The fitted centres as rows: prediction, PRODUCT_CODE, value (zeros left out).

    ``items`` is PRODUCT_CODE with its vector position ``index``.  The model
    holds its k centres on the driver; they go out as k rows.
    """
    packed = items.sparkSession.createDataFrame([(c, [float(x) for x in v]) for c, v in enumerate(model.clusterCenters())], "prediction int, v array<double>")
    cells = packed.select(C.PREDICTION, F.posexplode("v").alias("_at", "value")).filter("value <> 0")
    return cells.join(items.select(C.PRODUCT_CODE, F.col(index).alias("_at")), "_at").select(C.PREDICTION, C.PRODUCT_CODE, "value")


def mean_centres(scores: DataFrame, assignments: DataFrame) -> DataFrame:
    """Centre of each segment, the mean of its members' vectors: prediction, PRODUCT_CODE, value.

    Members without a score have a zero vector and count too.
    """
    sizes = assignments.groupBy(C.PREDICTION).agg(F.count(F.lit(1)).alias("_n"))
    sums = segment_item_scores(scores, assignments)
    return salted_join(sums, sizes, [C.PREDICTION], [C.PRODUCT_CODE]).select(
        C.PREDICTION, C.PRODUCT_CODE, fixed(F.col(C.SCORE_SUM) / F.col("_n"), 9).alias("value")
    )


def assign_to_centres(scores: DataFrame, centres: DataFrame, *, k: int) -> DataFrame:
    """Nearest of ``k`` given centres for every user of ``scores``: USER_ID, prediction, distance.

    ``distance`` is squared, |u|^2 + |c|^2 - 2 u.c, of which only the products
    need rows: a score meets its item's values in all centres (one row an item,
    repeated per part, so a hot item is spread), and a user's k sums combine
    map-side.  A centre that shares no item with a user is |u|^2 + |c|^2 away;
    an item in no centre adds to |u|^2 alone.  Ties go to the smallest number;
    null scores count as 0.  The k norms are all that the driver sees.
    """
    norms = dict.fromkeys(range(k), 0.0)
    for r in centres.groupBy(C.PREDICTION).agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect():
        norms[r[C.PREDICTION]] = r["n"]
    value = lambda c: F.coalesce(F.sum(F.when(F.col(C.PREDICTION) == c, F.col("value"))), F.lit(0.0))
    by_item = centres.groupBy(C.PRODUCT_CODE).agg(F.array(*[value(c) for c in range(k)]).alias("_values"))
    rows = scores.select(C.USER_ID, C.PRODUCT_CODE, F.coalesce(F.col(C.SCORE), F.lit(0.0)).alias("_s"))
    met = salted_join(rows, by_item, [C.PRODUCT_CODE], [C.USER_ID], "left")
    product = lambda c: F.sum(F.col("_s") * F.coalesce(F.get("_values", F.lit(c)), F.lit(0.0)))
    sums = met.groupBy(C.USER_ID).agg(F.sum(F.col("_s") * F.col("_s")).alias("_u"), *[product(c).alias(f"_d{c}") for c in range(k)])
    away = [F.struct(F.greatest(F.lit(0.0), fixed(F.col("_u") + norms[c] - 2 * F.col(f"_d{c}"), 9)).alias("distance"), F.lit(c).alias(C.PREDICTION)) for c in range(k)]
    return sums.select(C.USER_ID, F.array_min(F.array(*away)).alias("_best")).select(C.USER_ID, f"_best.{C.PREDICTION}", "_best.distance")


def within_cluster_sums(assigned: DataFrame) -> DataFrame:
    """Per centre: prediction, n_members, within (sum of squared distances); their total is the WSSSE."""
    return assigned.groupBy(C.PREDICTION).agg(F.count(F.lit(1)).alias("n_members"), fixed(F.sum("distance"), 6).alias("within"))


def segment_item_scores(scores: DataFrame, assignments: DataFrame, *, segment: str = C.PREDICTION) -> DataFrame:
    """Sum of member scores per (segment, item) -> segment, PRODUCT_CODE, score_sum.

    ``assignments`` maps USER_ID -> segment.  Sums combine map-side; the sum
    is rounded to 12 decimals, which takes away the noise of the summation
    order and nothing that "> 0" or the ranking should see.
    """
    joined = scores.select(C.USER_ID, C.PRODUCT_CODE, C.SCORE).join(assignments.select(C.USER_ID, segment), C.USER_ID)
    sums = joined.groupBy(segment, C.PRODUCT_CODE).agg(F.sum(C.SCORE).alias(C.SCORE_SUM))
    return sums.select(segment, C.PRODUCT_CODE, fixed(C.SCORE_SUM, 12).alias(C.SCORE_SUM))


def segment_topn(segment_scores: DataFrame, *, top_n: int = 10, segment: str = C.PREDICTION) -> DataFrame:
    """Top-N items per segment among score_sum > 0 (score_sum desc, item asc)."""
    kept = segment_scores.filter(F.col(C.SCORE_SUM) > 0)
    return ranked_top_n(kept, by=segment, score=C.SCORE_SUM, tie=C.PRODUCT_CODE, n=top_n)


def segment_recommendations(
    assignments: DataFrame,
    topn: DataFrame,
    *,
    segment: str = C.PREDICTION,
    exclude_seen: DataFrame | None = None,
    bounded_topn: bool = False,
) -> DataFrame:
    """Give every member its segment's top-N -> USER_ID, PRODUCT_CODE, RANK.

    As in the reference, items the user already has are kept unless
    ``exclude_seen`` (a USER_ID, PRODUCT_CODE frame) is given.  With
    ``bounded_topn`` (k segments x N rows, e.g. after k-means) the top-N side
    is broadcast; otherwise a segment's members are spread over parts.
    """
    side = topn.select(segment, C.PRODUCT_CODE, C.RANK)
    members = assignments.select(C.USER_ID, segment)
    if bounded_topn:
        recs = members.join(F.broadcast(side), segment)
    else:
        # few segments hold all users: members are spread, the top-N rows repeated
        recs = salted_join(members, side, [segment], [C.USER_ID], salts=SEGMENT_SALTS)
    recs = recs.select(C.USER_ID, C.PRODUCT_CODE, C.RANK)
    if exclude_seen is not None:
        recs = recs.join(exclude_seen.select(C.USER_ID, C.PRODUCT_CODE), [C.USER_ID, C.PRODUCT_CODE], "left_anti")
    return recs
