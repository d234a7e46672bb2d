"""Item-based collaborative filtering with adjusted cosine similarity.

ratings (USER_ID, PRODUCT_CODE, SCORE), one row per (user, item)
  -> co-rated pairs  (per user, every pair of items it rated)
  -> adjusted cosine (deviations from the user's mean, co-raters only)
  -> top similar items per item
  -> predicted ratings for unrated (or, for validation, rated) items
  -> top-N per user
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import types as T
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import fixed
from ..session import cut_lineage
from .often import often_met, place_code
from .ratings import dense_index
from .skew import salted_join
from .topn import ranked_top_n

# Rows of one user that go into one join block of the self-join.  A user
# with n ratings is cut into ceil(n / BLOCK_ROWS) blocks per side, so one
# task never emits more than BLOCK_ROWS^2 pairs, whatever a hot user holds.
BLOCK_ROWS = 2048
# A user of more than this many times the mean number of ratings is heavy.
HEAVY_TIMES = 4.0
# From this many co-ratings on, pairs are counted by short codes before they become rows ...
MANY_PAIRS = 2_000_000
# ... in tasks of about this many co-ratings.
TASK_PAIRS = 8_000_000


def _deviations(ratings: DataFrame, block_rows: int) -> DataFrame:
    """Rating minus the user's mean rating, plus the user's block count.

    Mean and count are map-side combined aggregates, joined back with a user's
    ratings spread over parts.  Deviations are rounded to 9 decimals so that a
    user whose ratings all equal the mean contributes exact zeros (the
    zero-denominator rule).
    """
    users = ratings.groupBy(C.USER_ID).agg(F.avg(C.SCORE).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    return salted_join(ratings, users, [C.USER_ID], [C.PRODUCT_CODE]).select(
        C.USER_ID,
        C.PRODUCT_CODE,
        F.round(F.col(C.SCORE) - F.col("_mean"), 9).alias("_d"),
        "_n",
        F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias("_blocks"),
    )


def _keyed(ratings: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Ratings with long item keys, and the table of keys (none where the ids are integers themselves)."""
    if isinstance(ratings.schema[C.PRODUCT_CODE].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        # Integer ids already are fixed-width keys: no surrogate, no mapping back.
        keyed, keys = ratings.withColumn("_k", F.col(C.PRODUCT_CODE).cast("long")), None
    else:
        keys = dense_index(ratings, C.PRODUCT_CODE, "_k")
        keyed = ratings.join(keys, C.PRODUCT_CODE)
    return keyed.select(C.USER_ID, F.col("_k").alias(C.PRODUCT_CODE), C.SCORE), keys


def _pair_sums(dev: DataFrame) -> DataFrame:
    """_i < _j with the sums over the users who hold both: cross, _isq, _jsq, n_commons.

    A user of n ratings has blocks = ceil(n / block_rows) and joins on (user, a, b): the
    left copy of a rating sits in block a = hash(i) mod blocks and is repeated
    for every b, the right copy sits in block b = hash(j) mod blocks and is
    repeated for every a, so a user's pairs spread over blocks^2 joins of about
    block_rows^2 pairs each (one join for an ordinary user).  Each pair is
    emitted once and the four sums combine map-side before the shuffle on (i, j).
    """
    home = F.pmod(F.xxhash64(C.PRODUCT_CODE), F.col("_blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    # The pair emission multiplies rows after this shuffle, so its input size
    # says nothing about the work: an explicit partition count keeps AQE from
    # coalescing it into a few tasks.
    parts = int(dev.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = [C.USER_ID, "_a", "_b"]
    left = dev.select(C.USER_ID, F.col(C.PRODUCT_CODE).alias("_i"), F.col("_d").alias("_di"), home.alias("_a"), every.alias("_b")).repartition(parts, *key)
    right = dev.select(C.USER_ID, F.col(C.PRODUCT_CODE).alias("_j"), F.col("_d").alias("_dj"), every.alias("_a"), home.alias("_b")).repartition(parts, *key)
    right = right.select(*[F.col(c).alias(f"r{c}") for c in key], "_j", "_dj")
    # i < j is part of the join condition, so rejected pairs are never built as rows.
    same = [F.col(c) == F.col(f"r{c}") for c in key]
    pairs = left.join(right, same[0] & same[1] & same[2] & (F.col("_i") < F.col("_j")))
    return _summed(pairs)


def _summed(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("_i", "_j").agg(
        F.sum(F.col("_di") * F.col("_dj")).alias("cross"),
        F.sum(F.col("_di") * F.col("_di")).alias("_isq"),
        F.sum(F.col("_dj") * F.col("_dj")).alias("_jsq"),
        F.count(F.lit(1)).alias("n_commons"),
    )


def _frequent_pair_sums(dev: DataFrame, at_least: int) -> DataFrame:
    """``_pair_sums`` of the pairs with ``at_least`` common raters, and maybe some others; ``dev`` is written.

    Where a pair of items has few common raters on average, nearly every
    co-rating would be a row of its own in the shuffle on (i, j).  There the
    co-ratings are counted first (``often.often_met``), and only those counted often
    enough become pairs.
    """
    total = dev.agg(F.sum((F.col("_n") - 1) / 2)).first()[0] or 0
    if at_least < 2 or total < MANY_PAIRS:
        return _pair_sums(dev)
    raters = dev.groupBy(C.PRODUCT_CODE).agg(F.count(F.lit(1)).alias("_raters"))
    order = dense_index(raters.select(F.struct((-F.col("_raters")).alias("_r"), F.col(C.PRODUCT_CODE).alias("_k")).alias("_o")), "_o", "_place")
    places = order.select(F.col("_o._k").alias(C.PRODUCT_CODE), "_place")
    n = places.count()
    if total >= at_least * n * (n - 1) / 2:
        return _pair_sums(dev)
    placed = cut_lineage(dev.join(places, C.PRODUCT_CODE).select(C.USER_ID, C.PRODUCT_CODE, "_d", "_place", "_blocks"), "placed")
    parts = max(int(dev.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // TASK_PAIRS))
    met = often_met(placed.select(C.USER_ID, "_place", "_blocks"), at_least, parts)
    own = placed.select(C.USER_ID, F.col("_place").alias("_i"), F.col(C.PRODUCT_CODE).alias("_k"), F.col("_d").alias("_e"))
    other = placed.select(C.USER_ID, place_code(F.col("_place")).alias("_code"), "_place", F.col(C.PRODUCT_CODE).alias("_l"), F.col("_d").alias("_f"))
    pairs = met.join(own, [C.USER_ID, "_i"]).join(other, [C.USER_ID, "_code"]).filter(F.col("_place") < F.col("_i"))
    first = F.col("_k") < F.col("_l")
    d = {"_i": F.when(first, F.col("_e")).otherwise(F.col("_f")), "_j": F.when(first, F.col("_f")).otherwise(F.col("_e"))}
    pairs = pairs.select(F.least("_k", "_l").alias("_i"), F.greatest("_k", "_l").alias("_j"), d["_i"].alias("_di"), d["_j"].alias("_dj"))
    return _summed(pairs)


def _named_pairs(sums: DataFrame, keys: DataFrame | None, ratings: DataFrame) -> DataFrame:
    """Item ids for keys, each pair with PRODUCT_CODE < j_PRODUCT_CODE."""
    if keys is None:
        item_type = ratings.schema[C.PRODUCT_CODE].dataType
        return sums.select(
            F.col("_i").cast(item_type).alias(C.PRODUCT_CODE),
            F.col("_j").cast(item_type).alias(C.J_PRODUCT_CODE),
            "cross",
            F.col("_isq").alias("i_sq"),
            F.col("_jsq").alias("j_sq"),
            "n_commons",
        )
    ki = keys.select(F.col("_k").alias("_i"), F.col(C.PRODUCT_CODE).alias("_si"))
    kj = keys.select(F.col("_k").alias("_j"), F.col(C.PRODUCT_CODE).alias("_sj"))
    named = sums.join(ki, "_i").join(kj, "_j")
    # Present each pair with PRODUCT_CODE < j_PRODUCT_CODE (id order).
    swap = F.col("_si") > F.col("_sj")
    return named.select(
        F.when(swap, F.col("_sj")).otherwise(F.col("_si")).alias(C.PRODUCT_CODE),
        F.when(swap, F.col("_si")).otherwise(F.col("_sj")).alias(C.J_PRODUCT_CODE),
        "cross",
        F.when(swap, F.col("_jsq")).otherwise(F.col("_isq")).alias("i_sq"),
        F.when(swap, F.col("_isq")).otherwise(F.col("_jsq")).alias("j_sq"),
        "n_commons",
    )


def corated_pairs(
    ratings: DataFrame,
    *,
    min_commons: int = 1,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per unordered item pair (i < j): sums over the users who rated both.

    -> PRODUCT_CODE, j_PRODUCT_CODE, cross = sum(di*dj), i_sq = sum(di^2),
       j_sq = sum(dj^2), n_commons; pairs with n_commons >= min_commons.

    Co-rated pairs are built (see ``_pair_sums``), in large sparse tables only
    those counted often enough (``_frequent_pair_sums``).  Integer item ids are
    used as they are; ids of other types are replaced by their dense index for
    the pair stage, and only pairs that reach ``min_commons`` are mapped back.
    """
    keyed, keys = _keyed(ratings)
    dev = _deviations(keyed, block_rows)
    sums = _frequent_pair_sums(cut_lineage(dev, "deviations"), min_commons) if min_commons > 1 else _pair_sums(dev)
    sums = sums.filter(F.col("n_commons") >= min_commons)
    return _named_pairs(sums, keys, ratings)


def split_raters(keyed: DataFrame, *, heavy: float, min_commons: int, at_least: int, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The ratings of items with ``min_commons`` raters or more, parted in head and tail, and the items' spare squares; both written.

    Users are ordered by the number of their ratings, then by id.  An item's
    tail is its last raters in that order, ``min_commons - at_least`` at most
    and only users of more than ``heavy`` ratings; the rest is its head.  The
    ratings get the deviation ``_d`` and ``_head``.  An item's ``_spare`` bounds
    what its tail, and as many others, add to its sum of squares.
    """
    k = min_commons - at_least
    users = keyed.groupBy(C.USER_ID).agg(F.avg(C.SCORE).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    dev = cut_lineage(
        salted_join(keyed, users, [C.USER_ID], [C.PRODUCT_CODE]).select(
            C.USER_ID, C.PRODUCT_CODE, F.round(F.col(C.SCORE) - F.col("_mean"), 9).alias("_d"), "_n", F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias("_blocks")
        ),
        "deviations",
    )
    place = F.struct("_n", C.USER_ID)
    order = Window.partitionBy(C.PRODUCT_CODE).orderBy(F.desc("_n"), F.desc(C.USER_ID))
    last = dev.filter(F.col("_n") > heavy).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    tails = last.groupBy(C.PRODUCT_CODE).agg(F.min(place).alias("_cut"), F.sum(F.col("_d") * F.col("_d")).alias("_tail"))
    raters = dev.groupBy(C.PRODUCT_CODE).agg(F.count(F.lit(1)).alias("_raters"), F.max(F.col("_d") * F.col("_d")).alias("_most")).filter(F.col("_raters") >= min_commons)
    spare = F.coalesce("_tail", F.lit(0.0)) + k * F.col("_most")
    known = cut_lineage(raters.join(tails, C.PRODUCT_CODE, "left").select(C.PRODUCT_CODE, "_cut", spare.alias("_spare")), "item-tails")
    parted = salted_join(dev, known, [C.PRODUCT_CODE], [C.USER_ID])
    head = F.col("_cut").isNull() | (place < F.col("_cut"))
    return cut_lineage(parted.select(C.USER_ID, C.PRODUCT_CODE, "_d", "_n", "_blocks", head.alias("_head")), "raters"), known.select(C.PRODUCT_CODE, "_spare")


def similar_pairs(
    ratings: DataFrame, *, min_commons: int, min_sim: float | None = None, at_least: int = 2, heavy_times: float = HEAVY_TIMES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The pairs of ``corated_pairs`` with ``min_commons`` common raters, fewer pairs built on the way.

    Let i's head (see ``split_raters``) end before j's.  Common raters beyond
    the end of i's head are in i's tail, ``min_commons - at_least`` at most; all
    others are in both heads.  So a pair with enough common raters shares
    ``at_least`` in the heads, and only heads meet: the most active raters of
    an item, whose pairs are the most, build none with it.  Pairs that share
    enough take the rest of their sums from the tails, a few rows each.

    With ``min_sim`` (above 0) a pair is dropped before that when no rest can
    lift it: with s and sums of squares I, J over the heads and at most A, B
    more, Cauchy-Schwarz gives at most (s + t) / (1 + t), t = sqrt(AB / IJ).
    Pairs below ``min_sim`` may still come out.

    Only users of more than ``heavy_times`` the mean number of ratings go into
    tails.  Where nobody has, all pairs are built at once: without heavy users
    the parting costs more than the pairs it saves.
    """
    at_least = min(at_least, min_commons)
    ratings = cut_lineage(ratings.select(C.USER_ID, C.PRODUCT_CODE, C.SCORE), "ratings")  # read by every step
    counts = ratings.groupBy(C.USER_ID).agg(F.count(F.lit(1)).alias("n")).agg(F.avg("n").alias("mean"), F.max("n").alias("most")).first()
    if at_least == min_commons or counts.most is None or counts.most <= heavy_times * counts.mean:
        return corated_pairs(ratings, min_commons=min_commons, block_rows=block_rows)
    keyed, keys = _keyed(ratings)
    parted, spare = split_raters(keyed, heavy=heavy_times * counts.mean, min_commons=min_commons, at_least=at_least, block_rows=block_rows)
    near = _frequent_pair_sums(parted.filter("_head"), at_least).filter(F.col("n_commons") >= at_least)
    if min_sim is not None and min_sim > 0:
        near = near.join(spare.select(F.col(C.PRODUCT_CODE).alias("_i"), F.col("_spare").alias("_a")), "_i").join(
            spare.select(F.col(C.PRODUCT_CODE).alias("_j"), F.col("_spare").alias("_b")), "_j"
        )
        squares = F.col("_isq") * F.col("_jsq")
        t = F.sqrt(F.col("_a") * F.col("_b") / squares)
        near = near.filter((squares == 0) | ((F.col("cross") / F.sqrt(squares) + t) / (1 + t) >= min_sim - 1e-9)).drop("_a", "_b")
    near = cut_lineage(near, "near-pairs")
    tail = parted.filter("not _head").select(F.col(C.PRODUCT_CODE).alias("_t"), C.USER_ID, F.col("_d").alias("_dt"))
    pair = near.select("_i", "_j")
    # a common rater in i's tail (wherever in j), or in j's tail and i's head
    asked = pair.join(tail.withColumnRenamed("_t", "_i"), "_i").select("_i", "_j", C.USER_ID, "_dt", F.col("_j").alias(C.PRODUCT_CODE), F.lit(True).alias("_first"))
    asked = asked.unionByName(pair.join(tail.withColumnRenamed("_t", "_j"), "_j").select("_i", "_j", C.USER_ID, "_dt", F.col("_i").alias(C.PRODUCT_CODE), F.lit(False).alias("_first")))
    both = asked.join(parted.select(C.USER_ID, C.PRODUCT_CODE, "_d", "_head"), [C.USER_ID, C.PRODUCT_CODE]).filter(F.col("_first") | F.col("_head"))
    own, other = F.col("_dt") * F.col("_dt"), F.col("_d") * F.col("_d")
    rest = both.select(
        "_i",
        "_j",
        (F.col("_dt") * F.col("_d")).alias("cross"),
        F.when(F.col("_first"), own).otherwise(other).alias("_isq"),
        F.when(F.col("_first"), other).otherwise(own).alias("_jsq"),
        F.lit(1).cast("long").alias("n_commons"),
    )
    names = ["cross", "_isq", "_jsq", "n_commons"]
    sums = near.select("_i", "_j", *names).unionByName(rest).groupBy("_i", "_j").agg(*[F.sum(c).alias(c) for c in names])
    return _named_pairs(sums.filter(F.col("n_commons") >= min_commons), keys, ratings)


def adjusted_cosine(ratings: DataFrame, *, min_commons: int = 5, min_sim: float | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Directed similarities (both i->j and j->i) for pairs with enough co-raters.

    With ``min_sim`` above 0, pairs that cannot reach it may be left out early;
    those that come out still have to be filtered (``top_similar_items``).

    sim = sum(di*dj) / (sqrt(sum di^2) * sqrt(sum dj^2)), 0 when either sum is
    0; rounded to 12 decimals, below anything a threshold or ranking should see.  Mirroring
    happens after aggregation and filtering, so only half the pairs shuffle.
    """
    pairs = similar_pairs(ratings, min_commons=min_commons, min_sim=min_sim, block_rows=block_rows)
    denom = F.sqrt("i_sq") * F.sqrt("j_sq")
    sim = fixed(F.when((F.col("i_sq") * F.col("j_sq")) == 0, F.lit(0.0)).otherwise(F.col("cross") / denom), 12)
    both = F.array(
        F.struct(F.col(C.PRODUCT_CODE).alias("a"), F.col(C.J_PRODUCT_CODE).alias("b")),
        F.struct(F.col(C.J_PRODUCT_CODE).alias("a"), F.col(C.PRODUCT_CODE).alias("b")),
    )
    directed = pairs.select(F.explode(both).alias("_p"), sim.alias(C.SIMILARITY))
    return directed.select(F.col("_p.a").alias(C.PRODUCT_CODE), F.col("_p.b").alias(C.J_PRODUCT_CODE), C.SIMILARITY)


def top_similar_items(sims: DataFrame, *, min_sim: float = 0.7, top_sim: int = 20) -> DataFrame:
    """Keep sim >= min_sim, then the top_sim most similar j per item i (sim desc, j asc)."""
    kept = sims.filter(F.col(C.SIMILARITY) >= min_sim)
    return ranked_top_n(kept, by=C.PRODUCT_CODE, score=C.SIMILARITY, tie=C.J_PRODUCT_CODE, n=top_sim).drop(C.RANK)


def predict_ratings(
    ratings: DataFrame,
    top_sims: DataFrame,
    *,
    min_rating: float = 2,
    unrated: bool = True,
) -> DataFrame:
    """Weighted-sum prediction for (user, j) from the user's ratings of items similar to j.

    ``unrated`` keeps pairs the user has not rated (recommendation); otherwise
    only rated pairs (validation).  See ``weighted_predictions``.
    """
    known = F.col(C.SCORE).isNull() if unrated else F.col(C.SCORE).isNotNull()
    return weighted_predictions(ratings, top_sims, min_rating=min_rating).filter(known).drop(C.SCORE)


def weighted_predictions(ratings: DataFrame, top_sims: DataFrame, *, min_rating: float = 2) -> DataFrame:
    """Weighted-sum prediction of every (user, j) that some seed reaches, and the user's own SCORE of j (null if unrated).

    Seeds are ratings >= min_rating; each seed fans out to at most top_sim
    neighbours.  prediction = sum(r * sim) / sum(|sim|), -1 when the
    denominator is 0, rounded to 12 decimals.  The (user, j) sums combine
    map-side before the one join with the ratings.
    """
    seeds = ratings.filter(F.col(C.SCORE) >= min_rating).select(C.USER_ID, C.PRODUCT_CODE, C.SCORE)
    contrib = seeds.join(top_sims, C.PRODUCT_CODE).select(
        C.USER_ID,
        F.col(C.J_PRODUCT_CODE).alias("_j"),
        (F.col(C.SCORE) * F.col(C.SIMILARITY)).alias("_num"),
        F.abs(F.col(C.SIMILARITY)).alias("_den"),
    )
    sums = contrib.groupBy(C.USER_ID, "_j").agg(F.sum("_num").alias("_num"), F.sum("_den").alias("_den"))
    rated = ratings.select(C.USER_ID, F.col(C.PRODUCT_CODE).alias("_j"), C.SCORE)
    pred = fixed(F.when(F.col("_den") == 0, F.lit(-1.0)).otherwise(F.col("_num") / F.col("_den")), 12)
    return sums.join(rated, [C.USER_ID, "_j"], "left").select(C.USER_ID, F.col("_j").alias(C.PRODUCT_CODE), pred.alias(C.PREDICTION), C.SCORE)


def cosine_recommendations(predictions: DataFrame, *, min_rating: float = 2, top_n: int = 10) -> DataFrame:
    """Top-N predicted items per user among predictions >= min_rating."""
    kept = predictions.filter(F.col(C.PREDICTION) >= min_rating)
    return ranked_top_n(kept, by=C.USER_ID, score=C.PREDICTION, tie=C.PRODUCT_CODE, n=top_n)
