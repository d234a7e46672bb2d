"""Frequent itemsets, association rules and rule-based recommendations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import columns as C
from ..functions import present
from ..session import cut_lineage
from .topn import ranked_top_n

#: Pairs of frequent items that are counted before mining.
MAX_PAIRS = 2_000_000


@dataclass(frozen=True)
class Itemsets:
    """Mined sets and rules, as ``FPGrowthModel`` has them; ``mined`` is the library's model."""

    mined: FPGrowthModel
    freqItemsets: DataFrame

    @property
    def associationRules(self) -> DataFrame:
        return self.mined.associationRules


def _frequent_pairs(often: DataFrame, baskets: DataFrame, items_col: str, least: int) -> DataFrame:
    """(a, b) of all pairs of ``often`` items that share ``least`` baskets or more, every pair one way round.

    Items and then pairs are met inside the row by two broadcast joins, so what
    is shuffled are the counts of the pairs alone, one a task and pair.
    """
    at = F.broadcast(often.select(F.col("_item").alias("_a")))
    beside = F.broadcast(often.select(F.col("_item").alias("_b")))
    firsts = baskets.select(F.col(items_col).alias("_all"), F.posexplode(items_col).alias("_at", "_a")).join(at, "_a")
    rest = F.slice("_all", F.col("_at") + 2, F.size("_all"))
    pairs = firsts.select("_a", F.explode(rest).alias("_b")).join(beside, "_b")
    ordered = pairs.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    return ordered.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select("a", "b")


def fit_itemsets(
    baskets: DataFrame,
    *,
    min_support: float,
    min_confidence: float,
    items_col: str = "ITEMS",
    num_partitions: int | None = None,
) -> Itemsets:
    """Parallel FP-growth on baskets (unique items per basket).

    The support threshold is ceil(min_support * baskets); ``num_partitions``
    sets how many groups the conditional trees are split into.  Trees are
    built from the items of frequent pairs alone: a larger set is frequent
    only if all its pairs are, so any other frequent item is a set by itself,
    with the count that is known already.  Where the frequent items allow more
    than ``MAX_PAIRS`` pairs, these are not counted and the baskets go to the
    library whole.

    The model's itemsets are a lazy lineage over the whole mining job; they are
    persisted (memory and disk, recomputed from lineage if an executor is lost)
    so itemsets, rules and every product derived from them mine once.
    """
    kind = baskets.schema[items_col].dataType.elementType
    known = baskets.select(items_col).filter(F.col(items_col).isNotNull())
    single = None
    if isinstance(kind, (T.StringType, T.IntegralType)):
        twice = F.raise_error(F.lit("items of a basket must be unique"))
        known = known.select(F.when(F.size(F.array_distinct(items_col)) == F.size(items_col), F.col(items_col)).otherwise(twice).alias(items_col))
        # read by the counts and by the mining
        known = cut_lineage(known, "baskets")
        least = math.ceil(min_support * known.count())
        counts = known.select(F.explode(items_col).alias("_item")).groupBy("_item").agg(F.count(F.lit(1)).alias("freq"))
        # at most a basket's size / min_support items, which FP-growth collects too
        often = cut_lineage(counts.filter(F.col("freq") >= least), "often")
        names = {r[0] for r in often.select("_item").collect()}
        if None not in names and len(names) * (len(names) - 1) // 2 <= MAX_PAIRS:
            kept = list({x for r in _frequent_pairs(often, known, items_col, least).collect() for x in r}) if len(names) > 1 else []
            single = often.filter(~F.col("_item").isin(kept)).select(F.array("_item").alias("items"), "freq")
            known = known.select((F.filter(items_col, lambda x: x.isin(kept)) if kept else F.array().cast(T.ArrayType(kind))).alias(items_col))
    fp = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    model = fp.fit(known)
    model.freqItemsets.persist(StorageLevel.MEMORY_AND_DISK)
    model.associationRules.persist(StorageLevel.MEMORY_AND_DISK)
    sets = model.freqItemsets
    return Itemsets(model, sets if single is None else sets.unionByName(single))


def release(model: Itemsets) -> None:
    """Give back what ``fit_itemsets`` keeps; itemsets and rules already written stay readable."""
    model.mined.freqItemsets.unpersist()
    model.mined.associationRules.unpersist()


def frequent_itemsets(model: Itemsets, *, max_len: int | None = None) -> DataFrame:
    """-> ITEMS (sorted array), LENGTH, FREQ; optionally only sets shorter than ``max_len``."""
    sets = model.freqItemsets.select(
        F.array_sort("items").alias("ITEMS"), F.size("items").alias("LENGTH"), F.col("freq").alias("FREQ")
    )
    if max_len is not None:
        sets = sets.filter(F.col("LENGTH") < max_len)
    return sets


def association_rules(model: Itemsets) -> DataFrame:
    """-> ANTECEDENT (sorted array), CONSEQUENT (item), CONFIDENCE, LIFT, SUPPORT."""
    return model.associationRules.select(
        F.array_sort("antecedent").alias(C.ANTECEDENT),
        F.col("consequent")[0].alias(C.CONSEQUENT),
        F.col("confidence").alias(C.CONFIDENCE),
        F.col("lift").alias("LIFT"),
        F.col("support").alias("SUPPORT"),
    )


def set_paths(sets: DataFrame, owned: DataFrame, *, set_col: str, max_size: int | None) -> DataFrame:
    """Every distinct set with its items from the rarest to the most frequent: set, ``_path``.

    An item's frequency is the number of its rows in ``owned`` (distinct user,
    item).  Sets that hold an item which nobody owns have no path, nor has the
    empty set; an item that a set repeats counts once.
    """
    chosen = sets.select(set_col).distinct()
    if max_size is not None:
        chosen = chosen.filter(F.size(set_col) <= max_size)
    members = chosen.select(set_col, F.size(F.array_distinct(set_col)).alias("_size"), F.explode(F.array_distinct(set_col)).alias(C.PRODUCT_CODE))
    often = owned.groupBy(C.PRODUCT_CODE).agg(F.count(F.lit(1)).alias("_users"))
    ordered = members.join(often, C.PRODUCT_CODE).groupBy(set_col, "_size").agg(F.sort_array(F.collect_list(F.struct("_users", C.PRODUCT_CODE))).alias("_line"))
    return ordered.filter(F.size("_line") == F.col("_size")).select(set_col, F.col("_line")[C.PRODUCT_CODE].alias("_path"))


def containment_levels(paths: DataFrame, owned: DataFrame, *, set_col: str, depth: int) -> list[DataFrame]:
    """The steps down the prefix tree of the sets' paths, one frame a level.

    Level 0 holds (user, first item) for every user who owns an item that is
    some set's rarest.  Level k takes each prefix of k items that a user owns
    one item further: to all items that follow it in some path (those that the
    user owns stay) and to the sets that end there.  A row has USER_ID and
    ``_prefix``, the items owned so far, and is ``_open`` until a set is
    complete; then it has the set.
    """
    kind, item = paths.schema[set_col].dataType, paths.schema["_path"].dataType.elementType
    node = paths.select(F.slice("_path", 1, 1).alias("_prefix"), F.col("_path")[0].alias(C.PRODUCT_CODE)).distinct()
    state = owned.join(node, C.PRODUCT_CODE).select(C.USER_ID, "_prefix", F.lit(True).alias("_open"), F.lit(None).cast(kind).alias(set_col))
    levels = [state]
    has = owned.select(C.USER_ID, F.col(C.PRODUCT_CODE).alias("_next"), F.lit(True).alias("_has"))
    for k in range(1, depth + 1):
        at, shut = F.slice("_path", 1, k).alias("_prefix"), F.lit(True).alias("_open")
        step = paths.filter(F.size("_path") == k).select(at, shut, F.lit(None).cast(item).alias("_next"), F.col(set_col).alias("_done"))
        if k < depth:
            further = paths.filter(F.size("_path") > k).select(at, shut, F.col("_path")[k].alias("_next")).distinct()
            step = step.unionByName(further.withColumn("_done", F.lit(None).cast(kind)))
        # complete sets pass both joins as they are, still spread by the prefix they came with
        met = state.join(step, ["_prefix", "_open"], "left").filter(~F.col("_open") | F.col("_next").isNotNull() | F.col("_done").isNotNull())
        if k < depth:
            met = met.join(has, [C.USER_ID, "_next"], "left").filter(F.col("_next").isNull() | F.col("_has"))
        state = met.select(
            C.USER_ID,
            F.when(F.col("_next").isNotNull(), F.concat("_prefix", F.array("_next"))).otherwise(F.col("_prefix")).alias("_prefix"),
            F.col("_next").isNotNull().alias("_open"),
            F.coalesce(set_col, "_done").alias(set_col),
        )
        levels.append(state)
    return levels


def contained_sets(sets: DataFrame, history: DataFrame, *, set_col: str = "ITEMS", max_size: int | None = 3) -> DataFrame:
    """(user, set) for every set whose items all occur in the user's history.

    Each set waits at its rarest item, and only that item's owners look at it;
    they go on along the set's items, from rare to frequent, as long as they
    own the next one, and sets with equal beginnings are followed once.  So an
    item that most users own meets only those who own the rarer items before
    it, and no user's items are collected.  Joins on prefixes meet the sets
    (AQE broadcasts them when small); joins on (user, item) spread a hot item's
    owners.  Tasks: one pass over the history a level, at most the largest
    set's items.
    """
    # the empty item is none: a set that holds it is contained by nobody
    owned = history.select(C.USER_ID, C.PRODUCT_CODE).filter(present(C.PRODUCT_CODE)).distinct()
    paths = cut_lineage(set_paths(sets, owned, set_col=set_col, max_size=max_size), "paths")
    depth = paths.agg(F.max(F.size("_path"))).first()[0] or 0
    return containment_levels(paths, owned, set_col=set_col, depth=depth)[-1].filter(F.col(set_col).isNotNull()).select(C.USER_ID, set_col)


def rule_matches(rules: DataFrame, history: DataFrame, *, max_antecedent: int | None = 3) -> DataFrame:
    """Rules (antecedent size <= max_antecedent) whose antecedent the user's history contains.

    -> USER_ID, ANTECEDENT, CONSEQUENT, CONFIDENCE.
    """
    if max_antecedent is not None:
        rules = rules.filter(F.size(C.ANTECEDENT) <= max_antecedent)
    usable = rules.select(C.ANTECEDENT, C.CONSEQUENT, C.CONFIDENCE)
    priors = contained_sets(usable, history, set_col=C.ANTECEDENT, max_size=max_antecedent)
    return priors.join(usable, C.ANTECEDENT).select(C.USER_ID, C.ANTECEDENT, C.CONSEQUENT, C.CONFIDENCE)


def rule_candidates(rules: DataFrame, history: DataFrame, *, max_antecedent: int | None = 3) -> DataFrame:
    """Best confidence per (user, consequent) over matching rules, minus items the user already has.

    -> USER_ID, PRODUCT_CODE, CONFIDENCE.
    """
    matches = rule_matches(rules, history, max_antecedent=max_antecedent)
    best = matches.groupBy(C.USER_ID, F.col(C.CONSEQUENT).alias(C.PRODUCT_CODE)).agg(F.max(C.CONFIDENCE).alias(C.CONFIDENCE))
    owned = history.select(C.USER_ID, C.PRODUCT_CODE)
    return best.join(owned, [C.USER_ID, C.PRODUCT_CODE], "left_anti")


def rule_recommendations(rules: DataFrame, history: DataFrame, *, top_n: int = 10, max_antecedent: int | None = 3) -> DataFrame:
    """Top-N new items per user by best rule confidence (desc), item (asc).

    -> USER_ID, PRODUCT_CODE, CONFIDENCE, RANK.
    """
    fresh = rule_candidates(rules, history, max_antecedent=max_antecedent)
    return ranked_top_n(fresh, by=C.USER_ID, score=C.CONFIDENCE, tie=C.PRODUCT_CODE, n=top_n)
