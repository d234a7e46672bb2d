"""Mixing sources to target weights along a low-discrepancy schedule.

1. Every source's documents are shuffled by a hash of the id, laid end to end
   and cut into blocks of ``block`` words (the last one may be shorter).
2. Slot n of the schedule draws the point frac((n + 1) / golden ratio); the
   source whose interval of the cumulative weights holds the point gets the
   slot.  These points leave each interval within a few slots of its share in
   every prefix, so the mix is even all along.
3. The slots of a source are ranked; rank r takes block r mod n_blocks in
   pass r div n_blocks.  The first slots that reach the source's target count,
   the last of them only as far as the target.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.running import running_totals
from tastebud.llm.scratch import written

MAX_PASSES = 3
CELLS = 512  # cells that a source's shuffled documents are cut into
_CHUNK = 1 << 14  # slots ranked together
_WORD = r"[^\x20\x09-\x0D]+"


def target_words(sizes: list[int], weights: list[float], max_passes: int = MAX_PASSES) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``max_passes`` times its size, the excess reshared by weight."""
    total, left = float(sum(sizes)), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while left:
        weight = math.fsum(weights[i] for i in left)
        share = {i: total * weights[i] / weight for i in left}
        full = [i for i in left if share[i] > max_passes * sizes[i]]
        if not full:
            for i in left:
                out[i] = share[i]
            return out
        for i in full:
            out[i] = float(max_passes * sizes[i])
            total -= out[i]
        left = [i for i in left if i not in set(full)]
    return out


def source_targets(docs: DataFrame, weights: dict | None = None) -> list[dict]:
    """One entry per source: its words and target.  Sources go by code point, null last, and weigh 1, 2, 3, repeating unless ``weights`` says.

    The list of sources is the mix's own recipe and is held on the driver: one
    row a source, no row of a document.
    """
    found = docs.groupBy("source").agg(F.sum("size").alias("words")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    weigh = [float(i % 3 + 1) if weights is None else float(weights.get(r["source"], 0.0)) for i, r in enumerate(found)]
    goals = target_words([r["words"] for r in found], weigh)
    return [{"source": r["source"], "no": i, "weight": w, "words": int(r["words"]), "target": t} for i, (r, w, t) in enumerate(zip(found, weigh, goals))]


def slots_needed(words: int, target: float, block: int) -> tuple[int, int]:
    """Slots until a source's target is met, and the words that the last of them takes."""
    goal = min(math.floor(target + 0.5), MAX_PASSES * words)
    if words <= 0 or goal <= 0:
        return 0, 0
    blocks = -(-words // block)
    passes, rest = divmod(goal, words)
    if rest == 0:
        return passes * blocks, words - (blocks - 1) * block
    in_pass = -(-rest // block)
    return passes * blocks + in_pass, rest - (in_pass - 1) * block


def schedule(spark, sources: list[dict], block: int) -> DataFrame:
    """``(no, slot, pass, block, take)``: the slots that the mix uses, in order of ``slot``.

    ``no`` is the source's number, ``take`` the words that the slot takes from
    the front of the block (blocks shorter than that give what they have).
    """
    need = {s["no"]: slots_needed(s["words"], s["target"], block) for s in sources}
    used = [s for s in sources if need[s["no"]][0] > 0]
    slots = sum(need[s["no"]][0] for s in used)
    if not used:
        return spark.createDataFrame([], "no int, slot long, pass long, block long, take long")
    # the interval of a source is as long as its share of the slots; the surplus below covers the points' discrepancy
    slack = 2 * (3 + math.log(slots + 1) / math.log((1 + 5**0.5) / 2))
    points = math.ceil(max((need[s["no"]][0] + slack) * slots / need[s["no"]][0] for s in used))
    edge, no = 0, None
    u = F.pmod((F.col("slot") + 1) * F.lit((5**0.5 - 1) / 2), F.lit(1.0))
    for s in used:
        edge += need[s["no"]][0]
        pick = F.lit(s["no"])
        no = F.when(u < edge / slots, pick) if no is None else no.when(u < edge / slots, pick)
    no = no.otherwise(F.lit(used[-1]["no"]))
    drawn = spark.range(points).withColumnRenamed("id", "slot").select("slot", no.alias("no"), F.floor(F.col("slot") / _CHUNK).alias("chunk"))
    ranked = running_totals(drawn.withColumn("one", F.lit(1)), ["no"], [F.col("chunk")], [F.col("slot")], "one")
    recipe = spark.createDataFrame(
        [(s["no"], need[s["no"]][0], need[s["no"]][1], -(-s["words"] // block)) for s in used], "no int, slots long, last_take long, n_blocks long"
    )
    # one row a source: the recipe itself, already on the driver
    return (
        ranked.join(F.broadcast(recipe), "no")
        .filter("rank < slots")
        .select(
            "no",
            "slot",
            F.floor(F.col("rank") / F.col("n_blocks")).alias("pass"),
            F.pmod("rank", "n_blocks").alias("block"),
            F.when(F.col("rank") == F.col("slots") - 1, F.col("last_take")).otherwise(F.lit(block)).cast("long").alias("take"),
        )
    )


def mix(docs: DataFrame, weights: dict | None = None, block: int = 256, seed: str = "mix", keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Mix all rows of ``docs`` (doc_id, text, source).

    Returns ``documents`` (doc_id, source, row, size, source_size, target, taken and
    the columns ``keep``: one row per input row), ``pieces`` (row, no, block, words, at: a row's words in its
    source's blocks) and ``schedule`` (see above); joining the last two on (no,
    block) and ordering by slot gives the mixed stream.

    A null text or one without words has size 0 and is taken 0 times; a null
    source is a source of its own; repeated rows count each on its own; an
    empty table gives empty results.  Columns other than these and ``keep`` are not read.
    """
    spark = docs.sparkSession
    sized = written(
        docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"), *keep)
        .withColumn("row", F.monotonically_increasing_id()),
        "sized",
    )
    sources = source_targets(sized, weights)
    table = spark.createDataFrame([(s["source"], s["no"], s["words"], s["target"]) for s in sources], "source string, no int, source_size long, target double")
    # one row a source, collected above
    numbered = sized.join(F.broadcast(table), sized.source.eqNullSafe(table.source)).drop(table.source)
    laid = written(
        running_totals(numbered, ["no"], [F.pmod(F.conv(F.substring("key", 1, 6), 16, 10).cast("long"), F.lit(CELLS))], [F.col("key"), F.col("doc_id"), F.col("row")], "size"),
        "laid",
    )
    first, last = F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("size") - 1) / block)
    pieces = (
        laid.filter("size > 0")
        .select("row", "no", "before", "size", F.explode(F.sequence(first, last)).alias("block"))
        .select(
            "row",
            "no",
            "block",
            (F.greatest(F.col("before"), F.col("block") * block) - F.col("block") * block).alias("at"),
            (F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(F.col("before"), F.col("block") * block)).alias("words"),
        )
    )
    slots = written(schedule(spark, sources, block), "slots")
    # what a block gives over all its slots: per number of words taken from its front, how often
    takes = slots.groupBy("no", "block", "take").agg(F.count(F.lit(1)).alias("times"))
    taken = (
        pieces.join(takes, ["no", "block"])
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.greatest(F.lit(0), F.least(F.col("words"), F.col("take") - F.col("at")))).alias("taken"))
    )
    documents = laid.join(taken, "row", "left").select("doc_id", "source", "row", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *keep)
    return {"documents": documents, "pieces": pieces, "schedule": slots}
