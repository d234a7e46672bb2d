"""Resharding with the fewest bytes moved: a minimum-cost flow between shards.

Old shards supply their bytes, new shards take their capacity; keeping bytes
in the shard they are in costs nothing, moving them costs one a byte (or what
``cost`` says).  The flow is solved over shard totals alone (old times new
numbers on the driver, however many rows there are).  Each old shard's rows
stand in a fixed order, large blocks first, and the flow cuts that line into
consecutive pieces, one for each destination; a row goes where the middle of
its bytes falls.  Only shards that lose or gain a piece are rewritten.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.running import running_totals
from tastebud.llm.scratch import written

CELLS = 64  # hash cells of one size class of one old shard
ROW_BYTES = 8


def min_cost_flow(supply: list[int], capacity: list[int], cost: Callable[[int, int], int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, all supply placed at the least cost.

    Successive shortest paths with potentials on the bipartite graph of shards.
    ``sum(capacity)`` must be at least ``sum(supply)``.
    """
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards hold less than the old ones")
    m, n = len(supply), len(capacity)
    flow: dict[tuple[int, int], int] = {}
    room = list(capacity)
    potential = [0] * (m + n)
    price = [[cost(i, j) for j in range(n)] for i in range(m)]
    for i in range(m):
        left = supply[i]
        while left:
            dist, come = [None] * (m + n), [None] * (m + n)
            dist[i], heap = 0, [(0, i)]
            while heap:
                d, v = heapq.heappop(heap)
                if d > dist[v]:
                    continue
                if v < m:
                    steps = [(m + j, price[v][j]) for j in range(n)]
                else:
                    steps = [(k, -price[k][v - m]) for k in range(m) if flow.get((k, v - m), 0)]
                for w, c in steps:
                    e = d + c + potential[v] - potential[w]
                    if dist[w] is None or e < dist[w]:
                        dist[w], come[w] = e, v
                        heapq.heappush(heap, (e, w))
            far = max(d for d in dist if d is not None)
            end = min((m + j for j in range(n) if room[j] and dist[m + j] is not None), key=lambda v: (dist[v] + potential[v], v))
            potential = [p + (far if d is None else d) for p, d in zip(potential, dist)]
            path, v = [], end
            while come[v] is not None:
                path.append((come[v], v))
                v = come[v]
            push = min([left, room[end - m], *(flow[(w, v - m)] for v, w in path if v >= m)])
            for v, w in path:
                if v < m:
                    flow[(v, w - m)] = flow.get((v, w - m), 0) + push
                else:
                    flow[(w, v - m)] -= push
            room[end - m] -= push
            left -= push
    return {k: f for k, f in flow.items() if f}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def plan_moves(supply: dict[int, int], capacity: list[int], cost: Callable[[int, int], int] | None = None) -> list[tuple[int, int, int, int]]:
    """``(old, new, start, end)``: byte ranges of each old shard's line and where they go.

    What stays comes first on the line, the rest by new shard.
    """
    old = sorted(supply)
    price = cost or (lambda i, j: int(i != j))
    flow = min_cost_flow([supply[o] for o in old], capacity, lambda i, j: price(old[i], j))
    pieces, at = [], dict.fromkeys(old, 0)
    for i, j in sorted(flow, key=lambda k: (k[0], old[k[0]] != k[1], k[1])):
        start = at[old[i]]
        at[old[i]] = start + flow[(i, j)]
        pieces.append((old[i], j, start, at[old[i]]))
    return pieces


def reshard(rows: DataFrame, shards: int, capacity: list[int] | None = None, cost: Callable[[int, int], int] | None = None) -> DataFrame:
    """Place every row of ``rows`` (row, old_shard, size, key, ...) into new shards.

    Adds ``shard`` and ``slot`` (gapless from 0 in each new shard).  ``row``
    must be unique, ``old_shard`` a non-null int, ``size`` a positive long;
    rows of equal size and key are told apart by ``row``.  Rows keep their
    other columns.  Capacities default to equal parts of all bytes.
    """
    spark = rows.sparkSession
    rows = written(rows, "rows")
    totals = {r["old_shard"]: int(r["bytes"]) for r in rows.groupBy("old_shard").agg(F.sum("size").alias("bytes")).collect()}
    pieces = plan_moves(totals, capacity or equal_capacities(sum(totals.values()), shards), cost)
    by_old: dict[int, list] = {}
    for old, new, start, end in pieces:
        by_old.setdefault(old, []).append((new, end))
    # the order of an old shard's line: size classes downwards, hash cells, then the key
    size_class = (-F.floor(F.log2(F.col("size").cast("double")) * 4)).cast("int")
    line = running_totals(rows, ["old_shard"], [size_class, F.pmod(F.xxhash64("key"), F.lit(CELLS)).cast("int")], [F.desc("size"), F.col("key"), F.col("row")], "size")
    middle = F.col("before") * 2 + F.col("size")
    shard = F.lit(None).cast("int")
    for old, parts in sorted(by_old.items()):
        to = F.lit(parts[-1][0])
        for new, end in reversed(parts[:-1]):
            to = F.when(middle < 2 * end, F.lit(new)).otherwise(to)
        shard = F.when(F.col("old_shard") == old, to).otherwise(shard)
    placed = written(line.withColumn("shard", shard.cast("int")), "placed")
    # pieces are consecutive on their line, so a row's slot is its place in the piece after all earlier pieces of its new shard
    counts = placed.groupBy("old_shard", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first")).collect()
    base, at = [], {}
    for r in sorted(counts, key=lambda r: (r["shard"], r["old_shard"])):
        base.append((r["old_shard"], r["shard"], at.get(r["shard"], 0) - r["first"]))
        at[r["shard"]] = at.get(r["shard"], 0) + r["n"]
    # at most old shards times new shards rows
    shift = spark.createDataFrame(base, "old_shard int, shard int, shift long")
    return placed.join(F.broadcast(shift), ["old_shard", "shard"]).withColumn("slot", F.col("rank") + F.col("shift")).drop("before", "rank", "shift")


def document_rows(docs: DataFrame, old_shards: int) -> DataFrame:
    """``(row, doc_id, size, text_crc32, key, old_shard)`` of documents whose present layout keeps each source together.

    Size is the text's UTF-8 bytes plus 8; a null text has none and crc32 0 (as the empty text).
    """
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    home = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")), F.lit(old_shards)).cast("int")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"),
        home.alias("old_shard"),
    )


def rewrite_affected(old_path: str, new_path: str, moves: DataFrame, spark, shards: int) -> list[int]:
    """Write the shards of ``new_path`` whose rows change; returns their numbers.

    ``old_path`` holds rows with columns ``shard`` and ``row`` partitioned by
    ``shard``; ``moves`` is ``reshard``'s result.  A shard is affected when it
    loses or gains a row; the others' files stay as they are and are not read.
    """
    touched = moves.filter("old_shard <> shard").select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct()
    numbers = sorted(r["s"] for r in touched.collect())  # at most old plus new shards
    gain = [n for n in numbers if n < shards]
    if gain:
        to = moves.filter(F.col("shard").isin(gain)).select("row", F.col("shard").alias("_new"), "slot")
        content = spark.read.parquet(old_path).filter(F.col("shard").isin(numbers)).drop("shard").join(to, "row")
        # one file a shard and hash part, so that no task writes a whole shard
        content.repartition(F.col("_new"), F.pmod(F.xxhash64("row"), F.lit(8))).withColumnRenamed("_new", "shard").write.partitionBy("shard").mode("append").parquet(new_path)
    return numbers
