"""Benchmark decontamination: prefix-filtered set join of item windows against documents.

Native: DataFrame and SQL expressions only.

A window is ``width`` consecutive words of an item (an item of fewer words is
one window), seen as its set of shingles of three words with their places.
One pass over the documents finds where shingles of items occur and counts
them.  Containment of a whole set needs a prefix of one shingle: each window
takes its rarest.  Where that occurs, the window's place in the document
follows; it must fit into the document (length and positional bounds), and
every word of it is then verified through the shingles that cover it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastebud.llm.scratch import written
from tastebud.llm.urls import bloom_blocks, filter_blocks, lower_ascii, probe

SHINGLE = 3
#: Benchmark shingles that are broadcast at most; beyond it a blocked Bloom filter of
#: them is, and the shingles that pass it are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: What parts words: ASCII other than letters and digits.  Fixed value.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), _GAP), "")


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``(win, m, q, item_id)``: distinct windows as their words joined by spaces, their words and shingle size."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    m = F.least(F.size("w"), F.lit(width))
    cut = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1), lambda i: F.array_join(F.slice("w", i, F.col("m")), " "))
    return (
        w.withColumn("m", m)
        .select("item_id", "m", F.explode(cut).alias("win"))
        .select(F.col("item_id").cast("string").alias("item_id"), "m", "win", F.least("m", F.lit(SHINGLE)).alias("q"))
        .distinct()
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """``(win, m, q, at, gram)``: the shingles of each distinct window and their places in it."""
    one = windows.select("win", "m", "q").distinct().withColumn("w", F.split("win", " "))
    grams = F.transform(F.sequence(F.lit(0), F.col("m") - F.col("q")), lambda i: F.array_join(F.slice("w", i + 1, F.col("q")), " "))
    return one.select("win", "m", "q", F.posexplode(grams).alias("at", "gram"))


def occurrences(docs: DataFrame, grams: DataFrame, sizes: list[int], n_grams: int) -> DataFrame:
    """``(row, doc_id, n_words, pos, gram)``: where benchmark shingles occur, and one row with a null gram per document."""
    base = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    return few_grams(base, grams, sizes) if n_grams <= BROADCAST_ROWS else many_grams(base, grams, sizes, n_grams)


def few_grams(base: DataFrame, grams: DataFrame, sizes: list[int]) -> DataFrame:
    """Occurrences of shingles that may be broadcast: by hash, then by their words."""

    def hashes(q: int) -> Column:
        return F.transform("w", lambda x, i: F.xxhash64(x, *[F.get("w", i + k) for k in range(1, q)]))

    # place 0 stands for the document itself, then one place a word for each shingle size
    places = base.select("row", "doc_id", "w", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), *[hashes(q) for q in sizes])).alias("p", "h"))
    known = grams.sparkSession.range(1).select(F.lit(0).cast("long").alias("h"), F.lit(None).cast("string").alias("gram"), F.lit(0).alias("q"))
    parts = F.split("gram", " ")
    for q in sizes:
        known = known.unionByName(grams.filter(F.col("q") == q).select(F.xxhash64(*[parts[k] for k in range(q)]).alias("h"), "gram", "q"))
    pos = F.pmod(F.col("p") - 1, F.size("w"))
    # near the end of a text, a longer shingle's hash is that of the words left: its size must be the gram's
    size = F.get(F.array(*[F.lit(q) for q in sizes]), F.floor((F.col("p") - 1) / F.size("w")).cast("int"))
    text = F.array_join(F.slice("w", pos + 1, F.col("q")), " ")
    same = F.when(F.col("p") == 0, F.col("gram").isNull()).otherwise((size == F.col("q")) & (text == F.col("gram")))
    met = places.join(F.broadcast(known.withColumnRenamed("h", "gh")), (F.col("h") == F.col("gh")) & same)
    return met.select("row", "doc_id", F.size("w").alias("n_words"), F.when(F.col("p") > 0, pos).alias("pos"), "gram")


def many_grams(base: DataFrame, grams: DataFrame, sizes: list[int], n_grams: int) -> DataFrame:
    """Occurrences of any number of shingles.

    A place carries its own shingle and no other word of the document.  Places
    that a Bloom filter of the shingles (32 MiB at most) lets pass are written,
    and shuffled by their shingle to meet the exact list; the documents' own
    rows, written beside them, stay out of the join.
    """

    def shingles(q: int) -> Column:
        last = F.size("w") - q
        cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("pos"), F.array_join(F.slice("w", i + 1, F.lit(q)), " ").alias("gram")))
        return F.when(last >= 0, cut).otherwise(F.array().cast("array<struct<pos:int,gram:string>>"))

    itself = F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("gram")))
    places = base.select("row", "doc_id", F.size("w").alias("n_words"), F.explode(F.concat(itself, *[shingles(q) for q in sizes])).alias("x"))
    places = places.select("row", "doc_id", "n_words", "x.pos", "x.gram")
    n_blocks = filter_blocks(n_grams)
    known = grams.select("gram")
    probed = probe(places, bloom_blocks(known, n_blocks, "gram"), n_blocks, "gram", "maybe").filter(F.col("maybe") | F.col("gram").isNull())
    kept = written(probed.drop("maybe"), "places")
    return kept.filter("gram is null").unionByName(kept.filter("gram is not null").join(known, "gram", "left_semi"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word inside any occurrence of a window is hit.  Words are
    A-Z lower-cased runs of characters other than ASCII punctuation, space and
    control characters.  Null texts, and items, have no words; items without
    words have no window; repeated rows of either table count each on its own;
    ids are compared as strings and an item with a null id names no item but
    still hits words.  Columns other than the named ones are not read.
    """
    windows = written(item_windows(benchmark, width), "windows")
    grams = written(window_shingles(windows), "window-shingles")
    distinct = grams.select("gram", "q").distinct()
    sizes = sorted(r["q"] for r in distinct.select("q").distinct().collect()) or [SHINGLE]
    found = written(occurrences(docs, distinct, sizes, distinct.count()), "occurrences")
    met = found.filter("gram is not null")
    # the rarest shingle of each window, by its count over all documents
    counts = met.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    prefix = grams.join(counts, "gram").groupBy("win", "m", "q").agg(F.min(F.struct("n", "gram", "at")).alias("r")).select("win", "m", "q", F.col("r.gram").alias("gram"), F.col("r.at").alias("at"))
    prefix = written(prefix, "prefix")
    start = F.col("pos") - F.col("at")
    candidates = met.join(prefix, "gram").filter((start >= 0) & (start + F.col("m") <= F.col("n_words"))).select("row", start.alias("start"), "win", "m", "q")
    # shingles 0, q, 2q, ... and the last one cover every word of the window
    steps = F.array_distinct(F.concat(F.sequence(F.lit(0), F.col("m") - F.col("q"), F.col("q")), F.array(F.col("m") - F.col("q"))))
    wanted = candidates.withColumn("steps", steps).select(
        "row", "start", "win", "m", F.size("steps").alias("need"), F.explode("steps").alias("at"), "q"
    )
    part = F.array_join(F.slice(F.split("win", " "), F.col("at") + 1, F.col("q")), " ")
    checked = wanted.select("row", (F.col("start") + F.col("at")).alias("pos"), part.alias("gram"), "start", "win", "m", "need").join(
        met.select("row", "pos", "gram"), ["row", "pos", "gram"]
    )
    exact = checked.groupBy("row", "start", "win", "m", "need").agg(F.count(F.lit(1)).alias("c")).filter("c = need")
    exact = written(exact.select("row", "start", "win", "m"), "contained")
    earlier = Window.partitionBy("row").orderBy("start", "m").rowsBetween(Window.unboundedPreceding, -1)
    spans = exact.select("row", "start", "m").distinct()
    hit = F.greatest(F.lit(0), F.col("start") + F.col("m") - F.greatest(F.col("start"), F.coalesce(F.max(F.col("start") + F.col("m")).over(earlier), F.lit(0))))
    n_hit = spans.select("row", hit.alias("hit")).groupBy("row").agg(F.sum("hit").alias("n_hit"))
    items = (
        exact.select("row", "win").distinct().join(windows.select("win", "item_id"), "win").filter("item_id is not null").select("row", "item_id").distinct()
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("ids"))
        .select("row", "n_items", F.array_join("ids", ",").alias("ids"))
    )
    rows = found.filter("gram is null").select("row", "doc_id", "n_words")
    joined = rows.join(n_hit, "row", "left").join(items, "row", "left")
    return joined.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.encode(F.coalesce("ids", F.lit("")), "UTF-8"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
