"""Chat formatting of reply trees.

Messages form trees by ``parent``.  Depth comes from pointer doubling (self
joins of the message table with its own pointers, one a doubling), and so do
the root-to-leaf paths: a leaf starts with itself and in each round also takes
the ancestor that the pointers of that round name, so a path of n messages
needs log2(n) joins and not n.  Branches of a tree are ranked by score, the
best ``top`` are formatted as one conversation each.

Template, one turn:   ``### <role>: <text> </turn>`` + newline.  Inside roles
and texts a backslash becomes ``\\\\``, ``###`` becomes ``\\h`` and ``</turn>``
becomes ``\\e`` (in roles also ``:`` becomes ``\\c``); so no control string can
stand inside a text, and reading back restores it.  Spans of the loss mask are
code-point ranges of the formatted string that hold assistant texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastebud.llm.scratch import written

_END = " </turn>\n"
_TURN = re.compile(r"### ([^:]*): ")
_ESCAPE = re.compile(r"\\(.)", re.S)
_PLAIN = {"\\": "\\", "h": "###", "e": "</turn>", "c": ":"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("###", "\\h").replace("</turn>", "\\e")


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _PLAIN[m[1]], text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted conversation and the starts and ends of its assistant texts."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head = f"### {escape(role).replace(':', chr(92) + 'c')}: "
        body = escape(text)
        if role == "assistant":
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, _END]
        at += len(head) + len(body) + len(_END)
    return "".join(parts), starts, ends


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        head = _TURN.match(formatted, at)
        end = formatted.index(_END, head.end())
        out.append((unescape(head[1]), unescape(formatted[head.end() : end])))
        at = end + len(_END)
    return out


def tree_paths(messages: DataFrame, tree: str, node: str, parent: str) -> DataFrame:
    """``(tree, leaf, node, depth)``: every message of every root-to-leaf path, root at depth 0.

    A parent that does not exist makes its child a root.  Messages on a cycle
    reach no root and so are on no path.  Node ids must be unique in a tree.
    """
    nodes = messages.select(F.col(tree).alias("t"), F.col(node).alias("n"), F.col(parent).alias("p"))
    known = nodes.select(F.col("t").alias("kt"), F.col("n").alias("kn"))
    jump = written(
        nodes.join(known, F.col("t").eqNullSafe(F.col("kt")) & (F.col("p") == F.col("kn")), "left").select(
            "t", "n", F.col("kn").alias("up"), F.when(F.col("kn").isNull(), 0).otherwise(1).cast("long").alias("depth")
        ),
        "jump",
    )
    parents = jump.filter("up is not null").select("t", F.col("up").alias("n")).distinct()
    paths = jump.join(parents, jump.t.eqNullSafe(parents.t) & (jump.n == parents.n), "left_anti").select(
        "t", F.col("n").alias("leaf"), "n"
    )
    paths = written(paths, "paths")
    done = jump.filter("up is null").select("t", "n", "depth")
    jump = jump.filter("up is not null")
    largest = nodes.groupBy("t").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(largest.bit_length() + 1):  # only cycles still have pointers after so many doublings
        if jump.isEmpty():
            break
        step = jump.select(F.col("t").alias("jt"), F.col("n").alias("jn"), "up")
        met = F.col("t").eqNullSafe(F.col("jt")) & (F.col("n") == F.col("jn"))
        paths = written(paths.unionByName(paths.join(step, met).select("t", "leaf", F.col("up").alias("n"))), "paths")
        # a pointer to a message whose own root is known is settled by that message's depth
        far = jump.unionByName(done.withColumn("up", F.lit(None).cast(jump.schema["up"].dataType))).select(
            F.col("t").alias("t2"), F.col("n").alias("n2"), F.col("up").alias("up2"), F.col("depth").alias("hop2")
        )
        doubled = written(
            jump.join(far, F.col("t").eqNullSafe(F.col("t2")) & (F.col("up") == F.col("n2"))).select(
                "t", "n", F.col("up2").alias("up"), (F.col("depth") + F.col("hop2")).alias("depth")
            ),
            "jump",
        )
        done = done.unionByName(doubled.filter("up is null").select("t", "n", "depth"))
        jump = doubled.filter("up is not null")
    rooted = done.select(F.col("t").alias("jt"), F.col("n").alias("jn"), "depth")
    met = F.col("t").eqNullSafe(F.col("jt")) & (F.col("n") == F.col("jn"))
    return paths.join(rooted, met).select(F.col("t").alias(tree), "leaf", F.col("n").alias("node"), "depth")


def rank_branches(paths: DataFrame, scores: DataFrame, tree: str, top: int | None = 1) -> DataFrame:
    """Best ``top`` leaves of each tree by the sum of message scores (null counts 0), then length, then smaller leaf."""
    total = (
        paths.join(scores.select(F.col(tree).alias("st"), F.col("node").alias("sn"), "score"), F.col(tree).eqNullSafe(F.col("st")) & (F.col("node") == F.col("sn")))
        .groupBy(tree, "leaf")
        .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("branch_score"), F.count(F.lit(1)).alias("n_turns"))
    )
    order = Window.partitionBy(tree).orderBy(F.desc("branch_score"), F.desc("n_turns"), "leaf")
    ranked = total.withColumn("branch", F.row_number().over(order))
    return ranked if top is None else ranked.filter(F.col("branch") <= top)


def format_branches(messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role", text: str = "text", score: str | None = None, top: int | None = 1) -> DataFrame:
    """One row per chosen branch: tree, leaf, branch, branch_score, formatted, loss_starts, loss_ends.

    Null roles and texts count as empty.  Columns other than the named ones
    are not read.  A tree without messages has no row.
    """
    plain = messages.select(
        F.col(tree).alias("tree"),
        F.col(node).alias("node"),
        F.col(parent).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.col(score) if score else F.lit(0.0)).cast("double").alias("score"),
    )
    paths = written(tree_paths(plain, "tree", "node", "parent"), "paths")
    chosen = rank_branches(paths, plain, "tree", top)
    picked = paths.alias("p").join(chosen.alias("c"), F.expr("p.tree <=> c.tree and p.leaf = c.leaf")).select("p.tree", "p.leaf", "p.node", "p.depth", "c.branch", "c.branch_score")
    turns = (
        picked.alias("k")
        .join(plain.alias("m"), F.expr("k.tree <=> m.tree and k.node = m.node"))
        .groupBy("k.tree", "k.leaf", "k.branch", "k.branch_score")
        .agg(F.array_sort(F.collect_list(F.struct("k.depth", "m.role", "m.text"))).alias("turns"))
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in b["turns"]]
            out = b[["tree", "leaf", "branch", "branch_score"]].copy()
            out["formatted"], out["loss_starts"], out["loss_ends"] = [m[0] for m in made], [m[1] for m in made], [m[2] for m in made]
            yield out

    kinds = dict(plain.dtypes)
    schema = f"tree {kinds['tree']}, leaf {kinds['node']}, branch int, branch_score double, formatted string, loss_starts array<long>, loss_ends array<long>"
    return turns.mapInPandas(write, schema)


def conversation_trees(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees: each row replies to the one before it.

    Rows go by turn (null first), then role and text, so repeated turns have a place too.
    """
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return (
        conversations.select(F.col("conv_id").cast("long").alias("tree"), "turn", "role", "text")
        .withColumn("node", F.row_number().over(order).cast("long"))
        .select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text")
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: counts and digests of turns and of the loss mask."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for tree, leaf, text, starts, ends in zip(b["tree"], b["leaf"], b["formatted"], b["loss_starts"], b["loss_ends"]):
                turns = read_turns(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")
                loss = "".join(unescape(text[s:e]) for s, e in zip(starts, ends))
                rows.append((tree, leaf, len(turns), hashlib.sha256(said).hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            out = pd.DataFrame(rows, columns=["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            out["tree"] = out["tree"].astype("Int64")
            yield out

    return formatted.select("tree", "leaf", "formatted", "loss_starts", "loss_ends").mapInPandas(
        read, "tree long, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
