"""URL filter: allow / block rules, then a list of URLs behind a blocked Bloom filter.

Native: DataFrame and SQL expressions only.

* A rule is (verdict, host, path).  It fits a URL whose host is the rule's or a
  subdomain of it and whose path starts with the rule's; the longest rule
  (host plus path) wins, equal lengths go to block, then to the smaller text.
* A URL that no rule fits is blocked when its canonical form is on the list.
  The list becomes a blocked Bloom filter of 256-bit blocks, one row each, sized
  from the list's distinct count to 16 bits an entry, within ``MIN_BLOCKS`` and
  ``MAX_BLOCKS`` (32 MiB), so it may be broadcast.  URLs that pass it go on to an
  exact join with the list, which removes the false positives; a list beyond 16
  million entries only sends more rows there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastebud.llm.scratch import written

#: Bounds of the filter's number of blocks.
MIN_BLOCKS, MAX_BLOCKS = 1 << 10, 1 << 20
#: Entries a block is meant for.
_LOAD = 16
_WORDS = 4  # 64-bit words a block
_SETS = 2  # bits set in each word
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Prefixes of a host that name the same site, and query keys that only track: fixed values.
_SITE_PREFIX = r"^(www|m|mobile|amp)\."
_TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid)="


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def canonical_url(url: Column) -> Column:
    """host without site prefix + path without trailing slash + sorted query without tracking keys.

    Scheme and fragment go.  Null stays null.
    """
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~q.rlike(_TRACKING)))
    text = F.concat(
        F.regexp_replace(host, _SITE_PREFIX, ""),
        F.regexp_replace(path, r"/+$", ""),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""),
    )
    return F.when(url.isNotNull(), text)


def filter_blocks(entries: int) -> int:
    """Blocks of a filter of so many entries: a power of two."""
    return min(MAX_BLOCKS, max(MIN_BLOCKS, 1 << (max(entries, 1) // _LOAD).bit_length()))


def _block(h: Column, n_blocks: int) -> Column:
    return F.pmod(h, F.lit(n_blocks)).cast("int")


def _bits(text: Column, word: int) -> Column:
    """The bits of one 64-bit word that a URL sets, from a second hash of it."""
    h = F.xxhash64(text, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for k in range(_SETS):
        shift = F.shiftrightunsigned(h, (word * _SETS + k) * 6).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), shift))
    return mask


def bloom_blocks(listed: DataFrame, n_blocks: int, entry: str = "canonical") -> DataFrame:
    """Blocked Bloom filter of a list's texts: one row per non-empty block, ``n_blocks`` at most."""
    c = F.col(entry)
    return (
        listed.filter(c.isNotNull())
        .groupBy(_block(F.xxhash64(c), n_blocks).alias("block"))
        .agg(*[F.bit_or(_bits(c, w)).alias(f"w{w}") for w in range(_WORDS)])
    )


def probe(rows: DataFrame, blocks: DataFrame, n_blocks: int, entry: str, flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether the text in ``entry`` may be in the filter; false for null."""
    c, hit = F.col(entry), F.lit(True)
    for w in range(_WORDS):
        bits = _bits(c, w)
        hit = hit & (F.col(f"w{w}").bitwiseAND(bits) == bits)
    met = rows.withColumn("block", _block(F.xxhash64(c), n_blocks)).join(F.broadcast(blocks), "block", "left")
    return met.select(*rows.columns, F.coalesce(hit & c.isNotNull(), F.lit(False)).alias(flag))


def rule_column(rules: list[Rule], host: Column, path: Column, value: str) -> Column:
    """``value`` (``text`` or ``verdict``) of the winning rule, else null."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    out = F.lit(None).cast("string")
    for r in reversed(ranked):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, value))).otherwise(out)
    return out


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, canonical, rule, maybe_listed, listed, verdict.

    ``listed`` has one column ``canonical``; nulls and repeats in it count once.
    A null url, or one without ``://``, has empty host and path; no rule fits
    it, a null is never listed, and so it is allowed.  Repeated pages stay
    repeated.  Only the two named columns of ``pages`` are read, so its other
    columns may have any names.
    """
    wanted = written(listed.select("canonical").filter("canonical is not null").distinct(), "listed")
    n_blocks = filter_blocks(wanted.count())
    host, path = host_and_path(F.col("_url"))
    base = (
        pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
        .select("_id", host.alias("host"), path.alias("path"), canonical_url(F.col("_url")).alias("canonical"))
        .withColumns({"rule": rule_column(rules, F.col("host"), F.col("path"), "text"), "_ruled": rule_column(rules, F.col("host"), F.col("path"), "verdict")})
    )
    probed = probe(base, bloom_blocks(wanted, n_blocks), n_blocks, "canonical", "maybe_listed")
    exact = wanted.select(F.col("canonical").alias("_hit"))
    # only possible hits meet the list; the others are done
    clear = probed.filter(~F.col("maybe_listed")).withColumn("_hit", F.lit(None).cast("string"))
    suspects = probed.filter("maybe_listed").join(exact, F.col("canonical") == F.col("_hit"), "left")
    return clear.unionByName(suspects).select(
        F.col("_id").alias(id_col),
        "host",
        "path",
        "canonical",
        "rule",
        "maybe_listed",
        F.col("_hit").isNotNull().alias("listed"),
        F.coalesce("_ruled", F.when(F.col("_hit").isNotNull(), "block").otherwise("allow")).alias("verdict"),
    )
