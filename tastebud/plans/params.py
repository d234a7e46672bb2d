"""Model parameters (keyword arguments with the reference's class defaults)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


def link_args(*args: object) -> str:
    """The reference's argument echo: values joined with '_' (None prints as 'auto')."""
    return "_".join("auto" if a is None else str(a) for a in args)


@dataclass(frozen=True)
class RulesParams:
    end_time: datetime = datetime(2000, 6, 15)
    months: int = 1
    tran_days: int = 4
    max_items: int = 100
    min_support: float = 0.2
    min_confidence: float = 0.8
    top_n: int = 10
    # FP-growth groups; None follows the baskets' own partitioning, which
    # adaptive execution sizes from the data (explicit small counts multiply
    # the conditional transactions for nothing on small inputs).
    num_partitions: int | None = None
    include_scores: bool = False
    # True: rows at or after end_time do not train the rules, and day N
    # belongs to the hold-out only (the reference lets both overlap).
    holdout: bool = False
    # Frequent sets shorter than this are a product; sets of at most
    # ``max_prior`` items are matched against users, and rules of at most
    # ``max_antecedent`` items applied.  None: no limit.
    max_len: int | None = 10
    max_prior: int | None = 3
    max_antecedent: int | None = 3

    @property
    def op_time(self) -> str:
        return self.end_time.strftime("%Y%m%d00")


@dataclass(frozen=True)
class CosineParams:
    min_sim: float = 0.7
    top_sim: int = 20
    min_commons: int = 5
    min_rating: float = 2
    top_n: int = 10
    op_time: str = "2000061500"

    def arguments(self) -> str:
        return link_args(self.min_sim, self.top_sim, self.min_commons, f"{self.min_rating:g}", self.top_n)


@dataclass(frozen=True)
class SegmentParams:
    k: int = 5
    max_iter: int = 10
    top_n: int = 10
    seed: int = 42
    exclude_seen: bool = False
    op_time: str = "2000061500"

    def arguments(self) -> str:
        return link_args(self.k, self.max_iter, self.top_n)


@dataclass(frozen=True)
class AlsParams:
    rank: int = 10
    reg: float = 1.0
    max_iter: int = 10
    top_n: int = 10
    blocks: int = 10
    min_score: float = 3.0
    seed: int = 42
    op_time: str = "2000061500"

    def arguments(self) -> str:
        return link_args(self.rank, self.reg, self.max_iter, self.top_n, self.blocks)
