"""Experiment configuration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from splitlab.functions.dates import lookback
from splitlab.functions.hashing import group_of_slot


def _as_list(value) -> list:
    return [value] if isinstance(value, (int, str)) else list(value)


@dataclass(frozen=True)
class SplitConfig:
    """How units are split, which groups are compared, and which days are looked at.

    ``exp_weights`` are the weights of the hash buckets, ``exp_groups`` the number of consecutive
    buckets of each experiment group; ``control`` and ``test`` name groups by position. Weights left
    out are those of the account that the experiment reads.
    """

    run_date: date | str
    exp_groups: Sequence[int]
    control: int | Sequence[int]
    test: int | Sequence[int]
    exp_weights: Sequence[int] | None = None
    period: int = 42
    base_salt: str = "B"
    ntrials: int = 2000
    pos: str | Sequence[str] = "All"

    def __post_init__(self):
        for name in ("control", "test", "pos"):
            object.__setattr__(self, name, _as_list(getattr(self, name)))
        n_groups = len(self.exp_groups)
        unknown = [g for g in self.control + self.test if not 0 <= g < n_groups]
        if unknown:
            raise ValueError(f"groups {unknown} are outside the {n_groups} experiment groups")
        if self.exp_weights is not None:
            self.slots  # fails here when the groups do not cover the buckets

    @property
    def start_date(self) -> date:
        return lookback(self.run_date, self.period)[0]

    @property
    def end_date(self) -> date:
        return lookback(self.run_date, self.period)[1]

    @property
    def slots(self) -> list[int]:
        if self.exp_weights is None:
            raise ValueError("no bucket weights: neither given nor taken from an account")
        return group_of_slot(self.exp_weights, self.exp_groups)
