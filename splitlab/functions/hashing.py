"""Salt text and the salted-hash assignment of units to groups."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the assignment: they decide which unit lands in which group.
SALT_CHARS = 10
DIGEST_FIRST_CHAR = 29  # 1-based
DIGEST_CHARS = 4


def salt_text(base_salt: Column, run_date: Column, index: Column, ntrials: Column) -> Column:
    """base salt, month and day of the run date, zero-padded trial index; cut to ten characters."""
    month_day = F.date_format(run_date, "MMdd")
    digits = F.length(ntrials.cast("string"))
    padded = F.concat(F.repeat(F.lit("0"), digits - F.length(index.cast("string"))), index.cast("string"))
    return F.substring(F.concat(base_salt, month_day, padded), 1, SALT_CHARS)


def salts_collide(base_salt: str, ntrials: int) -> bool:
    """True when cutting the text drops index digits, so that two trials share a salt."""
    return ntrials > 1 and len(base_salt) + 4 + len(str(ntrials)) > SALT_CHARS


def hash_slot(unit_id: Column, salt: Column, n_slots: int) -> Column:
    """Number in [0, n_slots) from the last four hex digits of md5(unit id text + salt)."""
    text = F.concat(unit_id.cast("bigint").cast("string"), salt)
    digits = F.substring(F.md5(text.cast("binary")), DIGEST_FIRST_CHAR, DIGEST_CHARS)
    return F.conv(digits, 16, 10).cast("int") % F.lit(n_slots)


def bucket_of_slot(weights: Sequence[int]) -> list[int]:
    """Bucket for every slot: the first bucket whose cumulative weight exceeds the slot."""
    if not weights or any(w < 0 for w in weights) or sum(weights) == 0:
        raise ValueError("weights must be non-negative and not all zero")
    ends = list(accumulate(weights))
    return [next(b for b, end in enumerate(ends) if slot < end) for slot in range(ends[-1])]


def group_of_bucket(exp_groups: Sequence[int]) -> list[int]:
    """Experiment group for every bucket: [2, 3] gives [0, 0, 1, 1, 1]."""
    return [group for group, size in enumerate(exp_groups) for _ in range(size)]


def group_of_slot(weights: Sequence[int], exp_groups: Sequence[int]) -> list[int]:
    """Experiment group for every slot; fails when the groups do not cover every bucket."""
    groups = group_of_bucket(exp_groups)
    if len(groups) < len(weights):
        raise ValueError(f"exp_groups {list(exp_groups)} cover {len(groups)} of {len(weights)} buckets")
    return [groups[bucket] for bucket in bucket_of_slot(weights)]


def assign_group(unit_id: Column, salt: Column, weights: Sequence[int]) -> Column:
    """Bucket of a unit under a salt; the lookup is a literal array, so nothing is joined."""
    return assign_slot_value(unit_id, salt, bucket_of_slot(weights))


def assign_slot_value(unit_id: Column, salt: Column, slot_values: Sequence[int]) -> Column:
    """The value that ``slot_values`` gives to the slot of a unit under a salt."""
    slot = hash_slot(unit_id, salt, len(slot_values))
    if list(slot_values) == list(range(len(slot_values))):
        return slot
    return F.get(F.array(*[F.lit(int(v)) for v in slot_values]), slot)
