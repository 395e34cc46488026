"""A/A bootstrap: relative differences between groups that were treated alike, over many salts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitlab.functions.arith import mean_defined, nan_to_null, safe_ratio
from splitlab.functions.hashing import bucket_of_slot, group_of_bucket
from splitlab.operators.groups import group_days, quoted
from splitlab.operators.metrics import UnitSeries
from splitlab.operators.quantiles import exact_quantiles
from splitlab.sources.salts import SaltSet

# Twenty buckets read as groups of 5, 10, 25 and 50 percent.
DEFAULT_WEIGHTS = [1] * 20
DEFAULT_SCHEMES = [[1] * 20, [2] * 10, [5] * 4, [10] * 2]
DAYS_PER_WEEK = 7


def _sum_defined(names: Sequence[str]) -> str:
    """SQL for the sum of the columns that are not NULL; NULL when all are."""
    if not names:
        return "CAST(NULL AS DOUBLE)"
    if len(names) == 1:
        return names[0]
    total = " + ".join(f"coalesce({n}, 0D)" for n in names)
    return f"CASE WHEN coalesce({', '.join(names)}) IS NOT NULL THEN {total} END"


def scheme_days(
    series: UnitSeries, salts: SaltSet, weights: Sequence[int] = DEFAULT_WEIGHTS,
    schemes: Sequence[Sequence[int]] = DEFAULT_SCHEMES,
) -> DataFrame:
    """(salt_id, scheme, num_groups, day, one array of group sums per metric).

    Units are regrouped once, at bucket level; every scheme is then a sum over buckets within
    the row of a salt and day.
    """
    lookups = [group_of_bucket(s) for s in schemes]
    short = [list(s) for s, lookup in zip(schemes, lookups) if len(lookup) < len(weights)]
    if short:
        raise ValueError(f"schemes {short} do not cover {len(weights)} buckets")
    buckets = range(len(weights))
    wide = group_days(series, salts, bucket_of_slot(weights))

    def group_sums(metric: str, lookup: Sequence[int]) -> str:
        groups = [[quoted(f"{metric}__{b}") for b in buckets if lookup[b] == g] for g in range(max(lookup) + 1)]
        return f"array({', '.join(map(_sum_defined, groups))}) AS {quoted(metric)}"

    per_scheme = F.array(*[
        F.expr(f"struct({i} AS scheme, {max(lookup) + 1} AS num_groups, "
               + ", ".join(group_sums(m, lookup) for m in series.metrics) + ")")
        for i, lookup in enumerate(lookups)
    ])
    return wide.select("salt_id", "day", F.inline(per_scheme))


def paired_days(days: DataFrame, metrics: Sequence[str], pair: tuple[int, int] | None = None) -> DataFrame:
    """(salt_id, scheme, num_groups, day, day_rank, i, j, rdiff per metric) for all pairs i < j, or for one.

    A pair has a row on every day its first group has units; ``day_rank`` counts the days on
    which any pair has one, asked for or not. Both groups sit in one row, so pairs need no self join.
    """
    first = F.col(metrics[0])
    started = F.filter(
        F.transform(first, lambda v, i: F.when(v.isNotNull() & (i < F.col("num_groups") - 1), i)),
        lambda i: i.isNotNull(),
    )
    by_day = days.withColumn("started", started).where(F.size("started") > 0)
    order = Window.partitionBy("salt_id", "scheme").orderBy("day")
    ranked = by_day.withColumn("day_rank", F.row_number().over(order))
    if pair is None:
        left = ranked.withColumn("i", F.explode("started"))
        both = left.withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.col("num_groups") - 1)))
    else:
        there = F.array_contains("started", pair[0]) & (F.col("num_groups") > pair[1])
        both = ranked.where(there).withColumns({"i": F.lit(pair[0]), "j": F.lit(pair[1])})
    return both.select(
        "salt_id", "scheme", "num_groups", "day", "day_rank", "i", "j",
        *[(safe_ratio(F.get(m, F.col("i")), F.get(m, F.col("j"))) - 1).alias(f"rdiff_{m}") for m in metrics],
    )


def bootstrap_rdiff(
    series: UnitSeries, salts: SaltSet, period: int, weights: Sequence[int] = DEFAULT_WEIGHTS,
    schemes: Sequence[Sequence[int]] = DEFAULT_SCHEMES, pair: tuple[int, int] | None = None,
) -> DataFrame:
    """(salt_id, salt, paired_groups, num_days, num_groups, rdiff per metric).

    The mean daily relative difference of every pair of groups over the first 7, 14, ... days
    that have data, for every salt and group scheme. Who reads one pair only, as an interval
    does, asks for it as ``pair`` (i, j), and no other one is computed. Horizons are nested, so each is one
    conditional average of the same grouping rather than a copy of the rows.
    """
    metrics = series.metrics
    if period < DAYS_PER_WEEK:  # no whole week: no rows
        return bootstrap_rdiff(series, salts, DAYS_PER_WEEK, weights, schemes, pair).where("false")
    pairs = paired_days(scheme_days(series, salts, weights, schemes), metrics, pair)
    horizons = [DAYS_PER_WEEK * w for w in range(1, period // DAYS_PER_WEEK + 1)]
    within = {h: F.col("day_rank") <= h for h in horizons}
    means = pairs.groupBy("salt_id", "scheme", "num_groups", "i", "j").agg(
        F.min("day_rank").alias("first_rank"),
        *[
            mean_defined(F.when(within[h], F.col(f"rdiff_{m}"))).alias(f"{m}__{h}")
            for h in horizons for m in metrics
        ],
    )
    per_horizon = F.array(*[
        F.struct(F.lit(h).alias("num_days"), *[F.col(f"{m}__{h}").alias(f"rdiff_{m}") for m in metrics])
        for h in horizons
    ])
    long = means.select("salt_id", "num_groups", "i", "j", "first_rank", F.inline(per_horizon))
    named = long.where(F.col("first_rank") <= F.col("num_days")).join(
        salts.df.select("salt_id", "salt"), "salt_id"
    )
    return named.select(
        "salt_id", "salt",
        F.concat_ws("_", F.col("i").cast("string"), F.col("j").cast("string")).alias("paired_groups"),
        "num_days", "num_groups", *[f"rdiff_{m}" for m in metrics],
    )


def bootstrap_ci(
    rdiffs: DataFrame, metrics: Sequence[str], pair: str | None = "0_1",
    cut_on: str | None = None, cut: float = 5.0, probs: Sequence[float] = (0.025, 0.975), digits: int | None = 3,
) -> DataFrame:
    """Empirical confidence intervals per horizon and number of groups.

    Quantiles of the relative differences centred on their mean. ``pair`` keeps one pair of
    groups; ``cut_on`` names a metric whose values of ``cut`` and more are left out.
    """
    kept = rdiffs if pair is None else rdiffs.where(F.col("paired_groups") == pair)
    if cut_on is not None:
        kept = kept.where(F.abs(F.col(f"rdiff_{cut_on}")) < cut)
    keys = ["num_days", "num_groups"]
    # Centring shifts every value of a group alike, so it is applied to the quantiles.
    centres = kept.groupBy(*keys).agg(*[mean_defined(F.col(f"rdiff_{m}")).alias(f"mean_{m}") for m in metrics])
    ci = exact_quantiles(kept, keys, [f"rdiff_{m}" for m in metrics], probs).join(centres, keys)
    label = F.coalesce(*[F.when(F.col("prob") == p, F.lit(f"{p * 100}%")) for p in probs])

    def bound(m: str) -> Column:
        centred = nan_to_null(F.col(f"rdiff_{m}") - F.col(f"mean_{m}"))
        return (F.round(centred, digits) if digits is not None else centred).alias(f"eb_{m}")

    return ci.select(label.alias("confidence_interval"), "num_groups", "num_days", *[bound(m) for m in metrics])


def compare_ci(tables: dict[str, DataFrame], metrics: Sequence[str]) -> DataFrame:
    """Confidence intervals of several salt variants side by side, columns ordered by metric."""
    keys = ["confidence_interval", "num_groups", "num_days"]
    joined = None
    for name, table in tables.items():
        named = table.select(*keys, *[F.col(f"eb_{m}").alias(f"{name}_{m}") for m in metrics])
        joined = named if joined is None else joined.join(named, keys)
    return joined.select(*keys, *[f"{name}_{m}" for m in metrics for name in tables])


BINS_PER_BANDWIDTH = 1000


def bootstrap_density(
    rdiffs: DataFrame, metric: str, num_groups: Sequence[int] = (2,), cut: float | None = 5.0, grid: int = 100,
    margin: float = 3.0, bins_per_bandwidth: int = BINS_PER_BANDWIDTH,
) -> DataFrame:
    """Gaussian kernel density of the centred relative differences per horizon.

    Scott's bandwidth, ``grid`` points from ``margin`` bandwidths below the smallest value to as
    many above the largest. Values of ``cut`` and more are left out (None keeps all finite ones).
    Each value is shared between the two nearest bins by its distance to them and counted there;
    the kernel then runs over bins and points, whose numbers do not grow with the rows. With
    ``bins_per_bandwidth`` b the density is off by at most 1 / (20 b^2 bandwidth), 1e-7 of a usual peak.
    """
    keys = ["num_days", "num_groups"]
    value = F.col(f"rdiff_{metric}")
    inside = F.abs(value) < (float("inf") if cut is None else cut)
    kept = rdiffs.where(F.col("num_groups").isin(list(num_groups)) & inside).select(*keys, value.alias("x"))
    shape = kept.groupBy(*keys).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        (F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("bw"),
    ).where(F.col("bw") > 0)
    at = (F.col("x") - F.col("lo")) / F.col("bw") * bins_per_bandwidth
    placed = kept.join(F.broadcast(shape), keys).withColumn("at", at).withColumn("bin", F.floor("at"))
    right = F.col("at") - F.col("bin")
    shares = F.inline(F.array(
        F.struct(F.col("bin").alias("b"), (1 - right).alias("share")), F.struct((F.col("bin") + 1).alias("b"), right.alias("share")),
    ))
    binned = placed.select(*keys, shares).groupBy(*keys, "b").agg(F.sum("share").alias("share")).where("share > 0")
    low, high = F.col("lo") - margin * F.col("bw"), F.col("hi") + margin * F.col("bw")
    step = (high - low) / (grid - 1)
    points = binned.join(F.broadcast(shape), keys).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    points = points.withColumn("v", low + step * F.col("point"))
    centre = F.col("lo") + F.col("b") / bins_per_bandwidth * F.col("bw")
    kernel = F.col("share") * F.exp(-0.5 * F.pow((F.col("v") - centre) / F.col("bw"), 2))
    scale = F.first("n") * F.first("bw") * F.sqrt(F.lit(2.0) * F.pi())
    return points.groupBy(*keys, "point").agg(
        (F.first("v") - F.first("mean")).alias("x"), (F.sum(kernel) / scale).alias("density")
    )
