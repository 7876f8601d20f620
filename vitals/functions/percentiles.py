"""Exact percentiles of groups of any size by selection.

*Bounds.* One aggregate holds, next to the other totals of a group, a mergeable sketch of each column. Its
answers are off by at most one row in ``accuracy``, so two of them, a few steps below and above a share, bound the wanted
value. A sketch of fewer than ``accuracy`` / 2 values has lost none of them: its answer is exact.

*Selection.* For larger groups the rows are read once more. Each counts as below the lower bound, or with its value
between the bounds, or not at all; both collapse in each task. Only the values between the bounds, a few in
``accuracy`` of the group, are shuffled and ranked, for each percentile on its own. All percentiles
and all columns of a table share one such pass.

No window ever spans a group, and no rows are sorted but those between the bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

ACCURACY = 10_000
# Bounds lie this many times the sketch's own error beside the share.
MARGIN = 4
# Keeps ceil(share * rows) from being rounded up where the product is a whole number.
BELOW = 1e-9
# Sketches hold doubles; whole numbers beyond this are rounded there, so their groups are selected from, too.
DOUBLE_EXACT = 1 << 53


def exact_percentiles(
    df: DataFrame, value: str, percentiles: dict[str, float], keys: Sequence[str] = (), few: bool = False
) -> DataFrame:
    """Exact discrete percentiles: the smallest value whose cumulative count reaches p * n."""
    return percentile_table(df, keys, [], {name: (value, p) for name, p in percentiles.items()}, few)


def percentile_table(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    wanted: dict[str, tuple[str, float]],
    few: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``aggregates`` of each group and its exact percentiles: name -> (column, share).

    NULLs do not count; a group whose values are all NULL has NULL percentiles. A NULL key is a group.
    ``df`` should have no columns but those that the keys, values and aggregates need.
    ``few`` states that the number of groups is bounded whatever the data (eras, flags), so the bounds
    are broadcast; else Spark joins them by key.
    """
    keys = list(keys)
    values = list(dict.fromkeys(column for column, _ in wanted.values()))
    # Always true, but all columns are read in both passes, which so share the shuffles below them.
    df = _whole(df)
    shares = {c: [p for column, p in wanted.values() if column == c] for c in values}

    def asked(c: str) -> list[float]:
        step = MARGIN / accuracy
        return [q for p in shares[c] for q in (max(p - step, 0.0), max(p - BELOW, 0.0), min(p + step, 1.0))]

    kinds = [df.schema[c].dataType for c in values]
    if any(isinstance(t, T.DecimalType) for t in kinds):
        raise TypeError("sketches round decimals: cast them to bigint or double first")
    wide = [isinstance(t, T.LongType) for t in kinds]
    beyond = [
        F.count_if((F.col(c) > DOUBLE_EXACT) | (F.col(c) < -DOUBLE_EXACT)).alias(f"_x{j}") for j, c in enumerate(values) if wide[j]
    ]
    sketches = [F.percentile_approx(c, asked(c), accuracy).alias(f"_s{j}") for j, c in enumerate(values)]
    counts = [F.count(c).alias(f"_n{j}") for j, c in enumerate(values)]
    grouped = df.groupBy(*keys) if keys else df
    first = grouped.agg(*aggregates, *sketches, *counts, *beyond)
    first = _whole(first)  # read twice, too

    # Of each percentile: its column's number, whether its group is large, the sketch's answers, the wanted rank.
    to_select = [(F.col(f"_n{j}") >= accuracy // 2) | (F.col(f"_x{j}") > 0 if wide[j] else F.lit(False)) for j in range(len(values))]
    marks, bounds = {}, []
    for k, (name, (c, p)) in enumerate(wanted.items()):
        j = values.index(c)
        at = 3 * [n for n, (column, _) in wanted.items() if column == c].index(name)
        large = to_select[j]
        marks[name] = k, j, large, F.get(f"_s{j}", F.lit(at + 1))
        rank = F.ceil(F.lit(Decimal(str(p))) * F.col(f"_n{j}")).cast("bigint")
        low, high = (F.when(large, F.get(f"_s{j}", F.lit(at + i))) for i in (0, 2))
        if wide[j]:  # as far as a double may be off
            low = F.coalesce(F.try_subtract(low, F.abs(low / 2**50).cast("bigint") + 1), low)
            high = F.coalesce(F.try_add(high, F.abs(high / 2**50).cast("bigint") + 1), high)
        bounds.append(F.struct(low.alias("low"), high.alias("high"), F.greatest(rank, F.lit(1)).alias("rank")).alias(f"_b{k}"))
    bound = first.filter(F.array_contains(F.array(*to_select), True)).select(*keys, *bounds)

    def candidate(k: int, c: str) -> Column:
        b, v = F.col(f"_b{k}"), F.col(c)
        own = [F.when(v >= b["low"], v) if x == c else F.lit(None).cast(kinds[j]) for j, x in enumerate(values)]
        fields = [x.alias(f"_v{j}") for j, x in enumerate(own)]
        return F.when(v <= b["high"], F.struct(F.lit(k).alias("_k"), b["rank"].alias("_rank"), *fields))

    if keys:
        bounded = _joined(df.select(*keys, *values), F.broadcast(bound) if few else bound, keys, "inner")
    else:
        bounded = df.select(*values).withColumn("_all", bound.select(F.struct("*")).scalar()).select("*", "_all.*").drop("_all")
    names = [f"_v{j}" for j in range(len(values))]
    kept = F.array_compact(F.array(*(candidate(k, c) for k, (c, _) in enumerate(wanted.values()))))
    ranked = bounded.select(*keys, F.inline(kept)).groupBy(*keys, "_k", "_rank", *names).agg(F.count("*").alias("_rows"))
    upward = W.partitionBy(*keys, "_k").orderBy(*(F.asc_nulls_first(v) for v in names)).rowsBetween(W.unboundedPreceding, 0)
    reached = ranked.withColumn("_upto", F.sum("_rows").over(upward)).filter("_upto >= _rank")
    found = [_bounded_only(F.min(F.when(F.col("_k") == k, F.struct(f"_v{j}"))), j).alias(f"_p{k}") for k, j, *_ in marks.values()]
    picked = reached.groupBy(*keys).agg(*found) if keys else reached.agg(*found)

    if keys:
        whole = _joined(first, F.broadcast(picked) if few else picked, keys, "left")
    else:
        whole = first.withColumns({f"_p{k}": picked.select(f"_p{k}").scalar() for k, *_ in marks.values()})
    results = [
        F.when(large, F.coalesce(f"_p{k}", F.raise_error(F.lit("a percentile lies outside its bounds")))).otherwise(small).alias(name)
        for name, (k, j, large, small) in marks.items()
    ]
    others = [c for c in first.columns if c not in keys and c not in {f"_{x}{j}" for x in "snx" for j in range(len(values))}]
    return whole.select(*keys, *others, *results)


def _whole(df: DataFrame) -> DataFrame:
    """The same rows with a condition on every column that always holds but is not optimized away. One
    condition for each: the optimizer would try all aliases of all columns of a common one."""
    for c in df.columns:
        df = df.filter(F.xxhash64(c) >= F.lit(-(1 << 63)))
    return df


def _bounded_only(least: Column, j: int) -> Column:
    """The value; an error if the wanted row were among those below the lower bound."""
    value = least[f"_v{j}"]
    below = least.isNotNull() & value.isNull()
    return F.when(below, F.raise_error(F.lit("a percentile lies below its bounds"))).otherwise(value)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left copy of the keys."""
    l, r = left.alias("l"), right.alias("r")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    rest = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return l.join(r, condition, how).select("l.*", *rest)
