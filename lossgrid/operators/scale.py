"""Building blocks that keep results exact without ever gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.sources.scratch import cut_lineage

#: rank accuracy of the sketch that brackets an exact quantile
SKETCH_ACCURACY = 20_000

#: bins that the values of a bracket are counted in
BINS = 1024


def attach_group_stats(df: DataFrame, keys: Sequence[str], *stats: Column) -> DataFrame:
    """Group aggregates on every row.

    A window over the keys would move every row of a hot group to one task;
    here the groups are pre-aggregated map-side and only the small result travels.
    """
    keys = list(keys)
    summary = df.groupBy(*keys).agg(*stats)
    return df.join(summary, keys, "left")


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Column behind a one-element generator.

    A filter on a plain projected column is pushed below the projection with the
    whole expression inlined again; a generator's output is not, so an expensive
    score that is filtered on is evaluated once per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


# -- exact quantiles ---------------------------------------------------------


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, value) rows of the numeric columns, nulls dropped."""
    if len(columns) == 1:  # nothing to unpivot
        only = columns[0]
        return df.select(*by, F.lit(only).alias("metric"), F.col(only).cast("double").alias("value")).where(
            F.col("value").isNotNull()
        )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    return (
        df.select(*by, pairs.alias("_p"))
        .select(*by, "_p.metric", "_p.value")
        .where(F.col("value").isNotNull())
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group and column, as (by..., metric, prob, value, n).

    1. A mergeable sketch per group brackets every requested rank.
    2. Values outside all brackets are collapsed onto the nearest bracket edge,
       which keeps their rank, and equal values are counted map-side.  What is
       left per group is a small fraction of its distinct values.
    3. Every bracket is cut into bins.  How many values come before a bin follows
       from the bins' counts, so running counts are taken bin by bin, and they pick
       the order statistics.

    No step holds a group's values in memory, and no task sorts more of a group than
    a bin: the sketch has fixed size, and so have the counts of the bins.  A rank that
    no value holds is an error.
    """
    probs = sorted(set(float(p) for p in probs))
    group = [*by, "metric"]
    values = long_values(df, columns, by)
    slack = 3.0 / accuracy
    edges = sorted({e for p in probs for e in (max(0.0, p - slack), min(1.0, p + slack))})
    sketch = values.groupBy(*group).agg(
        F.count("*").alias("n"), F.percentile_approx("value", edges, accuracy).alias("_edges")
    )
    at = {e: F.col("_edges")[i] for i, e in enumerate(edges)}
    brackets = [(at[max(0.0, p - slack)], at[min(1.0, p + slack)]) for p in probs]

    v = F.col("value")
    inside = None
    for lo, hi in brackets:
        here = v.between(lo, hi)
        inside = here if inside is None else (inside | here)
    # below the sketch size one rank is more than the slack; such a group is small enough to keep whole
    inside = inside | (F.col("n") <= accuracy)
    # outside every bracket: the highest upper edge below the value (null = before the first bracket)
    floor_edge = F.greatest(*[F.when(v > hi, hi) for _, hi in brackets], F.lit(None).cast("double"))
    if by:
        bracketed = values.join(sketch, group)
    elif len(columns) > 1:
        bracketed = values.join(F.broadcast(sketch), group)  # one row per column
    else:  # a single row: a scalar, because a join on the constant column name would have no key left
        row = sketch.select(F.struct("n", "_edges").alias("s")).scalar()
        bracketed = values.withColumns({"_s": row}).select(*group, "value", "_s.n", "_s._edges")
    kept = bracketed.select(*group, "n", "_edges", F.when(inside, v).otherwise(floor_edge).alias("_kept"))
    counts = (
        computed_once(kept, "value", F.col("_kept"))  # the bin asks for the value many times
        .select(*group, "n", "value", _bin(v, brackets).alias("_bin"))
        .groupBy(*group, "_bin", "value")
        .agg(F.first("n").alias("n"), F.count("*").alias("c"))
    )
    ranked = _running(counts, group)
    wanted = F.explode(F.array(*[F.lit(p) for p in probs]))
    hits = ranked.select("*", wanted.alias("prob")).withColumns(
        {"_lo": F.floor(F.col("prob") * (F.col("n") - 1)), "_hi": F.ceil(F.col("prob") * (F.col("n") - 1))}
    )
    # zero-based ranks [_upto - c, _upto) hold this value

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_upto") - F.col("c")) & (rank < F.col("_upto"))

    picked = hits.groupBy(*group, "prob").agg(
        F.max("n").alias("n"),
        F.max(F.when(holds(F.col("_lo")), v)).alias("_a"),
        F.max(F.when(holds(F.col("_hi")), v)).alias("_b"),
    )
    part = F.col("prob") * (F.col("n") - 1) - F.floor(F.col("prob") * (F.col("n") - 1))
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * part
    return picked.select(*group, "prob", _found(value).alias("value"), "n")


def _bin(value: Column, brackets: Sequence[tuple[Column, Column]]) -> Column:
    """Number of a value's bin: higher values have the same or a higher one.  Null is below all values."""
    above = sum(((value > hi).cast("int") for _, hi in brackets[1:]), (value > brackets[0][1]).cast("int"))
    place = F.lit(0)
    for k, (lo, hi) in reversed(list(enumerate(brackets))):
        share = F.coalesce(F.try_divide((value - lo) * BINS, hi - lo), F.lit(0.0))
        inside = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(share))).cast("int")
        place = F.when(value <= hi, inside).otherwise(place)
    return F.when(value.isNotNull(), above * BINS + place).otherwise(-1)


def _running(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """``_upto``: how many of the group's values are at most this one."""
    # at most BINS rows for each bracket of a group
    sums = counts.groupBy(*group, "_bin").agg(F.sum("c").alias("_c"))
    earlier = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "_bin", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*group, "_bin").orderBy(F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_upto", F.sum("c").over(within)).join(sums, [*group, "_bin"]).withColumn(
        "_upto", F.col("_upto") + F.col("_before")
    ).drop("_before", "_bin")


def _found(value: Column) -> Column:
    return F.when(value.isNull(), F.raise_error(F.lit("no value holds the rank asked for")).cast("double")).otherwise(value)


def quantile_columns(
    df: DataFrame, wanted: dict[str, tuple[str, float]], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles as named columns: ``{"median": ("amount", 0.5)}``, one row per group."""
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    probs = [p for _, p in wanted.values()]
    q = exact_quantiles(df, columns, probs, by)
    picks = [
        F.max(F.when((F.col("metric") == c) & (F.col("prob") == p), F.col("value"))).alias(name)
        for name, (c, p) in wanted.items()
    ]
    return q.groupBy(*by).agg(*picks) if by else q.agg(*picks)


def smallest_rank_threshold(
    df: DataFrame, key: str, by: Sequence[str], fraction: float, bounded: bool = False, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Per group, the value of the (distinct) key whose rank is floor(fraction * n): an exact split point.

    Keys strictly below it are exactly the ``floor(fraction * n)`` smallest.
    ``bounded`` says the groups were filtered to a fixed vocabulary, so their
    sketches need no size check before they are broadcast.
    """
    group = [*by, "metric"]
    values = long_values(df, [key], by)
    slack = 3.0 / accuracy
    lo_p, hi_p = max(0.0, fraction - slack), min(1.0, fraction + slack)
    sketch = values.groupBy(*group).agg(
        F.count("*").alias("n"), F.percentile_approx("value", [lo_p, hi_p], accuracy).alias("_e")
    )
    v, lo, hi = F.col("value"), F.col("_e")[0], F.col("_e")[1]
    kept = v.between(lo, hi) | (F.col("n") <= accuracy)
    collapsed = F.when(kept, v).otherwise(F.when(v > hi, hi))
    counts = (
        values.join(F.broadcast(sketch) if bounded else sketch, group)
        .select(*group, "n", "_e", collapsed.alias("value"))
        .select(*group, "n", "value", _bin(v, [(lo, hi)]).alias("_bin"))
        .groupBy(*group, "_bin", "value")
        .agg(F.first("n").alias("n"), F.count("*").alias("c"))
    )
    ranked = _running(counts, group)
    rank = F.floor(F.lit(fraction) * F.col("n"))
    here = (rank >= F.col("_upto") - F.col("c")) & (rank < F.col("_upto"))
    return ranked.groupBy(*by).agg(F.max(F.when(here, v)).alias("threshold"), F.max("n").alias("n"))


# -- distributed ordering ----------------------------------------------------

_ROW_BITS = (1 << 33) - 1


def ordered_slices(df: DataFrame, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Range-sorted rows with partition number and position, pinned by a checkpoint.

    Two later passes read the same placement, so it must not be recomputed.
    """
    placed = df.sort(*part, *order).withColumn("_at", F.monotonically_increasing_id())
    return cut_lineage(placed).withColumns(
        {"_pid": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND(F.lit(_ROW_BITS))}
    )


def with_slice_summary(rows: DataFrame, summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """Rows with the summary of their slice and group; a null group is a group like any other."""
    tied = summary.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate([*part, "_pid"])})
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*part, "_pid"])]
    return rows.join(tied, same).drop(*[f"_k{i}" for i in range(len(same))])


def distributed_row_number(
    df: DataFrame, part: Sequence[str], order: Sequence[str], name: str = "row_number"
) -> DataFrame:
    """``row_number() over (partition by part order by order)`` without gathering a group in one task.

    The rows are range-sorted once; each sorted partition then only needs how
    many rows of its group lie in earlier partitions.
    """
    part = list(part)
    rows = ordered_slices(df, part, order)
    starts = rows.groupBy(*part, "_pid").agg(F.min("_pos").alias("_start"), F.count("*").alias("_c"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    joined = with_slice_summary(rows, starts, part)
    rn = F.col("_pos") - F.col("_start") + F.col("_before") + 1
    return joined.withColumn(name, rn.cast("long")).drop("_at", "_pid", "_pos", "_start", "_before")


def distributed_running_sums(
    df: DataFrame, part: Sequence[str], order: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums over all strictly earlier rows of the group (exclusive prefix sums), distributed like above."""
    part = list(part)
    rows = ordered_slices(df.withColumns(sums), part, order)
    names = list(sums)
    totals = rows.groupBy(*part, "_pid").agg(*[F.sum(n).alias(f"_t_{n}") for n in names])
    earlier = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *part, "_pid", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in names]
    )
    within = Window.partitionBy(*part, "_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = {f"_l_{n}": F.coalesce(F.sum(n).over(within), F.lit(0)) for n in names}
    joined = with_slice_summary(rows.withColumns(local), totals, part)
    return joined.withColumns({f"{n}_before": F.col(f"_l_{n}") + F.col(f"_b_{n}") for n in names}).drop(
        "_at", "_pid", "_pos", *[f"_l_{n}" for n in names], *[f"_b_{n}" for n in names]
    )


def distributed_lag(
    df: DataFrame, part: Sequence[str], order: Sequence[str], columns: dict[str, str]
) -> DataFrame:
    """Previous row's values (``{"prev_x": "x"}``) in group order; null on a group's first row.

    Windows run inside sorted partitions only; the first row of a partition takes
    the last row of the group from the nearest earlier partition.
    """
    part = list(part)
    rows = ordered_slices(df, part, order)
    within = Window.partitionBy(*part, "_pid").orderBy("_pos")
    names = list(columns)
    tails = rows.groupBy(*part, "_pid").agg(
        F.min("_pos").alias("_first"), F.max_by(F.struct(*columns.values()), F.col("_pos")).alias("_tail")
    )
    across = Window.partitionBy(*part).orderBy("_pid")
    tails = tails.select(*part, "_pid", "_first", F.lag("_tail").over(across).alias("_before"))
    local = {f"_l_{n}": F.lag(c).over(within) for n, c in columns.items()}
    joined = with_slice_summary(rows.withColumns(local), tails, part)
    at_start = F.col("_pos") == F.col("_first")
    picked = {n: F.when(at_start, F.col("_before")[c]).otherwise(F.col(f"_l_{n}")) for n, c in columns.items()}
    return joined.withColumns(picked).drop(
        "_at", "_pid", "_pos", "_first", "_before", *[f"_l_{n}" for n in names]
    )
