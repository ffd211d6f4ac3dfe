"""Order-dependent sums over tables with no bound on group size.

A plain ``Window.partitionBy(key).orderBy(value)`` puts a whole group into one
task. Here a group is cut into value ranges first, so a group holding a third
of the table is still spread over many tasks:

1. the input is written once to the shared folder, and later passes read that copy;
2. a repeatable sample (the rows with the smallest hash), one row for every ``RANGE_ROWS``, gives
   the cut points, proportionally more of them to larger groups;
3. each range's totals are added up into a starting offset (one row per range and group);
4. the running sum inside a range starts at that offset.

Results are exact whatever the cuts are; the cuts only decide the balance. A null in ``by`` is a
group like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import settle

_CUTS = "__cuts"
_RANGE = "__range"
#: Rows of a range on average: what one task sorts.
RANGE_ROWS = 1_000_000
LEAST_RANGES = 8


def range_count(df: DataFrame) -> int:
    """How many ranges to cut a stored table into: in proportion to its rows."""
    return max(LEAST_RANGES, math.ceil(df.count() / RANGE_ROWS))


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", small: bool = False):
    """Join on keys of which any may be null on both sides; the keys are kept once."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    joined = left.join(F.broadcast(renamed) if small else renamed, same, how)
    return joined.drop(*[f"__right_{k}" for k in keys])


def with_ranges(
    df: DataFrame, by: Sequence[str], order: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Add a range number per row, growing with ``order`` inside each ``by`` group."""
    n = ranges or range_count(df)
    columns = [*by, *order]
    point = F.struct(*order)
    sample = df.select(*columns).orderBy(F.xxhash64(*columns), *columns).limit(n)
    step = math.isqrt(n) + 1
    cuts = F.array_sort(F.collect_list(point)).alias("fine")
    coarse = F.filter("fine", lambda cut, i: i % step == step - 1).alias("coarse")
    if by:
        # at most n sampled rows: adaptive execution sends the table everywhere while it is small
        table = sample.groupBy(*by).agg(cuts).select(*by, F.struct("fine", coarse).alias(_CUTS))
        joined = join_groups(df, table, by)
    else:
        table = sample.agg(cuts).select(F.struct("fine", coarse))
        joined = df.withColumn(_CUTS, table.scalar())
    return joined.withColumn(_RANGE, F.coalesce(_cuts_below(point, step), F.lit(0))).drop(_CUTS)


def _cuts_below(point: Column, step: int) -> Column:
    """How many cuts lie below a value: every ``step``-th cut first, then the block between two of
    them, so a row compares with some 2 * sqrt(n) cuts instead of n."""
    fine, coarse = F.col(_CUTS)["fine"], F.col(_CUTS)["coarse"]
    blocks = F.size(F.filter(coarse, lambda cut: cut < point)) * step
    block = F.slice(fine, blocks + 1, F.lit(step))
    return blocks + F.size(F.filter(block, lambda cut: cut < point))


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    measures: dict[str, Column],
    ranges: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Inclusive running sums of ``measures`` in ``order`` within ``by``.

    ``order`` must be unique within a group and non-null; ``by`` may be null. Adds one column per
    measure and one ``<measure>_total`` with the group total. ``few_groups``
    says the number of groups is bounded (columns of a schema, say), which
    bounds the offset table and lets it be broadcast.
    """
    ranged = with_ranges(settle(df, "ordered"), by, order, ranges)
    spots = [*by, _RANGE]
    sums = ranged.groupBy(*spots).agg(
        *[F.sum(col).alias(f"__sum_{name}") for name, col in measures.items()]
    )
    # one row per range: groups + sampled cuts, whatever the table size
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *spots,
        *[
            F.coalesce(F.sum(f"__sum_{m}").over(before), F.lit(0)).alias(f"__before_{m}")
            for m in measures
        ],
        *[F.sum(f"__sum_{m}").over(group).alias(f"{m}_total") for m in measures],
    )
    inside = (
        Window.partitionBy(*spots)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = ranged.withColumns({f"__in_{m}": F.sum(col).over(inside) for m, col in measures.items()})
    out = join_groups(out, offsets, spots, small=few_groups or not by)
    out = out.withColumns({m: F.col(f"__in_{m}") + F.col(f"__before_{m}") for m in measures})
    return out.drop(_RANGE, *[f"__{k}_{m}" for m in measures for k in ("in", "before")])


def ordered_index(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str = "row_index",
    ranges: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Number rows 1, 2, ... in ``order`` within ``by``; adds ``<name>_total`` as well."""
    one = {name: F.lit(1).cast("bigint")}
    return running_totals(df, by, order, one, ranges, few_groups)


def sliced_window(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    exprs,
    reach: int,
    slice_rows: int = 100_000,
    few_groups: bool = False,
) -> DataFrame:
    """Window expressions that look back at most ``reach`` rows, on groups of any length.

    Every group is cut into slices of ``slice_rows`` rows, each slice also
    receives the ``reach`` rows before it, and ``exprs(window)`` (a mapping of
    name to column) runs per slice. Equal to the plain window for every row.
    """
    if reach > slice_rows:
        raise ValueError("reach must not exceed slice_rows")
    indexed = ordered_index(df, by, order, "__pos", few_groups=few_groups).drop("__pos_total")
    home = F.floor((F.col("__pos") - 1) / slice_rows)
    near_end = (F.col("__pos") - 1) % slice_rows >= slice_rows - reach
    copies = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    spread = indexed.withColumn("__slice", F.explode_outer(copies))  # never empty
    window = Window.partitionBy(*by, "__slice").orderBy("__pos")
    done = spread.withColumns(exprs(window))
    own = F.floor((F.col("__pos") - 1) / slice_rows) == F.col("__slice")
    return done.where(own).drop("__pos", "__slice")
