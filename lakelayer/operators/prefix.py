"""Running sums within groups that may be of any size.

``Window.partitionBy(group).orderBy(...)`` puts a whole group in one task, so one group
holding a third of the rows would make one task do a third of the work. Here a group is cut
into slices along its order: the caller names expressions that do not decrease along the
order (the order columns themselves, the last one coarsened). A window sums inside each
slice; the totals of the slices, few rows per group, are summed along the group, and a slice
that is not the first of its group gets what came before it. Most groups have one slice and
need nothing, so the carry table is small and AQE broadcasts it.

Rows are shuffled as they come: the slice and the summed values are computed behind the shuffle.

There is one path for all sizes, all of it DataFrame functions, and nothing runs before the
result is asked for. Group keys and slices are compared as one struct, in which nulls equal
nulls, so rows with a null key form a group like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE, _GROUP = "_slice", "_group"


def grouped_prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    values: Sequence[str] | Mapping[str, Column],
    slices: Sequence[Column],
    suffix: str = "_before",
) -> DataFrame:
    """Add ``<v><suffix>`` = sum of the integral value named ``v`` (a column, or one computed from the columns)
    over the earlier rows of the row's group.

    The order must be total (ties broken by the caller), or the result depends on arrival.
    ``slices`` must not decrease along it, compared one after the other.
    """
    named = values if isinstance(values, Mapping) else {v: F.col(v) for v in values}
    value = {v: F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")) for v, c in named.items()}
    place = F.struct(F.struct(*keys).alias("g"), F.struct(*(c.alias(f"s{i}") for i, c in enumerate(slices))).alias("s"))
    before = Window.partitionBy(_SLICE).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    # one projection, so all sums share one sort and one window
    local = df.repartition(place).select("*", place.alias(_SLICE)).select(
        "*", *(F.coalesce(F.sum(value[v]).over(before), F.lit(0)).alias(f"{v}{suffix}") for v in values))
    totals = df.groupBy(place.alias(_SLICE)).agg(*(F.sum(value[v]).alias(f"_t_{v}") for v in values))
    along = Window.partitionBy(_GROUP).orderBy(F.col(f"{_SLICE}.s"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        totals.withColumn(_GROUP, F.col(f"{_SLICE}.g"))
        .select(_SLICE, F.row_number().over(along).alias("_n"),
                *(F.sum(f"_t_{v}").over(earlier).alias(f"_c_{v}") for v in values))
        .where("_n > 1")
    )
    joined = local.join(carry, _SLICE, "left")
    return joined.select(*df.columns, *(
        (F.col(f"{v}{suffix}") + F.coalesce(F.col(f"_c_{v}"), F.lit(0))).alias(f"{v}{suffix}") for v in values))
