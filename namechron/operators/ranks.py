"""Positions and running values in an order, in two levels: no window ever holds a table or a group.

Rows are dealt by ranges of the order and numbered within their partition; a partition begins
where those before it end. Only one row for each partition (and group in it) meets in one place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize

#: The lower bits of monotonically_increasing_id count within a partition.
_LOCAL_BITS = 33


def ranked(df: DataFrame, order: list[Column], within: list[str] | None = None, name: str = "position", falling: tuple[int, ...] = ()) -> DataFrame:
    """``df`` with a column ``name`` (replaced if there): each row's place in ``order``, from 0, as a long.

    Nulls come first; the keys whose numbers are in ``falling`` sort the other way round, nulls last. With ``within``, places count anew for each combination of these columns (null is a value).
    Rows that ``order`` doesn't tell apart, repeated rows too, get neighbouring places in any order.
    The ordered table is stored, so that its places stay when partitions are read again.
    """
    within, columns = within or [], [c for c in df.columns if c != name]
    # The last key splits what the others can't.
    keyed = df.select(*columns, *(c.alias(f"_order{i}") for i, c in enumerate(order))).withColumn("_row", F.monotonically_increasing_id())
    sort = [F.col(c).asc_nulls_first() for c in within] + [F.col(f"_order{i}").desc_nulls_last() if i in falling else F.col(f"_order{i}").asc_nulls_first() for i in range(len(order))] + [F.col("_row")]
    ordered = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort)
    stored = materialize(ordered.select(*columns, F.monotonically_increasing_id().alias("_at")), "ranked")
    part = F.shiftright("_at", _LOCAL_BITS)
    sizes = stored.groupBy(*within, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    if not within:
        total, starts = 0, []
        for r in sorted(sizes.collect(), key=lambda r: r["_part"]):  # a row for each partition
            starts.append((r["_part"], r["_first"], total))
            total += r["_n"]
        starts = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _first long, _before long"))
        placed = stored.join(starts, part == starts["_part"])
    else:
        before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select(*(F.col(c).alias(f"_in{i}") for i, c in enumerate(within)), "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        same = part == starts["_part"]
        for i, c in enumerate(within):
            same &= stored[c].eqNullSafe(starts[f"_in{i}"])
        placed = stored.join(starts, same)
    return placed.select(*columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))


#: An aggregate, its column, and how what a block and the blocks before it give becomes one value.
Running = tuple[Callable[[Column], Column], Column, Callable[[Column, Column], Column]]


def added(a: Column, b: Column) -> Column:
    """The merge of sums; none is 0."""
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def running(df: DataFrame, within: list[str], blocks: list[Column], order: list[str], values: dict[str, Running], falling: bool = False) -> DataFrame:
    """``df`` with each of ``values``: an aggregate (sum, least or largest) over the rows before a row in ``order``; null before the first one.

    ``blocks`` never falls along ``order`` and tells apart runs of bounded size. Windows hold a run of a
    group (``within``; null is a value), or a row for each run of a group. ``falling`` goes from the end.
    """
    keys, way = [f"_b{i}" for i in range(len(blocks))], F.desc if falling else F.asc
    cut = df.withColumns(dict(zip(keys, blocks, strict=True)))
    before = (Window.unboundedPreceding, -1)
    local = Window.partitionBy(*within, *keys).orderBy(*map(way, order)).rowsBetween(*before)
    ahead = Window.partitionBy(*within).orderBy(*map(way, keys)).rowsBetween(*before)
    totals = cut.groupBy(*within, *keys).agg(*(add(c).alias(f"_t_{n}") for n, (add, c, _) in values.items()))
    carried = totals.select(*(F.col(c).alias(f"_in_{c}") for c in within), *(F.col(k).alias(f"_in{k}") for k in keys), *(add(F.col(f"_t_{n}")).over(ahead).alias(f"_c_{n}") for n, (add, _, _) in values.items()))
    inside = cut.select("*", *(add(c).over(local).alias(f"_l_{n}") for n, (add, c, _) in values.items()))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k) == F.col(f"_in{k}")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"_in_{c}"))
    return inside.join(carried, same).select(*(c for c in df.columns if c not in values), *(merge(F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, (_, _, merge) in values.items()))
